"""FHIR R4 bundles to rows, with from_json and array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.codes import RESOURCE_TYPES
from carelattice.functions.columns import blank_to_null, first_filled, iso_date, iso_timestamp, micros, stable_id

_CODING = "struct<system:string,code:string,display:string>"
_CODEABLE = f"struct<coding:array<{_CODING}>,text:string>"
#: Fields of every resource, and those of each kind that is taken in; a parse reads only what its kinds need.
_COMMON = "resourceType:string,id:string,subject:struct<reference:string>"
_STATUS = "status:string"
_FIELDS = {
    "Patient": f"gender:string,birthDate:string,identifier:array<struct<use:string,type:{_CODEABLE},system:string,value:string>>,name:array<struct<use:string,family:string,given:array<string>>>,telecom:array<struct<system:string,value:string,use:string>>,address:array<struct<use:string,line:array<string>,city:string,state:string,postalCode:string,country:string>>",
    "Encounter": f"{_STATUS},class:{_CODING},encounter:struct<reference:string>,period:struct<start:string,end:string>,serviceProvider:struct<display:string>",
    "Observation": f"{_STATUS},code:{_CODEABLE},effectiveDateTime:string,issued:string,valueString:string,valueQuantity:struct<value:double,unit:string,system:string,code:string>,interpretation:array<{_CODEABLE}>,referenceRange:array<struct<low:struct<value:double,unit:string>,high:struct<value:double,unit:string>>>",
    "Condition": f"{_STATUS},code:{_CODEABLE},clinicalStatus:{_CODEABLE},verificationStatus:{_CODEABLE},onsetDateTime:string,abatementDateTime:string",
}
KINDS = tuple(_FIELDS)


def resource_schema(kinds: tuple[str, ...] = KINDS) -> str:
    fields = [_COMMON, *(_FIELDS[k] for k in kinds)]
    # `status` and `code` mean the same in several kinds
    whole = ",".join(fields).replace(f",{_STATUS}", "")
    whole = whole.replace(f",code:{_CODEABLE}", "") + (f",code:{_CODEABLE}" if {"Observation", "Condition"} & set(kinds) else "") + (f",{_STATUS}" if set(kinds) - {"Patient"} else "")
    return f"struct<{whole}>"


def bundle_schema(kinds: tuple[str, ...] = KINDS) -> str:
    return f"struct<resourceType:string,id:string,type:string,timestamp:string,meta:struct<lastUpdated:string,tag:array<{_CODING}>>,entry:array<struct<fullUrl:string,resource:{resource_schema(kinds)}>>>"


RESOURCE, BUNDLE = resource_schema(), bundle_schema()

# The default tag systems of tenant and source; both are parameters.
TENANT_TAG = "https://oklahoma-hdu.example.org/tags/tenant"
SOURCE_TAG = "https://oklahoma-hdu.example.org/tags/source"


def _tag(tags: Column, system: str) -> Column:
    return F.get(F.filter(tags, lambda t: t["system"] == system), F.lit(0))


def tenant(bundle: Column, default: str | None = None, uri: str = TENANT_TAG) -> Column:
    """The tenant tag's code (UNKNOWN if it has none), else default, else UNKNOWN."""
    tag = _tag(bundle["meta"]["tag"], uri)
    return F.when(tag.isNotNull(), F.coalesce(tag["code"], F.lit("UNKNOWN"))).otherwise(first_filled(F.lit(default or None).cast("string"), F.lit("UNKNOWN")))


def source(bundle: Column, uri: str = TENANT_TAG) -> Column:
    """The source tag's code, else that of the first other tag with a code that isn't the tenant's."""
    named = _tag(bundle["meta"]["tag"], SOURCE_TAG)["code"]
    return F.coalesce(named, F.get(F.filter(bundle["meta"]["tag"], lambda t: (F.coalesce(t["system"], F.lit("")) != uri) & (F.coalesce(t["code"], F.lit("")) != "")), F.lit(0))["code"])


def parse_bundles(bundles: DataFrame, default_tenant: str | None = None, raw: str = "raw_bundle", uri: str = TENANT_TAG, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """One row for each bundle; what is no JSON or no Bundle stays, with status ERROR. kinds: of which all fields are read."""
    df = bundles.withColumn("bundle", F.from_json(raw, bundle_schema(kinds)))
    good = F.coalesce(F.col("bundle.resourceType") == "Bundle", F.lit(False))
    types = F.filter(F.transform("bundle.entry", lambda e: e["resource"]["resourceType"]), lambda t: t.isNotNull())
    return df.select(
        *bundles.columns,
        "bundle",
        F.coalesce("bundle.id", stable_id(raw)).alias("bundle_id"),
        F.coalesce("bundle.type", F.lit("unknown")).alias("bundle_type"),
        F.coalesce(F.sort_array(F.array_distinct(types)), F.array().cast("array<string>")).alias("resource_types"),
        tenant(F.col("bundle"), default_tenant, uri).alias("tenant_id"),
        source(F.col("bundle"), uri).alias("source_system"),
        F.when(good, "PASS").otherwise("ERROR").alias("validation_status"),
        F.when(~good, F.when(F.col("bundle.resourceType").isNull(), "Invalid JSON or no resource type").otherwise(F.concat(F.lit("Expected Bundle, got "), "bundle.resourceType"))).alias("error"),
    )


def _entries(entries: Column, raw: Column) -> Column:
    """Each entry with the bundle's text (the first one only), the number of entries and its subject's place in them from their end."""
    ids = F.reverse(F.transform(entries, lambda e: F.when(e["resource"]["resourceType"] == "Patient", e["resource"]["id"])))
    at = lambda e: F.array_position(ids, reference_key(e["resource"]["subject"]["reference"]))
    return F.transform(entries, lambda e, i: F.struct(e["resource"].alias("resource"), F.when(i == 0, raw).alias("payload"), at(e).alias("at"), F.size(entries).alias("n")))


def resources(parsed: DataFrame, raw: str = "raw_bundle", keep_bundle: bool = True) -> DataFrame:
    """One row for each entry of good bundles, in order, with `supported`; and one ERROR row for each bad bundle.

    The bundle's text stays on its first entry only. subject_entry: the entry_index of the Patient that the entry is about,
    if the bundle has it (the last one with the id it refers to); it is found within the bundle's own array, without a join.
    Good and bad bundles come out of one generator, so that each is parsed once.
    """
    good = F.col("validation_status") == "PASS"
    keep = [c for c in parsed.columns if c not in ("bundle", raw, "resource_types")]
    kind = parsed.schema["bundle"].dataType["entry"].dataType.elementType["resource"].dataType
    text = F.col(raw) if keep_bundle else F.lit(None).cast("string")
    bad = F.array(F.struct(F.lit(None).cast(kind).alias("resource"), F.col(raw).alias("payload"), F.lit(0).cast("long").alias("at"), F.lit(1).alias("n")))
    # outer, then without the rows of empty bundles: for an inner one Spark would work the array out once more, to filter by its size
    out = parsed.select(*keep, F.posexplode_outer(F.when(good, _entries(F.col("bundle.entry"), text)).otherwise(bad)).alias("entry_index", "_e")).filter("_e is not null")
    resource_type = F.when(good, F.coalesce("_e.resource.resourceType", F.lit("UNKNOWN"))).otherwise(F.lit("UNKNOWN"))
    return out.select(
        *keep, "entry_index", resource_type.alias("resource_type"), F.col("_e.resource.id").alias("resource_id"), F.col("_e.resource").alias("resource"),
        (~good | resource_type.isin(*RESOURCE_TYPES)).alias("supported"), F.col("_e.payload").alias("bundle_payload"), F.when(F.col("_e.at") > 0, F.col("_e.n") - F.col("_e.at")).cast("int").alias("subject_entry"),
    )


def skipped_types(rows: DataFrame) -> DataFrame:
    """The distinct types that are not taken in, by bundle."""
    return rows.filter("not supported").groupBy("bundle_id").agg(F.sort_array(F.collect_set("resource_type")).alias("skipped_types"))


def reference_key(reference: Column) -> Column:
    return F.replace(F.element_at(F.split(reference, "/"), -1), F.lit("urn:uuid:"), F.lit(""))


def _or_first(items: Column, test) -> Column:
    return F.coalesce(F.get(F.filter(items, test), F.lit(0)), F.get(items, F.lit(0)))


def patient_identities(rows: DataFrame) -> DataFrame:
    """The matching fields of Patient resources: official name, home address, MR identifier, last SS identifier's last four."""
    r = F.col("resource")
    name, address = _or_first(r["name"], lambda n: n["use"] == "official"), _or_first(r["address"], lambda a: a["use"] == "home")
    of_type = lambda code: F.filter(r["identifier"], lambda i: F.get(i["type"]["coding"], F.lit(0))["code"] == code)
    mr, ss = F.get(of_type("MR"), F.lit(0)), of_type("SS")
    return rows.filter("resource_type = 'Patient' and resource is not null").select(
        "*", r["id"].alias("source_id"), mr["value"].alias("source_mrn"), mr["system"].alias("source_identifier_system"),
        name["family"].alias("family_name"), F.get(name["given"], F.lit(0)).alias("given_name"), iso_date(r["birthDate"]).alias("birth_date"), r["gender"].alias("gender"),
        address["postalCode"].alias("postal_code"), F.right(F.translate(F.get(ss, F.size(ss) - 1)["value"], "- ", ""), F.lit(4)).alias("ssn_last4"),
    )


def clinical_patients(rows: DataFrame) -> DataFrame:
    """Patient resources as stored: first name and address, first phone and e-mail."""
    r = F.col("resource")
    name, address = F.get(r["name"], F.lit(0)), F.get(r["address"], F.lit(0))
    contact = lambda system: F.get(F.filter(r["telecom"], lambda t: t["system"] == system), F.lit(0))["value"]
    return rows.filter("resource_type = 'Patient' and resource is not null").select(
        "*", r["id"].alias("source_record_id"), name["family"].alias("family_name"), F.get(name["given"], F.lit(0)).alias("given_name"), iso_date(r["birthDate"]).alias("birth_date"), r["gender"].alias("gender"),
        F.get(address["line"], F.lit(0)).alias("address_line"), address["city"].alias("city"), address["state"].alias("state"), address["postalCode"].alias("postal_code"), contact("phone").alias("phone"), contact("email").alias("email"),
    )


def observations(rows: DataFrame) -> DataFrame:
    """Observation resources before coding: codings, value, range and interpretation."""
    r = F.col("resource")
    codings = F.coalesce(r["code"]["coding"], F.array().cast(f"array<{_CODING}>"))
    is_loinc = lambda c: F.coalesce(c["system"], F.lit("")).contains("loinc.org") & (F.coalesce(c["code"], F.lit("")) != "")
    loinc, other = F.filter(codings, is_loinc), F.filter(codings, lambda c: ~is_loinc(c))
    last = lambda a: F.get(a, F.size(a) - 1)
    quantity, span, code = r["valueQuantity"], F.get(r["referenceRange"], F.lit(0)), F.get(F.get(r["interpretation"], F.lit(0))["coding"], F.lit(0))
    return rows.filter("resource_type = 'Observation' and resource is not null").select(
        "*", r["id"].alias("source_record_id"), reference_key(r["subject"]["reference"]).alias("subject_key"),
        last(loinc)["code"].alias("given_loinc"), last(loinc)["display"].alias("given_loinc_display"), last(other)["code"].alias("source_code"), last(other)["system"].alias("source_code_system"),
        first_filled(r["code"]["text"], F.get(F.filter(other, lambda c: F.coalesce(c["display"], F.lit("")) != ""), F.lit(0))["display"]).alias("source_display"), loinc.alias("loinc_codings"),
        quantity["value"].alias("value_quantity"), F.when(quantity.isNull(), r["valueString"]).alias("value_string"), first_filled(quantity["code"], quantity["unit"]).alias("value_unit"),
        span["low"]["value"].alias("reference_range_low"), span["high"]["value"].alias("reference_range_high"), F.coalesce(span["low"]["unit"], span["high"]["unit"]).alias("reference_range_unit"),
        code["code"].alias("interpretation_code"), code["display"].alias("interpretation_display"),
        iso_timestamp(F.coalesce(r["effectiveDateTime"], r["issued"])).alias("effective_datetime"), r["status"].alias("observation_status"),
    )


def encounters(rows: DataFrame) -> DataFrame:
    r = F.col("resource")
    start, end = iso_timestamp(r["period"]["start"]), iso_timestamp(r["period"]["end"])
    return rows.filter("resource_type = 'Encounter' and resource is not null").select(
        "*", r["id"].alias("source_record_id"), reference_key(r["subject"]["reference"]).alias("subject_key"), r["class"]["code"].alias("encounter_class"), r["status"].alias("encounter_status"),
        start.alias("period_start"), end.alias("period_end"), ((micros(end) - micros(start)) / 3.6e9).alias("length_of_stay_hours"), r["serviceProvider"]["display"].alias("facility_name"),
    )


def conditions(rows: DataFrame) -> DataFrame:
    """Condition resources with a code; only the first coding counts."""
    r = F.col("resource")
    first = F.get(r["code"]["coding"], F.lit(0))
    status = lambda c: F.get(c["coding"], F.lit(0))["code"]
    return rows.filter("resource_type = 'Condition' and resource is not null").select(
        "*", r["id"].alias("source_record_id"), reference_key(r["subject"]["reference"]).alias("subject_key"), blank_to_null(first["code"]).alias("icd10_code"), first["display"].alias("icd10_display"), F.lit("primary").alias("condition_category"),
        status(r["clinicalStatus"]).alias("clinical_status"), status(r["verificationStatus"]).alias("verification_status"), iso_timestamp(r["onsetDateTime"]).alias("onset_datetime"), iso_timestamp(r["abatementDateTime"]).alias("abatement_datetime"),
    ).filter("icd10_code is not null")


def link_subjects(rows: DataFrame, umpis: DataFrame, global_ids: bool = False) -> DataFrame:
    """rows with their subject's umpi and subject_seq (its arrival); rows without one are left out. umpis: bundle_id, source_id, umpi, arrival_seq.

    global_ids: resource ids mean the same in all bundles, and the latest link wins.
    """
    if global_ids:
        known = umpis.groupBy(F.col("source_id").alias("subject_key")).agg(F.max_by("umpi", "arrival_seq").alias("umpi"), F.max("arrival_seq").alias("subject_seq"))
        return rows.join(known, "subject_key")
    known = umpis.groupBy("bundle_id", F.col("source_id").alias("subject_key")).agg(F.max_by("umpi", "arrival_seq").alias("umpi"), F.max("arrival_seq").alias("subject_seq"))
    return rows.join(known, ["bundle_id", "subject_key"])


def of_subjects(rows: DataFrame) -> DataFrame:
    """Rows whose subject is a Patient of their own bundle, whose id is subject_key."""
    return rows.filter("subject_entry is not null")
