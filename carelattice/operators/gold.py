"""Analytics: comorbidity, utilisation, quality measure, readmissions, exports and scorecards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelattice.functions.codes import ADT_COARSE, ADT_LABELS, CHARLSON, CHRONIC, ED_CLASSES, HBA1C, INPATIENT_CLASSES, MEASURE
from carelattice.functions.columns import age, has_prefix, hash_umpi, lookup, micros, one_decimal, risk_tier, stable_id

DAY = 86_400_000_000


def diagnosis_flags(diagnoses: DataFrame, key: str = "umpi") -> DataFrame:
    """All comorbidity conditions and chronic flags of every patient in one pass; distinct codes are matched once."""
    codes = diagnoses.select(key, "icd10_code").distinct()
    named = {name: has_prefix(F.col("icd10_code"), p) for name, (_, p) in CHARLSON.items()} | {f"has_{name.lower()}": has_prefix(F.col("icd10_code"), p) for name, p in CHRONIC.items()}
    flags = codes.groupBy(key).agg(*(F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in named.items()))
    return flags.withColumn("diabetes_uncomplicated", F.col("diabetes_uncomplicated") & ~F.col("diabetes_complicated"))


def charlson(flags: DataFrame) -> Column:
    return sum((F.col(n).cast("int") * w for n, (w, _) in CHARLSON.items()), F.lit(0))


def charlson_index(diagnoses: DataFrame) -> DataFrame:
    flags = diagnosis_flags(diagnoses)
    return flags.select("umpi", charlson(flags).alias("charlson_index"))


def chronic_flags(diagnoses: DataFrame) -> DataFrame:
    return diagnosis_flags(diagnoses).select("umpi", *(f"has_{n.lower()}" for n in CHRONIC))


def chronic_map() -> Column:
    return F.create_map(*(x for n in CHRONIC for x in (F.lit(n), F.col(f"has_{n.lower()}"))))


def utilization(encounters: DataFrame, as_of: dt.date) -> DataFrame:
    """Encounters, emergency visits and inpatient days of the 12 months to as_of (no upper bound), and the last encounter ever."""
    recent = F.col("period_start") >= F.lit(as_of - dt.timedelta(days=365)).cast("timestamp")
    stay = F.floor((micros(F.col("period_end")) - micros(F.col("period_start"))) / DAY)
    return encounters.groupBy("umpi").agg(
        F.count_if(recent).cast("int").alias("encounters_12m"),
        F.count_if(recent & F.col("encounter_class").isin(*ED_CLASSES)).cast("int").alias("ed_visits_12m"),
        F.coalesce(F.sum(F.when(recent & F.col("encounter_class").isin(*INPATIENT_CLASSES), stay)), F.lit(0)).cast("int").alias("inpatient_days_12m"),
        F.max(F.to_date("period_start")).alias("last_encounter_date"),
    )


def pcp_attribution(encounters: DataFrame, as_of: dt.date, order: str = "arrival_seq") -> DataFrame:
    """The provider (number and name) seen most in the 12 months; of equals the one seen first."""
    seen = encounters.filter((F.col("period_start") >= F.lit(as_of - dt.timedelta(days=365)).cast("timestamp")) & (F.col("attending_provider_npi") != "") & (F.col("attending_provider_name") != ""))
    counted = seen.groupBy("umpi", "attending_provider_npi", "attending_provider_name").agg(F.count("*").alias("visits"), F.min(order).alias("first_seen"))
    best = F.max_by(F.struct("attending_provider_npi", "attending_provider_name"), F.struct("visits", -F.col("first_seen")))
    return counted.groupBy("umpi").agg(best.alias("p")).select("umpi", F.col("p.attending_provider_npi").alias("pcp_npi"), F.col("p.attending_provider_name").alias("pcp_name"))


def first_rows(rows: DataFrame, key: str = "umpi", order: str = "arrival_seq") -> DataFrame:
    """The first row of every key, by a combining aggregation."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def patient_summary(patients: DataFrame, encounters: DataFrame, diagnoses: DataFrame, as_of: dt.date) -> DataFrame:
    """One row for each patient: each child table is aggregated by patient before it is joined."""
    flags = diagnosis_flags(diagnoses)
    patients = patients if "state" in patients.columns else patients.withColumn("state", F.lit(None).cast("string"))
    people = first_rows(patients.select("umpi", "arrival_seq", "tenant_id", "given_name", "family_name", "birth_date", "gender", "state", "postal_code"))
    out = people.join(utilization(encounters, as_of), "umpi", "left").join(pcp_attribution(encounters, as_of), "umpi", "left").join(flags, "umpi", "left")
    out = out.fillna(False, [*CHARLSON, *(f"has_{n.lower()}" for n in CHRONIC)]).fillna(0, ["encounters_12m", "ed_visits_12m", "inpatient_days_12m"])
    name = F.nullif(F.trim(F.concat(F.coalesce("given_name", F.lit("")), F.lit(" "), F.coalesce("family_name", F.lit("")))), F.lit(""))
    out = out.withColumn("charlson_index", charlson(flags))
    return out.select(
        hash_umpi(F.col("umpi")).alias("patient_hash"), "umpi", "tenant_id", name.alias("full_name"), age(F.col("birth_date"), F.lit(as_of)).alias("age"), "gender", "postal_code", F.lit(as_of).alias("as_of_date"),
        "charlson_index", F.lit(0).alias("elixhauser_index"), risk_tier(F.col("charlson_index")).alias("risk_tier"), *(f"has_{n.lower()}" for n in CHRONIC), "encounters_12m", "ed_visits_12m", "inpatient_days_12m", "last_encounter_date", "pcp_npi", "pcp_name",
        "birth_date", "state", F.when(F.col("pcp_npi").isNotNull(), "ENCOUNTER_FREQUENCY").alias("attribution_method"), F.current_timestamp().alias("risk_score_updated_ts"), F.current_timestamp().alias("refreshed_ts"),
    )


def summary_table(summary: DataFrame) -> DataFrame:
    """patient_summary in the shape of the stored table."""
    return summary.select("patient_hash", "tenant_id", "charlson_index", "risk_tier", chronic_map().alias("chronic_condition_flags"), F.col("encounters_12m").alias("total_encounter_count"), F.col("ed_visits_12m").alias("ed_visit_count"), F.col("inpatient_days_12m").alias("inpatient_days"), "last_encounter_date")


def hba1c_control(patients: DataFrame, diagnoses: DataFrame, observations: DataFrame, year: int, order: str = "arrival_seq") -> DataFrame:
    """HbA1c below 8 % among 18 to 75 year old patients with diabetes. The numerator is null without evidence."""
    start, end = dt.date(year, 1, 1), dt.date(year, 12, 31)
    diabetic = diagnoses.filter(has_prefix(F.col("icd10_code"), CHRONIC["DIABETES"])).select("umpi").distinct()
    years = age(F.col("birth_date"), F.lit(end))
    denominator = first_rows(patients).filter((years >= 18) & (years <= 75)).join(diabetic, "umpi", "left_semi")
    when = F.col("effective_datetime")
    usable = observations.filter((F.col("loinc_code") == HBA1C) & (when >= F.lit(dt.datetime(year, 1, 1))) & (when <= F.lit(dt.datetime(year, 12, 31, 23, 59, 59))) & (F.col("observation_status") == "final") & F.col("value_quantity").isNotNull())
    # the latest one; of equal times the first that arrived
    latest = usable.groupBy("umpi").agg(F.max_by(F.struct("value_quantity", "effective_datetime"), F.struct("effective_datetime", -F.col(order))).alias("e"))
    out = denominator.join(latest, "umpi", "left")
    value = F.col("e.value_quantity")
    return out.select(
        stable_id(F.lit(MEASURE[0]), "umpi", F.lit(year)).alias("measure_id"), hash_umpi(F.col("umpi")).alias("patient_hash"), "umpi", "tenant_id", F.lit(MEASURE[0]).alias("measure_code"), F.lit(MEASURE[1]).alias("measure_steward"),
        F.lit(start).alias("measurement_period_start"), F.lit(end).alias("measurement_period_end"), F.lit(True).alias("in_denominator"), (value < 8.0).alias("in_numerator"),
        one_decimal(value).alias("evidence_value"), F.to_date("e.effective_datetime").alias("evidence_date"),
    )


def adt_events(encounters: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """An A01 for every admission and an A03 for every discharge, the admission first."""
    event = lambda kind, at: F.struct(F.lit(kind).alias("event_type"), F.col(at).alias("event_datetime"))
    both = F.filter(F.array(event("A01", "period_start"), event("A03", "period_end")), lambda e: e["event_datetime"].isNotNull())
    out = encounters.select("umpi", "tenant_id", "encounter_id", "facility_name", order, F.posexplode(both).alias("_i", "_e"))
    return out.select("umpi", "tenant_id", "encounter_id", "facility_name", (F.col(order) * 2 + F.col("_i")).alias(order), "_e.*")


def readmissions(events: DataFrame, days: int = 30) -> DataFrame:
    """events with the latest discharge strictly before them, and for admissions whether it is at most `days` days before.

    A range window over one patient's events: no self join. Its size is one patient's history.
    """
    at = micros(F.col("event_datetime"))
    before = Window.partitionBy("umpi").orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    prior = F.max(F.when(F.col("event_type") == "A03", F.col("event_datetime"))).over(before)
    gap = at - micros(F.col("prior_discharge"))
    hit = (F.col("event_type") == "A01") & (gap <= days * DAY)
    out = events.withColumn("prior_discharge", prior).withColumn("is_readmission_30d", F.coalesce(hit, F.lit(False)))
    midnight = F.date_trunc("day", "prior_discharge")
    return out.withColumns({
        "prior_discharge_datetime": F.when(F.col("is_readmission_30d"), midnight),
        "days_since_prior_discharge": F.when(F.col("is_readmission_30d"), (at - micros(midnight)) / DAY),
        "exact_prior_discharge": F.when(F.col("is_readmission_30d"), F.col("prior_discharge")),
    }).drop("prior_discharge")


def adt_feed(events: DataFrame, diagnoses: DataFrame | None = None, order: str = "arrival_seq", ties: tuple[str, ...] = ()) -> DataFrame:
    """The event feed: labels, readmissions and the encounter's active first-rank diagnosis (the last one that arrived).

    ties: columns that decide among diagnoses with the same number of arrival, if that isn't unique.
    """
    out = readmissions(events).withColumns({"event_label": lookup(F.col("event_type"), ADT_LABELS, F.col("event_type")), "event_category": lookup(F.col("event_type"), ADT_COARSE, F.lit("other")), "patient_hash": hash_umpi(F.col("umpi"))})
    if diagnoses is None:
        return out
    primary = diagnoses.filter("diagnosis_rank = 1 and clinical_status = 'active'").groupBy("encounter_id").agg(F.max_by("icd10_code", F.struct(order, *ties)).alias("primary_dx"))
    return out.join(primary, "encounter_id", "left")


def uscdi_export(patients: DataFrame, version: str = "v3", pseudonymise: bool = False) -> DataFrame:
    """The demographic payload of every patient, and which elements it lacks."""
    missing = F.filter(
        F.array(*(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(n)) for n, c in (("name.given", "given_name"), ("name.family", "family_name"), ("birthDate", "birth_date"), ("gender", "gender")))), lambda x: x.isNotNull()
    )
    payload = F.struct(
        F.lit("Patient").alias("resourceType"), (hash_umpi(F.col("umpi")) if pseudonymise else F.col("umpi")).alias("id"), F.array(F.struct(F.col("family_name").alias("family"), F.array("given_name").alias("given"))).alias("name"),
        F.col("birth_date").cast("string").alias("birthDate"), F.col("gender").alias("gender"), F.array(F.struct(F.col("state").alias("state"), F.col("postal_code").alias("postalCode"))).alias("address"),
    )
    return patients.select(stable_id(F.lit("uscdi"), "umpi").alias("export_id"), "umpi", "tenant_id", F.to_json(payload, {"ignoreNullFields": "false"}).alias("uscdi_payload"), missing.alias("missing_elements"), (F.size(missing) == 0).alias("qhin_ready"), F.lit(version).alias("uscdi_version"))


def state_metrics(summary: DataFrame) -> DataFrame:
    """Population figures over all tenants, by date; for operators only."""
    has = lambda c: F.count_if(F.col(c))
    return summary.groupBy("as_of_date").agg(
        F.countDistinct("umpi").alias("patient_count"), F.countDistinct("tenant_id").alias("tenant_count"), F.round(F.avg("charlson_index"), 6).alias("avg_charlson"), F.sum("encounters_12m").alias("encounters"), F.sum("ed_visits_12m").alias("ed_visits"),
        F.sum("inpatient_days_12m").alias("inpatient_days"), has("has_diabetes").alias("diabetes"), has("has_hypertension").alias("hypertension"), has("has_chf").alias("heart_failure"), F.count_if(F.col("risk_tier").isin("HIGH", "VERY_HIGH")).alias("high_risk"),
    )


def tenant_scorecard(patients: DataFrame, observations: DataFrame, conditions: DataFrame, links: DataFrame, medications: DataFrame | None = None) -> DataFrame:
    """Completeness, coding coverage and match rate of every tenant. Each table is aggregated before the joins."""
    rate = lambda hit: F.round(F.try_divide(F.count_if(hit) * 100.0, F.count("*")), 4)
    complete = F.lit(True)
    for c in ("family_name", "given_name", "birth_date", "gender", "postal_code"):
        complete = complete & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    out = patients.groupBy("tenant_id").agg(F.countDistinct("umpi").alias("patient_count"), rate(complete).alias("pct_complete_demographics"))
    parts = [
        observations.groupBy("tenant_id").agg(rate(F.col("loinc_code").isNotNull()).alias("pct_loinc_coverage"), F.count_if(F.col("loinc_code").isNull()).alias("unmapped_code_count")),
        conditions.groupBy("tenant_id").agg(rate(F.col("icd10_code").rlike(r"^[A-Z]\d")).alias("pct_icd10_coverage")),
        links.groupBy("tenant_id").agg(rate(~F.col("is_new_record")).alias("mpi_match_rate")),
    ]
    if medications is not None:
        parts.append(medications.groupBy("tenant_id").agg(rate(F.col("rxnorm_code").isNotNull()).alias("pct_rxnorm_coverage")))
    for p in parts:
        out = out.join(p, "tenant_id", "left")
    return out.withColumn("unmapped_code_count", F.coalesce("unmapped_code_count", F.lit(0)))
