"""Clinical views over the star-schema tables, so that every operator has inputs at any scale factor.

Each view has a Spark form here and an SQL form (for an independent engine) in SQL_VIEWS; both follow the same rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.operators.fhir import TENANT_TAG

AS_OF = dt.date(2001, 8, 1)
YEAR = 2000

# The diagnosis codes and test names that rows are given by key.
CODES = "I21.9 I50.9 I70.0 I63.9 F03.90 J44.1 M05.9 K25.0 K70.3 E11.9 E11.21 G81.9 N18.3 C50.9 K72.1 C78.0 B20 I10 F32.9 E08.9 I25.2 I73.9 G45.9 J43.9 M35.0 N18.4 Z23 M54.5 INVALID_DX_99 E10.9".split()
NAMES = ("hba1c", "Glucose", " Creatinine ", "LDL", "HDL", "wbc", "Hemoglobin", "BMI", "heart rate", "vitamin d", "ferritin", "troponin")
DRUGS = ("Metformin", "lisinopril 10mg", "aspirin", "unknown drug", "omeprazole", "Atorvastatin 40mg", "placebo")


#: Where a row stands in its table: columns that base() adds if they are asked for.
PLACE = ("file_path", "row_index")


def base(spark: SparkSession, sf_dir: str, name: str, place: bool = False) -> DataFrame:
    """A driver table with its timestamps as session-zone ones; place: and with each row's file and number in it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    own = [F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes]
    return df.select(*own, *(F.col(f"_metadata.{c}").alias(c) for c in PLACE if place))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt to all tasks, for views that make much of them: a small table may be one split, thus one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def pick(values, key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), key.cast("int"))


def umpi(key: str | Column) -> Column:
    return F.concat(F.lit("P"), F.lpad((F.col(key) if isinstance(key, str) else key).cast("string"), 9, "0"))


def _num(c: Column | str, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), (F.col(c) if isinstance(c, str) else c).cast("string"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return base(spark, sf_dir, "customer").select(
        umpi("c_custkey").alias("umpi"), k.alias("arrival_seq"), _num(F.col("c_nationkey") % 4, "TENANT_").alias("tenant_id"), F.date_add(F.lit(dt.date(1930, 1, 1)), (k * 7919 % 27000).cast("int")).alias("birth_date"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("gender"), _num(k % 53, "G").alias("given_name"), _num(k % 97, "F").alias("family_name"), F.lit("OK").alias("state"), _num(70000 + k % 500).alias("postal_code"),
        F.when(k % 5 != 0, F.lpad((k % 10000).cast("string"), 4, "0")).alias("ssn_last4"),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    admit = F.timestamp_micros(F.unix_micros("o_orderdate") + k % 24 * 3_600_000_000)
    leave = F.timestamp_micros(F.unix_micros("o_orderdate") + (k % 24 + k % 15 * 24 + k % 7) * 3_600_000_000)
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "EMER").when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "IMP").otherwise("AMB")
    return base(spark, sf_dir, "orders").select(
        k.alias("arrival_seq"), F.concat(F.lit("E"), F.lpad(k.cast("string"), 10, "0")).alias("encounter_id"), umpi("o_custkey").alias("umpi"), _num(F.col("o_custkey") % 4, "TENANT_").alias("tenant_id"), kind.alias("encounter_class"),
        admit.alias("period_start"), F.when(F.col("o_orderstatus") != "O", leave).alias("period_end"), _num(k % 6, "FAC-").alias("facility_name"), _num(k % 10, "NPI-").alias("attending_provider_npi"), _num(k % 10, "Dr ").alias("attending_provider_name"),
    )


def _lines(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    orders = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return base(spark, sf_dir, "lineitem", place).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"umpi": umpi("o_custkey"), "arrival_seq": seq, "tenant_id": _num(F.col("o_custkey") % 4, "TENANT_"), "encounter_id": F.concat(F.lit("E"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"))})


def diagnoses(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """place: with PLACE, as rows may share an arrival_seq (line numbers of an order repeat)."""
    code = F.coalesce(pick(CODES, F.col("l_partkey") % 300), F.lit("Z00.00"))
    return _lines(spark, sf_dir, place).select("arrival_seq", "umpi", "tenant_id", "encounter_id", code.alias("icd10_code"), F.col("l_linenumber").alias("diagnosis_rank"), F.when(F.col("l_linestatus") == "O", "active").otherwise("resolved").alias("clinical_status"), *(PLACE if place else ()))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "arrival_seq", _num("arrival_seq", "O").alias("source_record_id"), "umpi", "tenant_id", "encounter_id", pick(NAMES, F.col("l_suppkey") % 12).alias("source_display"), F.lit(None).cast("string").alias("source_code"), F.lit(None).cast("string").alias("given_loinc"),
        F.round(4 + F.col("l_quantity") / 5, 1).alias("value_quantity"), F.col("l_shipdate").alias("effective_datetime"), F.when(F.col("l_returnflag") == "R", "preliminary").otherwise("final").alias("observation_status"),
    )


def drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "part").select(F.col("p_partkey").alias("arrival_seq"), pick(DRUGS, F.col("p_partkey") % 7).alias("drug"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"signup": "A04", "view": "A08", "click": "A02", "purchase": "A01", "error": "A03"}
    kind = F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v)) for k, v in kinds.items()))
    return base(spark, sf_dir, "events").select(F.col("event_id").alias("arrival_seq"), umpi("user_id").alias("umpi"), kind.alias("event_type"), F.col("ts").alias("event_datetime"))


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the message views render: one row for each order, with its patient's and its encounter's columns."""
    c = base(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return base(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))


def hl7_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """arrival_seq, raw_message: an A01 (even keys) or A03 message for each order, with faults by customer key."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    event = F.when(k % 2 == 0, "A01").otherwise("A03")
    at = F.date_format(F.timestamp_micros(F.unix_micros("o_orderdate") + k % 24 * 3_600_000_000), "yyyyMMddHHmmss")
    name = F.when(c % 50 == 1, "^").otherwise(F.concat(_num(c % 97, "F"), F.lit("^"), _num(c % 53, "G")))
    born = F.when(c % 50 == 2, "00000000").otherwise(F.date_format(F.date_add(F.lit(dt.date(1930, 1, 1)), (c * 7919 % 27000).cast("int")), "yyyyMMdd"))
    sex = F.when(c % 50 == 3, "X").when(c % 2 == 0, "M").otherwise("F")
    facility = F.when(c % 50 == 4, "").otherwise(_num(k % 6, "FAC"))
    line = lambda *x: F.concat_ws("|", *(F.lit(v) if isinstance(v, str) else v for v in x))
    parts = [
        line("MSH", "^~\\&", _num(k % 3, "APP"), facility, "HUB", "STATE", at, "", F.concat(F.lit("ADT^"), event, F.lit("^ADT_A01")), _num(k, "MSG"), "P", "2.5.1"),
        line("EVN", event, at),
        line("PID", "1", "", F.concat(_num(c, "MRN"), F.lit("^^^"), _num(k % 6, "FAC"), F.lit("^MR")), "", name, "", born, sex),
        line("PV1", "1", pick(("I", "O", "E", "R", "Q"), k % 5), F.concat(F.lit("W^1^2^"), _num(k % 6, "FAC")), "", "", "", F.concat(_num(k % 10, "ATT-NPI-"), F.lit("^Dr "), _num(k % 10))),
        F.when(k % 2 == 0, line("DG1", "1", "", F.concat(pick(CODES, k % 30), F.lit("^Diagnosis^ICD10")))),
        F.when(k % 7 != 0, line("ZTN", F.concat(F.lit("TENANT_ID="), _num(F.col("c_nationkey") % 4, "TENANT_")), F.concat(F.lit("SOURCE_SYSTEM="), _num(k % 2, "SYS")), "FEED_TYPE=ADT", "BATCH_ID=B1")),
        F.when(k % 11 == 0, line("OBX", "1", "NM", "4548-4^HbA1c^LN", "", F.format_string("%.1f", 4 + k % 50 / 10.0), "%^percent^UCUM", "4.0-5.6", "H", "", "", "F")),
    ]
    return _orders_customers(spark, sf_dir).select(k.alias("arrival_seq"), F.concat_ws("\r", *parts).alias("raw_message"))


def fhir_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a bundle is made from: an order with its customer and its lines (xs), as narrow columns. Texts, some fifty times as long, are made by bundle_text after the shuffles, in all tasks (no broadcast: orders may be one split)."""
    lines = base(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", (F.col("l_partkey") % 300).cast("short").alias("part"), (F.col("l_suppkey") % 12).cast("byte").alias("test"), (F.col("l_linestatus") == "O").alias("open"), "l_quantity", "l_shipdate").alias("x"))
    items = lines.groupBy("l_orderkey").agg(F.collect_list("x").alias("xs"))
    return _orders_customers(spark, sf_dir).select("o_orderkey", "o_orderdate", "c_custkey", "c_nationkey").join(items.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def bundle_text() -> Column:
    """The bundle of a row of fhir_parts: Patient, Encounter, Conditions and Observations."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    s = F.struct
    lit = F.lit
    start = F.timestamp_micros(F.unix_micros("o_orderdate") + k % 24 * 3_600_000_000)
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    born = F.when(c % 40 != 9, F.date_format(F.date_add(F.lit(dt.date(1930, 1, 1)), (c * 7919 % 27000).cast("int")), "yyyy-MM-dd"))
    patient = F.to_json(s(lit("Patient").alias("resourceType"), umpi("c_custkey").alias("id"), F.array(s(lit("official").alias("use"), _num(c % 97, "F").alias("family"), F.array(_num(c % 53, "G")).alias("given"))).alias("name"), F.when(c % 2 == 0, "male").otherwise("female").alias("gender"), born.alias("birthDate"), F.array(s(s(F.array(s(lit("MR").alias("code"))).alias("coding")).alias("type"), lit("urn:mrn").alias("system"), _num(c, "MRN").alias("value"))).alias("identifier"), F.array(s(lit("home").alias("use"), lit("OK").alias("state"), _num(70000 + c % 500).alias("postalCode"))).alias("address")))
    reference = s(F.concat(lit("Patient/"), umpi("c_custkey")).alias("reference"))
    visit = F.to_json(s(lit("Encounter").alias("resourceType"), _num(k, "E").alias("id"), lit("finished").alias("status"), s(F.when(k % 2 == 0, "IMP").otherwise("AMB").alias("code")).alias("class"), reference.alias("subject"), s(iso(start).alias("start"), iso(F.timestamp_micros(F.unix_micros(start) + k % 9 * 1_800_000_000)).alias("end")).alias("period"), s(_num(k % 6, "FAC-").alias("display")).alias("serviceProvider")))
    allergy = F.when(k % 13 == 0, F.to_json(s(lit("Basic").alias("resourceType"), _num(k, "X").alias("id"))))
    whose = s(F.concat(lit("urn:uuid:"), umpi("c_custkey")).alias("reference"))

    def line(x: Column) -> Column:
        seq = k * 10 + x["l_linenumber"]
        dx = F.to_json(s(lit("Condition").alias("resourceType"), _num(seq, "C").alias("id"), s(F.array(s(lit("http://hl7.org/fhir/sid/icd-10-cm").alias("system"), F.coalesce(pick(CODES, x["part"]), lit("Z00.00")).alias("code"))).alias("coding")).alias("code"), whose.alias("subject"), s(F.array(s(F.when(x["open"], "active").otherwise("resolved").alias("code"))).alias("coding")).alias("clinicalStatus"), iso(x["l_shipdate"]).alias("onsetDateTime")))
        coding = F.when(x["l_linenumber"] == 1, F.array(s(lit("http://loinc.org").alias("system"), lit("4548-4").alias("code"))))
        lab = F.to_json(s(lit("Observation").alias("resourceType"), _num(seq, "O").alias("id"), lit("final").alias("status"), s(coding.alias("coding"), pick(NAMES, x["test"]).alias("text")).alias("code"), whose.alias("subject"), iso(x["l_shipdate"]).alias("effectiveDateTime"), s(F.round(4 + x["l_quantity"] / 5, 1).alias("value"), lit("%").alias("unit")).alias("valueQuantity")))
        return s(x["l_linenumber"].alias("l_linenumber"), dx.alias("dx"), lab.alias("lab"))

    each = F.coalesce(F.flatten(F.transform(F.sort_array(F.transform("xs", line)), lambda x: F.array(x["dx"], x["lab"]))), F.array().cast("array<string>"))
    entries = F.transform(F.filter(F.concat(F.array(patient, visit, allergy), each), lambda r: r.isNotNull()), lambda r: F.concat(lit('{"resource":'), r, lit("}")))
    tags = F.when(k % 17 != 0, F.concat(lit(f'{{"system":"{TENANT_TAG}","code":"TENANT_'), (F.col("c_nationkey") % 4).cast("string"), lit('"},'))).otherwise(lit(""))
    return F.concat(lit('{"resourceType":"Bundle","id":"B'), k.cast("string"), lit('","type":"transaction","meta":{"tag":['), tags, lit('{"system":"urn:source","code":"EHR'), (k % 2).cast("string"), lit('"}]},"entry":['), F.concat_ws(",", entries), lit("]}"))


def fhir_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """arrival_seq, raw_bundle: a bundle for each order with its Patient, Encounter, Conditions and Observations."""
    return fhir_parts(spark, sf_dir).select(F.col("o_orderkey").alias("arrival_seq"), bundle_text().alias("raw_bundle"))


def csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_name, row_idx and the 15 text columns of patient rows; one row more where the key is 7 modulo 30."""
    c = F.col("c_custkey")
    born = F.date_add(F.lit(dt.date(1930, 1, 1)), (c * 7919 % 27000).cast("int"))
    rows = spread(base(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.explode(F.when(c % 30 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return rows.select(
        F.lit("patients.csv").alias("file_name"), (c + F.col("again") * 1_000_000_000).alias("row_idx"), _num(c, "PT").alias("patient_id"), F.when(c % 25 == 3, " ").otherwise(_num(c % 53, "G")).alias("first_name"), F.when(c % 25 == 4, "").otherwise(_num(c % 97, "F")).alias("last_name"),
        F.when(c % 20 == 5, F.date_format(born, "MM/dd/yyyy")).otherwise(F.date_format(born, "yyyy-MM-dd")).alias("dob"), F.when(c % 2 == 0, "M").otherwise("F").alias("gender"), F.lpad((c % 10000).cast("string"), 4, "0").alias("ssn_last4"), F.concat(_num(c), F.lit(" Main St, Apt 1")).alias("address"),
        F.lit(" Tulsa ").alias("city"), F.lit("OK").alias("state"), F.when(c % 60 == 8, "").otherwise(_num(70000 + c % 500)).alias("zip"), F.lit("").alias("phone"), _num(c % 10, "NPI-").alias("pcp_npi"), _num(c, "INS").alias("insurance_id"), F.lit("2000-01-31").alias("last_visit_date"), pick(CODES, c % 30).alias("primary_dx_icd10"),
    )


def csv_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, raw_content: csv_raw as stored CSV texts of 200 rows each, quoted."""
    from carelattice.operators.csvbatch import PATIENT_COLUMNS

    line = F.concat_ws(",", *(F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in PATIENT_COLUMNS))
    rows = csv_raw(spark, sf_dir).select((F.col("row_idx") % 1_000_000_000 / 200).cast("long").alias("batch"), F.struct("row_idx", line.alias("line")).alias("x"))
    text = F.concat(F.lit(",".join(PATIENT_COLUMNS) + "\n"), F.concat_ws("\n", F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"])))
    return rows.groupBy("batch").agg(text.alias("raw_content"))  # 200 rows a group


def lab_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_name, row_idx and the 12 text columns of laboratory rows."""
    seq = F.col("arrival_seq")
    value = F.when(seq % 31 == 0, "POSITIVE").when(seq % 37 == 0, "").otherwise(F.round(4 + F.col("l_quantity") / 5, 1).cast("string"))
    return _lines(spark, sf_dir).select(
        F.lit("labs.csv").alias("file_name"), seq.alias("row_idx"), _num(seq, "R").alias("result_id"), F.when(seq % 41 == 0, "NOBODY").otherwise(_num("o_custkey", "PT")).alias("patient_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("collection_date"),
        F.when(seq % 3 == 0, "A1C").otherwise(F.lit("LOCAL1")).alias("test_code"), pick(NAMES, F.col("l_suppkey") % 12).alias("test_name"), value.alias("result_value"), F.lit("%").alias("result_unit"), F.lit("4.0").alias("reference_range_low"), F.lit("n/a").alias("reference_range_high"), F.lit("").alias("abnormal_flag"), F.lit("NPI-1").alias("ordering_provider_npi"), F.lit("final").alias("status"),
    )


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every patient twice: as one system knows them, and later as another does, with another record number."""
    p = patients(spark, sf_dir)
    n = 1_000_000_000
    one = p.select((F.col("arrival_seq")).alias("arrival_seq"), F.concat(F.lit("A"), F.col("umpi")).alias("source_mrn"), F.lit("NPI-A").alias("source_facility_npi"), F.lit("urn:a").alias("source_identifier_system"), "family_name", "given_name", "birth_date", "gender", "postal_code", "ssn_last4", "tenant_id", F.lit("SYS_A").alias("source_system"), F.concat(F.lit("A"), F.col("umpi")).alias("source_id"))
    two = p.select((F.col("arrival_seq") + n).alias("arrival_seq"), F.concat(F.lit("B"), F.col("umpi")).alias("source_mrn"), F.lit("NPI-B").alias("source_facility_npi"), F.lit("urn:b").alias("source_identifier_system"), F.lower("family_name").alias("family_name"), "given_name", "birth_date", "gender", "postal_code", "ssn_last4", "tenant_id", F.lit("SYS_B").alias("source_system"), F.concat(F.lit("B"), F.col("umpi")).alias("source_id"))
    return one.unionByName(two)
