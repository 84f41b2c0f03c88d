"""The medallion run: files to raw tables, raw to clinical tables, clinical tables to analytics.

Each stage reads tables and files and writes tables; a run id ties its rows together, so a stage can be restricted to one
run. What a stage writes is staged first; findings and counts come from the staged rows, without a second parse. When the
stage is over, its tables' partitions of the run are replaced, each in one commit, so a stage that fails changes nothing.

Runs have an order, that of their first start (table pipeline_runs, append-only). A run knows the persons of earlier runs,
also when it is replayed after later ones. If a replay ends with other persons or links than before, the later runs are
marked STALE, and `replay` runs them again in their order. The order of arrival (file, place in it) is kept in the stored
times: rows of a run are microseconds apart.
"""

from __future__ import annotations

import argparse
import datetime as dt
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions.columns import stable_id
from carelattice.operators import csvbatch, dq, fhir, gold, hl7, identity, terminology
from carelattice.operators.shared import checkpoint, numbered
from carelattice.sources.files import csv_rows, fhir_files, hl7_files, table_rows, whole_files
from carelattice.sources.writers import Staging, append, create_tables, truncate


@dataclass
class Config:
    database: str
    run_id: str
    run_ts: dt.datetime
    as_of: dt.date
    measurement_year: int
    hl7_path: str | None = None
    fhir_path: str | None = None
    csv_patients_path: str | None = None
    csv_labs_path: str | None = None
    default_tenant: str | None = None
    environment: str = "prod"
    include_hl7_patients: bool = False
    gate_on_errors: bool = False
    lenient: bool = False
    global_ids: bool = False
    upstream_run: str | None = None
    first_only: bool = False
    write: bool = True
    stage_seconds: float | None = None
    version: str = "1.0.0"
    run_seq: int | None = None
    done: list[str] = field(default_factory=list)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def _stamp(df: DataFrame, cfg: Config) -> DataFrame:
    now = F.lit(cfg.run_ts).cast("timestamp")
    return df.withColumns({"pipeline_run_id": F.lit(cfg.run_id), **{c: now for c in ("received_at", "created_at", "detected_at", "generated_at", "exported_at", "first_seen_at", "last_seen_at", "completed_at", "started_at") if c not in df.columns}})


def _log(cfg: Config, out: Staging, found: DataFrame, source: str) -> None:
    out.later(_stamp(found.withColumns({"source_table": F.lit(source), "resolved": F.lit(False)}), cfg), "audit_validation_errors")


def _audit(cfg: Config, out: Staging, counts: DataFrame, source: str, target: str) -> None:
    """counts: source_name, record_count, pass_count, error_count and, if it isn't the default, tenant_id."""
    rows = counts.withColumns({"source_system": F.lit(source), "target_table": F.lit(target), "log_id": stable_id(F.lit(cfg.run_id), F.lit(target), F.lit(source), "source_name")})
    out.later(_stamp(rows if "tenant_id" in rows.columns else rows.withColumn("tenant_id", F.lit(cfg.default_tenant)), cfg), "audit_ingest_log")


def _audit_messages(cfg: Config, out: Staging, staged: DataFrame, source: str, target: str) -> None:
    counts = dq.audit_log(staged, ["file_name"], F.col("validation_status") == "ERROR")
    _audit(cfg, out, counts.withColumnRenamed("file_name", "source_name"), source, target)


def ingest_hl7(spark: SparkSession, cfg: Config, out: Staging) -> None:
    parsed = hl7.parse_adt(hl7.parse_messages(hl7_files(spark, cfg.hl7_path), cfg.default_tenant, lenient=cfg.lenient))
    # sorts as the messages arrived, and tells them from those of other runs
    parsed = parsed.withColumn("message_id", F.concat_ws("/", F.lit(cfg.run_id), "file_name", F.substring(stable_id("file_path"), 1, 8), F.lpad(F.col("arrival_seq").cast("string"), 10, "0")))
    parsed = parsed.withColumns({"source_facility": F.col("sending_facility"), "findings": dq.found(dq.hl7_rules(lenient=cfg.lenient))})
    staged = out.add(_stamp(parsed, cfg), "ingest_hl7_messages", ("file_name", "findings"))
    _log(cfg, out, dq.findings(staged, "findings", "message_id", ["tenant_id"]), "ingest_hl7_messages")
    _audit_messages(cfg, out, staged, "HL7", "ingest_hl7_messages")


def ingest_fhir(spark: SparkSession, cfg: Config, out: Staging) -> None:
    parsed = fhir.parse_bundles(fhir_files(spark, cfg.fhir_path), cfg.default_tenant)
    order = numbered(parsed.select("file_path", F.col("arrival_seq").alias("place")), ["file_path", "place"])
    rows = parsed.drop("bundle").withColumnRenamed("arrival_seq", "place").join(order, ["file_path", "place"]).withColumn("received_at", _at(cfg, "arrival_seq"))
    staged = out.add(_stamp(rows, cfg), "ingest_fhir_bundles", ("file_name",))
    _log(cfg, out, dq.fhir_findings(parsed), "ingest_fhir_bundles")
    _audit_messages(cfg, out, staged, "FHIR", "ingest_fhir_bundles")


def ingest_csv(spark: SparkSession, cfg: Config, out: Staging) -> None:
    for kind, path in (("patients", cfg.csv_patients_path), ("labs", cfg.csv_labs_path)):
        if not path:
            continue
        rows, files = checkpoint(csv_rows(spark, path)), whole_files(spark, path)
        found = out.add(_stamp(dq.csv_bronze_findings(rows, kind).withColumns({"source_table": F.lit("ingest_csv_batches"), "resolved": F.lit(False), "source_name": F.col("file_name"), "tenant_id": F.lit(cfg.default_tenant)}), cfg), "audit_validation_errors", ("file_name",))
        batches = csvbatch.csv_batches(rows, ["file_name"], found).join(files.select("file_name", F.col("file_size").alias("file_size_bytes"), F.col("value").alias("raw_content")), "file_name")
        batches = batches.withColumns({"batch_id": stable_id(F.lit(cfg.run_id), "file_name"), "file_type": F.lit(kind), "tenant_id": F.lit(cfg.default_tenant), "source_system": F.lit("CSV")})
        staged = out.add(_stamp(batches, cfg), "ingest_csv_batches", ("file_name",))
        _audit(cfg, out, dq.csv_audit(staged, found), "CSV", "ingest_csv_batches")


def _upstream(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    """A table's rows, those of one run if the run is restricted; gated, without what had errors."""
    rows = table_rows(spark, cfg.table(name), cfg.upstream_run)
    return rows.filter("validation_status <> 'ERROR'") if cfg.gate_on_errors and "validation_status" in rows.columns else rows


def _at(cfg: Config, order: str) -> Column:
    """The run's time and as many microseconds as rows came before."""
    return F.timestamp_micros(F.unix_micros(F.lit(cfg.run_ts).cast("timestamp")) + F.col(order).cast("long"))


def _runs(spark: SparkSession, cfg: Config) -> DataFrame:
    """run_id and run_seq of all runs."""
    return spark.table(cfg.table("pipeline_runs")).filter("event = 'REGISTERED'").select(F.col("pipeline_run_id").alias("run_id"), "run_seq")


def _record(spark: SparkSession, cfg: Config, run_id: str, run_seq: int, event: str, outcome: str | None = None) -> None:
    row = spark.createDataFrame([(run_seq, event, outcome, run_id)], "run_seq long, event string, outcome string, pipeline_run_id string")
    append(row.withColumn("recorded_at", F.current_timestamp()), cfg.table("pipeline_runs"))


def register(spark: SparkSession, cfg: Config) -> int:
    """The place of this run in the order of runs: that of its first start."""
    if cfg.run_seq is None:
        found = _runs(spark, cfg).agg(F.max("run_seq").alias("last"), F.max(F.when(F.col("run_id") == cfg.run_id, F.col("run_seq"))).alias("own")).first()
        cfg.run_seq = found.own or (found.last or 0) + 1
        if found.own is None:
            _record(spark, cfg, cfg.run_id, cfg.run_seq, "REGISTERED")
    return cfg.run_seq


def run_state(spark: SparkSession, cfg: Config) -> DataFrame:
    """run_id, run_seq, event and outcome: of every run what was recorded last about its persons (DONE or STALE)."""
    events = spark.table(cfg.table("pipeline_runs")).filter("event <> 'REGISTERED'")
    last = events.groupBy(F.col("pipeline_run_id").alias("run_id")).agg(F.max_by(F.struct("event", "outcome"), "recorded_at").alias("last"))
    return _runs(spark, cfg).join(last, "run_id", "left").select("run_id", "run_seq", "last.event", "last.outcome")


def _outcome(spark: SparkSession, cfg: Config) -> str:
    """A number that two equal sets of persons and links have in common, whatever their order."""
    columns = {"mpi_patient_index": ["umpi"], "mpi_identity_crosswalk": ["umpi", "source_record_id", "source_mrn", "source_facility_npi"], "clinical_patients": ["umpi", "family_name", "given_name", "birth_date", "postal_code"]}
    parts = [table_rows(spark, cfg.table(t), cfg.run_id).select(F.xxhash64(F.lit(t), *c).cast("decimal(38,0)").alias("h")) for t, c in columns.items()]
    r = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0)).alias("h")).first()
    return f"{r.n}:{r.h}"


def _settle(spark: SparkSession, cfg: Config) -> None:
    """Record what persons the run ended with; if a replay ended with others, later runs have to be replayed."""
    states = {r.run_id: r for r in run_state(spark, cfg).collect()}  # one row a run
    own, outcome = states[cfg.run_id], _outcome(spark, cfg)
    _record(spark, cfg, cfg.run_id, own.run_seq, "DONE", outcome)
    if own.event is not None and own.outcome != outcome:
        for r in sorted(states.values(), key=lambda r: r.run_seq):
            if r.run_seq > own.run_seq and r.event == "DONE":
                _record(spark, cfg, r.run_id, r.run_seq, "STALE", r.outcome)


def stale_runs(spark: SparkSession, cfg: Config) -> list[str]:
    """The runs that have to be replayed, in their order."""
    return [r.run_id for r in run_state(spark, cfg).filter("event = 'STALE'").orderBy("run_seq").collect()]


def replay(spark: SparkSession, configs: list[Config], stages: list[str] | None = None) -> list[str]:
    """Run the stale ones of these runs again, in their order, until none is stale; the ids of those that were run."""
    by, done = {c.run_id: c for c in configs}, []
    while names := [r for r in stale_runs(spark, configs[0]) if r in by]:
        run(spark, by[names[0]], stages or ["silver", "gold"])
        done.append(names[0])
    return done


def _known(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """The persons of earlier runs, as seeds in the order in which they were stored."""
    people = spark.table(cfg.table("clinical_patients")).withColumn("place", F.concat_ws("/", F.lpad(F.unix_micros("created_at").cast("string"), 20, "0"), "patient_id"))
    links = spark.table(cfg.table("mpi_identity_crosswalk")).withColumn("place", F.col("crosswalk_id"))
    return identity.seeds_before(people, links, _runs(spark, cfg), register(spark, cfg))


def known_persons(spark: SparkSession, cfg: Config) -> DataFrame:
    """The index as of this run: its persons and those of earlier runs, each with valid_from and its records up to then."""
    return identity.person_index(spark.table(cfg.table("mpi_patient_index")), spark.table(cfg.table("mpi_identity_crosswalk")), _runs(spark, cfg), register(spark, cfg))


def _bundles(spark: SparkSession, cfg: Config) -> DataFrame:
    rows = _upstream(spark, cfg, "ingest_fhir_bundles")
    return fhir.resources(fhir.parse_bundles(rows.select("raw_bundle", F.unix_micros("received_at").alias("arrival_seq")), cfg.default_tenant))


def _csv_table(spark: SparkSession, cfg: Config, kind: str, columns: tuple[str, ...]) -> DataFrame:
    rows = _upstream(spark, cfg, "ingest_csv_batches").filter(F.col("file_type") == kind)
    if cfg.first_only:  # of each source system the first batch
        first = rows.groupBy("source_system").agg(F.min(F.struct("received_at", "batch_id"))["batch_id"].alias("batch_id"))
        rows = rows.join(first, ["source_system", "batch_id"], "left_semi")
    return csvbatch.payload_rows(rows.select("batch_id", "file_name", "tenant_id", "source_system", "raw_content"), columns)


def silver(spark: SparkSession, cfg: Config, out: Staging) -> None:
    truncate(spark, [cfg.table(t) for t in ("mpi_patient_index", "mpi_identity_crosswalk", "clinical_patients", "clinical_encounters", "clinical_observations", "clinical_conditions")], cfg.environment)
    resources = checkpoint(_bundles(spark, cfg))
    people = fhir.clinical_patients(resources)
    keys = fhir.patient_identities(resources).select("arrival_seq", "bundle_id", "entry_index", "source_id", "tenant_id", "source_system", "source_mrn", "source_identifier_system", "family_name", "given_name", "birth_date", "gender", "postal_code", "ssn_last4")
    of_csv = csvbatch.patients(_csv_table(spark, cfg, "patients", csvbatch.PATIENT_COLUMNS))
    messages = _upstream(spark, cfg, "ingest_hl7_messages").select("message_id", "raw_message", F.col("source_system").alias("_system"), "tenant_id")
    adt = hl7.admissions(hl7.parse_adt(hl7.parse_messages(messages.drop("tenant_id"), cfg.default_tenant, lenient=cfg.lenient)))
    wanted = ["origin", "turn", "place", "part", "source_id", "tenant_id", "source_system", "source_mrn", "source_facility_npi", "source_identifier_system", "family_name", "given_name", "birth_date", "gender", "postal_code", "ssn_last4"]
    shape = lambda df: df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast("date" if c == "birth_date" else "string").alias(c) for c in wanted))
    records = shape(keys.withColumns({"origin": F.lit("1fhir"), "turn": F.lpad(F.col("arrival_seq").cast("string"), 20, "0"), "place": F.col("bundle_id"), "part": F.lpad(F.col("entry_index").cast("string"), 12, "0")}))
    records = records.unionByName(shape(of_csv.withColumns({"origin": F.lit("2csv"), "turn": F.col("file_name"), "place": F.col("batch_id"), "part": F.lpad(F.col("row_idx").cast("string"), 12, "0"), "source_id": F.col("source_record_id")})))
    hl7_people = adt.withColumns({"origin": F.lit("3hl7"), "place": F.col("message_id"), "part": F.lit("0"), "source_id": F.col("message_id"), "source_mrn": F.col("mrn"), "source_facility_npi": F.col("mrn_facility"), "source_identifier_system": F.lit("urn:hl7:adt")})
    records = records.unionByName(shape(hl7_people))
    # the order of arrival: source, file or bundle, place in it; a global number by a sort of the whole and counts by partition
    records = numbered(records, ["origin", "turn", "place", "part"]).withColumn("record_key", F.concat_ws("/", F.lit(cfg.run_id), "origin", "place", "part"))
    resolved = checkpoint(identity.resolve(records, seeds=_known(spark, cfg)))
    shown = resolved if cfg.include_hl7_patients else resolved.filter("origin <> '3hl7'")
    def put(table: str, *frames: DataFrame) -> None:
        _audit_rows(cfg, out, out.add_all([_stamp(df, cfg) for df in frames], table), table)

    put("mpi_patient_index", identity.patient_index(shown).withColumn("tenant_ids", F.array("tenant_id")))
    put("mpi_identity_crosswalk", identity.crosswalk(shown).withColumn("source_record_id", F.col("source_id")))
    of = lambda origin: resolved.filter(F.col("origin") == origin)
    fhir_umpi = of("1fhir").select(F.col("place").alias("bundle_id"), "source_id", "umpi", "arrival_seq")
    csv_umpi = of("2csv").select(F.col("place").alias("batch_id"), F.col("part").cast("long").alias("row_idx"), "umpi", F.col("arrival_seq").alias("subject_seq"))
    hl7_umpi = of("3hl7").select(F.col("place").alias("message_id"), "umpi", F.col("arrival_seq").alias("subject_seq"))
    timed = lambda df: df.withColumn("created_at", _at(cfg, "subject_seq"))
    link = lambda df: fhir.link_subjects(df, fhir_umpi, cfg.global_ids)
    # persons of this run by their first record; those of earlier runs by the index
    minted = resolved.filter("is_new_record").select("umpi", "given_name", "family_name", "birth_date", "gender", "postal_code")
    none = F.lit(None).cast("string")
    earlier = identity.as_of(spark.table(cfg.table("mpi_patient_index")), _runs(spark, cfg), register(spark, cfg)).select("umpi", "given_name", "family_name", "birth_date", none.alias("gender"), none.alias("postal_code"))
    named = identity.filled(link(people.withColumn("subject_key", F.col("source_record_id"))), minted.unionByName(earlier))
    csv_people = of_csv.join(csv_umpi, ["batch_id", "row_idx"])
    patients = [named.withColumn("patient_id", stable_id("bundle_id", "source_record_id")), csv_people.withColumn("patient_id", stable_id("batch_id", "row_idx"))]
    if cfg.include_hl7_patients:
        patients.append(adt.join(hl7_umpi, "message_id").withColumn("patient_id", stable_id("message_id")))
    put("clinical_patients", *map(timed, patients))
    visits = link(fhir.encounters(resources)).withColumn("encounter_id", stable_id("bundle_id", "source_record_id"))
    linked = adt.join(hl7_umpi, "message_id")
    put("clinical_encounters", timed(visits), timed(hl7.adt_encounters(linked).withColumn("facility_name", F.col("facility"))))
    problems = link(fhir.conditions(resources)).withColumn("condition_id", stable_id("bundle_id", "source_record_id"))
    put("clinical_conditions", *map(timed, (problems, hl7.adt_conditions(linked), csvbatch.conditions(csv_people))))
    coded = link(terminology.normalize_observations(fhir.observations(resources))).withColumn("observation_id", stable_id("bundle_id", "source_record_id"))
    labs = terminology.code_labs(csvbatch.labs(_csv_table(spark, cfg, "labs", csvbatch.LAB_COLUMNS)))
    labs = csvbatch.link_patients(labs, csv_people).withColumns({"observation_id": stable_id("batch_id", "row_idx"), "subject_seq": F.col("row_idx")})
    for df, source in ((coded, "ingest_fhir_bundles"), (labs, "ingest_csv_batches")):
        # one coded frame feeds the table, its log, and what had no code
        log = F.struct(*(c for c in df.columns if c not in ("resource",)))
        both = checkpoint(timed(df).select(log.alias("r"))).select("r.*")
        staged = out.add(_stamp(terminology.mapped(both), cfg), "clinical_observations")
        lost = out.add(_stamp(terminology.unmapped(both).withColumn("source_table", F.lit(source)), cfg), "terminology_unmapped_codes")
        out.add(_stamp(terminology.normalization_log(both, source, "clinical_observations", cfg.version), cfg).withColumn("processed_ts", F.lit(cfg.run_ts).cast("timestamp")), "terminology_normalization_log")
        _audit_rows(cfg, out, staged, "clinical_observations", lost)
    _log(cfg, out, dq.csv_silver_findings(_csv_table(spark, cfg, "patients", csvbatch.PATIENT_COLUMNS)), "clinical_patients")
    _log(cfg, out, dq.csv_lab_findings(labs), "clinical_observations")


def _audit_rows(cfg: Config, out: Staging, staged: DataFrame, table: str, lost: DataFrame | None = None) -> None:
    """What a clinical table got from a source system, by tenant; records without a target code count as errors."""
    by = lambda df, name: df.groupBy(F.col("tenant_id") if "tenant_id" in df.columns else F.lit(None).cast("string").alias("tenant_id")).agg(F.count("*").alias(name))
    counts = by(staged, "pass_count").withColumn("error_count", F.lit(0).cast("long"))
    if lost is not None:
        gone = by(lost, "error_count").withColumn("pass_count", F.lit(0).cast("long"))
        counts = counts.unionByName(gone).groupBy("tenant_id").agg(F.sum("pass_count").alias("pass_count"), F.sum("error_count").alias("error_count"))
    part = len(out.waiting.get("audit_ingest_log", ()))
    rows = counts.withColumns({"record_count": F.col("pass_count") + F.col("error_count"), "source_name": F.concat_ws("/", F.lit(str(part)), "tenant_id")})
    _audit(cfg, out, rows, "SILVER", table)


def to_gold(spark: SparkSession, cfg: Config, out: Staging) -> None:
    read = lambda t: table_rows(spark, cfg.table(t), cfg.upstream_run)
    came = F.unix_micros("created_at")  # rows keep the order of their arrival in it
    people = read("clinical_patients").withColumn("arrival_seq", F.struct("created_at", "patient_id"))
    visits = read("clinical_encounters").withColumn("arrival_seq", came)
    problems = read("clinical_conditions").withColumns({"diagnosis_rank": F.when(F.col("condition_category") == "primary", 1).when(F.col("condition_category") == "secondary", 2), "arrival_seq": F.struct("created_at", "condition_id")})
    labs = read("clinical_observations").withColumn("arrival_seq", came)
    summary = gold.patient_summary(people, visits, problems, cfg.as_of)
    out.add(_stamp(gold.summary_table(summary), cfg), "analytics_patient_summary")
    out.add(_stamp(gold.hba1c_control(people, problems, labs, cfg.measurement_year), cfg), "analytics_quality_measures")
    feed = gold.adt_feed(gold.adt_events(visits), problems).withColumn("event_id", stable_id("encounter_id", "event_type"))
    out.add(_stamp(feed, cfg), "analytics_adt_events")
    out.add(_stamp(gold.uscdi_export(gold.first_rows(people)), cfg), "export_uscdi_v3_patient")
    links = read("mpi_identity_crosswalk").withColumn("is_new_record", F.col("match_method") == identity.NEW)
    scores = gold.tenant_scorecard(people, labs, problems, links).withColumn("scorecard_id", stable_id(F.lit(cfg.run_id), "tenant_id"))
    out.add(_stamp(scores, cfg), "dq_tenant_scorecard")


WRITES = {
    "hl7": ("ingest_hl7_messages",), "fhir": ("ingest_fhir_bundles",), "csv": ("ingest_csv_batches",),
    "silver": ("mpi_patient_index", "mpi_identity_crosswalk", "clinical_patients", "clinical_encounters", "clinical_conditions", "clinical_observations", "terminology_unmapped_codes", "terminology_normalization_log"),
    "gold": ("analytics_patient_summary", "analytics_quality_measures", "analytics_adt_events", "export_uscdi_v3_patient", "dq_tenant_scorecard"),
}
STAGES = {"hl7": ingest_hl7, "fhir": ingest_fhir, "csv": ingest_csv, "silver": silver, "gold": to_gold}


class StageTimeout(RuntimeError):
    """A stage took longer than it may."""


def _within(spark: SparkSession, name: str, seconds: float | None, work: Callable[[], None]) -> None:
    """Run work as a job group that is cancelled after so many seconds."""
    if seconds is None:
        work()
        return
    group, over = f"{name}-{uuid.uuid4()}", threading.Event()

    def cancel() -> None:
        over.set()
        while not ended.wait(0.2):  # jobs that begin meanwhile, too
            spark.sparkContext.cancelJobGroup(group)

    ended, timer = threading.Event(), threading.Timer(seconds, cancel)
    spark.sparkContext.setJobGroup(group, name, interruptOnCancel=True)
    timer.start()
    try:
        work()
    except Exception as e:
        if over.is_set():
            raise StageTimeout(f"stage {name} took more than {seconds:g} s") from e
        raise
    finally:
        timer.cancel()
        ended.set()
        spark.sparkContext._jsc.sc().clearJobGroup()
    if over.is_set():
        raise StageTimeout(f"stage {name} took more than {seconds:g} s")


def run(spark: SparkSession, cfg: Config, stages: list[str] | None = None) -> Config:
    """Run the stages in order; the first that fails, or takes longer than cfg.stage_seconds, ends the run.

    Ingestion stages without a path are skipped. What an earlier attempt of this run has written to a stage's tables is
    replaced when the stage is over. With cfg.write off, every stage is worked out whole, but nothing is put in place.
    """
    create_tables(spark, cfg.database)
    register(spark, cfg)
    for name in stages or list(STAGES):
        if name == "hl7" and not cfg.hl7_path or name == "fhir" and not cfg.fhir_path or name == "csv" and not (cfg.csv_patients_path or cfg.csv_labs_path):
            continue
        out = Staging(spark, cfg.database, cfg.run_id)
        try:
            _within(spark, name, cfg.stage_seconds, lambda: (STAGES[name](spark, cfg, out), out.finish()))
            if cfg.write:
                own = {"audit_validation_errors": F.col("source_table").isin(*WRITES[name]), "audit_ingest_log": F.col("target_table").isin(*WRITES[name])}
                out.commit(WRITES[name], own)
        finally:
            out.close()
        if name == "silver" and cfg.write:
            _settle(spark, cfg)
        cfg.done.append(name)
    return cfg


def main(argv: list[str] | None = None) -> None:
    from carelattice.session import get_session

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--database", default="carelattice")
    p.add_argument("--run-id", required=True)
    p.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    p.add_argument("--year", type=int, required=True)
    for name in ("hl7", "fhir", "csv-patients", "csv-labs"):
        p.add_argument(f"--{name}")
    p.add_argument("--default-tenant")
    p.add_argument("--stages", nargs="*", choices=list(STAGES))
    p.add_argument("--upstream-run", help="read this run's rows only")
    p.add_argument("--stage-seconds", type=float, help="cancel a stage that takes longer")
    for name in ("gate-on-errors", "lenient", "global-ids", "include-hl7-patients", "first-only", "no-write"):
        p.add_argument(f"--{name}", action="store_true")
    a = p.parse_args(argv)
    at = dt.datetime.combine(a.as_of, dt.time())
    run(get_session(), Config(a.database, a.run_id, at, a.as_of, a.year, a.hl7, a.fhir, a.csv_patients, a.csv_labs, a.default_tenant, include_hl7_patients=a.include_hl7_patients, gate_on_errors=a.gate_on_errors, lenient=a.lenient, global_ids=a.global_ids, upstream_run=a.upstream_run, first_only=a.first_only, write=not a.no_write, stage_seconds=a.stage_seconds), a.stages)


if __name__ == "__main__":
    main()
