"""Files to analytics on a small set, the streaming feeds, and the queries against their SQL."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from carelattice.plans import faults, oracle, pipeline, queries
from carelattice.plans.pipeline import Config, run
from carelattice.streaming import feeds

from .test_clinical import ADT, BUNDLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="module")
def small(spark):
    """Many small jobs: compiling them and planning them anew would take longer than they do."""
    conf = {"spark.sql.codegen.wholeStage": "false", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_run(spark, tmp_path):
    for name, text in {"hl7/a.txt": ADT.replace("\r", "\n") + "\n\nMSH broken", "fhir/b.json": json.dumps([BUNDLE]), "p/p.csv": "patient_id,first_name,last_name,dob,gender,ssn_last4,address,city,state,zip,phone,pcp_npi,insurance_id,last_visit_date,primary_dx_icd10\nPT1,Elena,Alvarez,1958-04-12,F,6789,\"1 A St, 2\",Tulsa,OK,74101,,NPI-1,I1,2024-01-01,I10\n", "l/l.csv": "result_id,patient_id,collection_date,test_code,test_name,result_value,result_unit,reference_range_low,reference_range_high,abnormal_flag,ordering_provider_npi,status\nR1,PT1,2024-05-05,A1C,Hb,7.1,%,4,6,,N,final\nR2,PT9,2024-05-05,Q,zzz,POS,%,4,6,,N,final\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    db = "run_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    try:
        cfg = Config(db, "r1", dt.datetime(2024, 6, 1), dt.date(2024, 6, 1), 2024, str(tmp_path / "hl7"), str(tmp_path / "fhir"), str(tmp_path / "p"), str(tmp_path / "l"), None)
        assert run(spark, cfg).done == ["hl7", "fhir", "csv", "silver", "gold"]
        n = lambda t: spark.table(f"{db}.{t}").count()
        assert (n("ingest_hl7_messages"), n("ingest_fhir_bundles"), n("ingest_csv_batches")) == (1, 1, 2)
        links = spark.table(f"{db}.mpi_identity_crosswalk").collect()
        assert len({r.umpi for r in links}) == 1 and sorted(r.match_method for r in links) == ["NEW_RECORD", "SSN4_DOB_NAME"]
        assert (n("clinical_patients"), n("clinical_encounters"), n("clinical_observations"), n("terminology_unmapped_codes")) == (2, 2, 2, 2)
        summary = spark.table(f"{db}.analytics_patient_summary").collect()
        assert len(summary) == 1 and summary[0].charlson_index == 1 and summary[0].chronic_condition_flags["DIABETES"] and summary[0].chronic_condition_flags["HYPERTENSION"]
        measure = spark.table(f"{db}.analytics_quality_measures").first()
        assert measure.in_numerator and measure.evidence_value == 7.1
        assert n("analytics_adt_events") == 3 and n("export_uscdi_v3_patient") == 1 and n("audit_validation_errors") >= 3
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_two_runs(spark, tmp_path):
    header = "patient_id,first_name,last_name,dob,gender,ssn_last4,address,city,state,zip,phone,pcp_npi,insurance_id,last_visit_date,primary_dx_icd10\n"
    row = "{0},{1},Smith,19{2}-01-02,F,,1 A St,Tulsa,OK,74101,,NPI-1,I1,2024-01-01,I10\n"
    files = {
        "one": {"a.csv": [("PT1", "Ann", 50), ("PT2", "Bea", 60), ("PT2", "Bea", 60)], "b.csv": [("PT1", "Ann", 50), ("PT3", "Cat", 70)]},
        # PT1 by number and facility, another number with Bea's name and birth date, and somebody new
        "two": {"a.csv": [("PT1", "Anna", 55), ("PT9", "Bea", 60), ("PT4", "Dot", 80)]},
    }
    for name, parts in files.items():
        (tmp_path / name).mkdir()
        for file, rows in parts.items():
            (tmp_path / name / file).write_text(header + "".join(row.format(*r) for r in rows))
    db = "two_runs"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    try:
        day = dt.date(2024, 6, 1)
        one = Config(db, "r1", dt.datetime(2024, 6, 1), day, 2024, csv_patients_path=str(tmp_path / "one"))
        two = Config(db, "r2", dt.datetime(2024, 6, 2), day, 2024, csv_patients_path=str(tmp_path / "two"), upstream_run="r2")
        run(spark, one, ["csv", "silver"])
        table = lambda t: spark.table(f"{db}.{t}")
        first = {r.source_record_id: r.umpi for r in table("clinical_patients").collect()}
        found = table("audit_validation_errors").filter("error_code like 'CSV_DUPLICATE%'").collect()
        assert len(set(first.values())) == 3 and [r.source_record_id for r in found] == ["3:PT2", "3:PT2"]
        counts = lambda: {t.name: table(t.name).count() for t in spark.catalog.listTables(db) if t.name != "pipeline_runs"}
        before = counts()
        run(spark, one, ["csv", "silver"])  # again: its rows are replaced
        assert counts() == before and {r.source_record_id: r.umpi for r in table("clinical_patients").collect()} == first
        run(spark, two, ["csv", "silver"])
        links = {r.source_record_id: r for r in table("mpi_identity_crosswalk").filter("pipeline_run_id = 'r2'").collect()}
        assert (links["PT1"].umpi, links["PT1"].match_method) == (first["PT1"], "MRN_NPI")
        assert (links["PT9"].umpi, links["PT9"].match_method) == (first["PT2"], "DOB_NAME_ZIP")
        assert links["PT4"].match_method == "NEW_RECORD" and links["PT4"].umpi not in first.values()
        assert table("mpi_patient_index").count() == 4
        order = [r.source_record_id for r in table("clinical_patients").filter("pipeline_run_id = 'r1'").orderBy("created_at").collect()]
        assert order == ["PT1", "PT2", "PT2", "PT1", "PT3"]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


HEADER = "patient_id,first_name,last_name,dob,gender,ssn_last4,address,city,state,zip,phone,pcp_npi,insurance_id,last_visit_date,primary_dx_icd10\n"
ROW = "{0},{1},Smith,19{2}-01-02,F,,1 A St,Tulsa,OK,74101,,NPI-1,I1,2024-01-01,I10\n"


def _write(path, rows):
    path.mkdir(exist_ok=True)
    (path / "a.csv").write_text(HEADER + "".join(ROW.format(*r) for r in rows))
    return str(path)


@pytest.fixture
def database(spark):
    db = "runs_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    yield db
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def _config(db, run_id, path, **more):
    return Config(db, run_id, dt.datetime(2024, 6, 1), dt.date(2024, 6, 1), 2024, csv_patients_path=path, upstream_run=run_id, **more)


def _state(spark, db):
    keep = {"mpi_patient_index": ["umpi", "family_name", "given_name", "birth_date", "linked_record_count"], "mpi_identity_crosswalk": ["umpi", "source_record_id", "match_method", "match_confidence"], "clinical_patients": ["umpi", "source_record_id", "given_name"]}
    return {t: sorted(map(str, spark.table(f"{db}.{t}").select("pipeline_run_id", *c).collect())) for t, c in keep.items()}


def test_replay_of_an_earlier_run(spark, tmp_path, database):
    one = _config(database, "r1", _write(tmp_path / "one", [("PT1", "Ann", 50), ("PT2", "Bea", 60)]))
    two = _config(database, "r2", _write(tmp_path / "two", [("PT1", "Ann", 50), ("PT3", "Cy", 70)]))
    stages = ["csv", "silver"]
    run(spark, one, stages)
    run(spark, two, stages)
    before = _state(spark, database)
    run(spark, one, ["silver"])
    assert _state(spark, database) == before and pipeline.stale_runs(spark, one) == []
    persons = lambda c: {r.given_name: (r.valid_from, r.linked_record_count) for r in pipeline.known_persons(spark, c).collect()}
    assert persons(one) == {"Ann": (1, 1), "Bea": (1, 1)} and persons(two) == {"Ann": (1, 2), "Bea": (1, 1), "Cy": (2, 1)}
    # the first run's file now lacks Ann: the second run has to be replayed, and then she is its own
    _write(tmp_path / "one", [("PT2", "Bea", 60)])
    run(spark, one, stages)
    assert pipeline.stale_runs(spark, one) == ["r2"]
    assert pipeline.replay(spark, [one, two], ["silver"]) == ["r2"] and pipeline.stale_runs(spark, one) == []
    assert persons(two) == {"Ann": (2, 1), "Bea": (1, 1), "Cy": (2, 1)}
    links = {r.source_record_id: r.match_method for r in spark.table(f"{database}.mpi_identity_crosswalk").filter("pipeline_run_id = 'r2'").collect()}
    assert links == {"PT1": "NEW_RECORD", "PT3": "NEW_RECORD"}


def test_a_stage_that_fails_changes_nothing(spark, tmp_path, database, monkeypatch):
    cfg = _config(database, "r1", _write(tmp_path / "one", [("PT1", "Ann", 50), ("", "Bea", 60)]))
    run(spark, cfg, ["csv", "silver"])
    tables = [t.name for t in spark.catalog.listTables(database) if t.name != "pipeline_runs"]
    show = lambda: {t: sorted(map(str, spark.table(f"{database}.{t}").drop("processed_ts").collect())) for t in tables}
    before = show()
    audit = {(r.source_system, r.target_table): (r.record_count, r.pass_count, r.error_count) for r in spark.table(f"{database}.audit_ingest_log").groupBy("source_system", "target_table").agg(*(F.sum(c).alias(c) for c in ("record_count", "pass_count", "error_count"))).collect()}
    assert audit["CSV", "ingest_csv_batches"] == (2, 1, 1) and audit["SILVER", "clinical_patients"] == (2, 2, 0) and audit["SILVER", "clinical_conditions"] == (2, 2, 0)
    _write(tmp_path / "one", [("PT7", "Eve", 51)])
    real = pipeline.csvbatch.conditions

    def broken(people):
        return real(people).withColumn("onset_datetime", F.raise_error(F.lit("half-way")).cast("timestamp"))

    monkeypatch.setattr(pipeline.csvbatch, "conditions", broken)
    with pytest.raises(Exception, match="half-way"):
        run(spark, cfg, ["silver"])
    assert show() == before
    monkeypatch.setattr(pipeline.csvbatch, "conditions", real)
    # nothing is put in place without writing
    assert run(spark, _config(database, "r1", cfg.csv_patients_path, write=False), ["csv"]).done == ["csv"] and show() == before
    run(spark, cfg, ["csv", "silver"])
    assert [r.source_record_id for r in spark.table(f"{database}.clinical_patients").collect()] == ["PT7"]
    assert spark.table(f"{database}.audit_validation_errors").filter("error_code = 'CSV_MISSING_REQUIRED_FIELD'").count() == 0


def test_a_stage_that_takes_too_long(spark, tmp_path, database, monkeypatch):
    cfg = _config(database, "r1", _write(tmp_path / "one", [("PT1", "Ann", 50)]), stage_seconds=3)
    began, seen = time.time(), []

    def slow(spark, cfg, out):
        spark.range(0, 4, 1, 4).mapInPandas(lambda batches: (time.sleep(60) or b for b in batches), "id long").collect()

    monkeypatch.setitem(pipeline.STAGES, "csv", slow)
    monkeypatch.setitem(pipeline.STAGES, "silver", lambda *a: seen.append(a))
    with pytest.raises(pipeline.StageTimeout):
        run(spark, cfg, ["csv", "silver"])
    assert time.time() - began < 40 and not seen and cfg.done == []
    assert spark.range(3).count() == 3


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text(ADT.replace("\r", "\n"))
    (source / "b.txt").write_text(ADT.replace("\r", "\n"))
    query = feeds.distinct_messages(feeds.hl7_stream(spark, str(source))).writeStream.format("memory").queryName("messages").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.family_name for r in spark.table("messages").collect()] == ["Alvarez"]
    t = dt.datetime(2024, 1, 1)
    events = [("u", "A03", t), ("u", "A01", t + dt.timedelta(days=10)), ("u", "A01", t + dt.timedelta(days=31)), ("v", "A01", t)]
    path = str(tmp_path / "events")
    spark.createDataFrame(events, "umpi string, event_type string, event_datetime timestamp").write.parquet(path)
    stream = spark.readStream.schema("umpi string, event_type string, event_datetime timestamp").parquet(path)
    query = feeds.readmission_stream(stream).writeStream.format("memory").queryName("feed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.umpi, r.event_datetime.day, r.is_readmission_30d) for r in spark.table("feed").filter("event_type = 'A01'").collect()) == [("u", 1, False), ("u", 11, True), ("v", 1, False)]


def _rows(df):
    show = lambda v: "None" if v is None or v != v else str(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(show(v) for v in row) for row in df)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")
@pytest.mark.parametrize("name", ["patient_risk_summary", "readmission_30d", "event_readmission", "hba1c_control", "hl7_bronze", "fhir_observations", "csv_labs", "csv_payload", "mpi_resolve", "dq_scorecard", *faults.queries()])
def test_queries(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    expected = con.sql(oracle.sql()[name])
    assert sorted(expected.columns) == columns
    assert _rows(got.select(*map(F.col, columns)).collect()) == _rows(con.sql(f"SELECT {', '.join(columns)} FROM ({oracle.sql()[name]})").fetchall())


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.sql())
