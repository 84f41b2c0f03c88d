"""Sources and sinks."""

from __future__ import annotations

import json

from carelattice.schemas import TABLES
from carelattice.sources import files, writers


def test_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS src_a CASCADE")
    spark.sql("DROP DATABASE IF EXISTS src_b CASCADE")
    try:
        writers.create_tables(spark, "src_a", ["mpi_identity_crosswalk", "dq_tenant_scorecard"])
        writers.create_tables(spark, "src_a", ["dq_tenant_scorecard"])
        writers.clone_tables(spark, "src_a", "src_b")
        assert spark.table("src_b.mpi_identity_crosswalk").columns == TABLES["mpi_identity_crosswalk"].names
        rows = spark.createDataFrame([("r1", "u1"), ("r2", "u2")], "pipeline_run_id string, umpi string")  # other order, columns missing
        writers.append(rows, "src_a.mpi_identity_crosswalk")
        writers.append(rows.limit(0), "src_a.mpi_identity_crosswalk")
        assert [r.umpi for r in files.table_rows(spark, "src_a.mpi_identity_crosswalk", "r2", ["umpi"]).collect()] == ["u2"]
        assert files.table_rows(spark, "src_a.mpi_identity_crosswalk", "").count() == 2
        writers.truncate(spark, ["src_a.mpi_identity_crosswalk"], "prod")
        assert spark.table("src_a.mpi_identity_crosswalk").count() == 2
        writers.truncate(spark, ["src_a.mpi_identity_crosswalk"], "dev")
        assert spark.table("src_a.mpi_identity_crosswalk").count() == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS src_a CASCADE")
        spark.sql("DROP DATABASE IF EXISTS src_b CASCADE")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 'a "b"\nc')], "i int, t string")
    for rows, name in ((df, "array"), (df.limit(0), "none")):
        writers.write_json_array(rows, str(tmp_path / name), ["i"])
        text = "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
        assert json.loads(text) == ([{"i": 1, "t": None}, {"i": 2, "t": 'a "b"\nc'}] if name == "array" else [])
    writers.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text('i,t\n2,"a ""b""\nc"\n')
    assert [(r.i, r.t) for r in files.csv_rows(spark, str(tmp_path / "c")).collect()] == [("2", 'a "b"\nc')]
    whole = files.whole_files(spark, str(tmp_path / "c")).first()
    assert (whole.file_name, whole.file_size) == ("x.csv", 18)
    two = spark.createDataFrame([('[{"a":1},{"b":[2]}]',), (' {"c":3} ',), ("{bad",)], "value string")
    assert sorted(r.raw_bundle for r in files.split_bundles(two).collect()) == sorted(['{"a":1}', '{"b":[2]}', '{"c":3}', "{bad"])
