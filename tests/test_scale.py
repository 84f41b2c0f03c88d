"""Figures and results that hold at any size: total orders, one pass over a parse, no shuffle of texts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from carelattice.functions.columns import not_blank, strip, strip_column
from carelattice.operators import dq, gold
from carelattice.plans import fixtures as fx, queries as plans, written
from carelattice.sources import files

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_primary_diagnosis_of_equal_arrival_is_the_later_row(spark):
    events = spark.createDataFrame([("p", "e", "A01", 1)], "umpi string, encounter_id string, event_type string, arrival_seq long").withColumn("event_datetime", F.current_timestamp())
    rows = [("e", i, f"C{i % 7}", 1, 11) for i in range(40)]
    for order in (rows, rows[::-1]):
        dx = spark.createDataFrame(order, "encounter_id string, place long, icd10_code string, diagnosis_rank int, arrival_seq long").withColumn("clinical_status", F.lit("active")).repartition(3)
        assert gold.adt_feed(events, dx, ties=("place",)).first().primary_dx == "C4"


def test_readmission_ties_by_place_in_the_table(spark, tmp_path):
    orders = spark.createDataFrame([(1, 5, "F", "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").withColumn("o_orderdate", F.lit("2000-01-01").cast("timestamp"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i, 1, k, 1, "O") for i, k in enumerate([0, 7, 3, 299, 16, 5, 2])]
    frame = spark.createDataFrame(lines, "i int, l_orderkey long, l_partkey long, l_linenumber int, l_linestatus string").coalesce(1).sortWithinPartitions("i").drop("i")
    frame.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r.primary_dx for r in plans.readmission_30d(spark, str(tmp_path)).collect()} == {fx.CODES[2]}


def test_bundle_text_is_not_shuffled(spark):
    optimized = fx.fhir_raw(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = optimized[optimized.index("Join LeftOuter") :]
    assert "to_json" not in below and "resourceType" not in below


@pytest.mark.parametrize("name", ["fhir_resources", "fhir_dq", "fhir_patients", "fhir_conditions", "fhir_encounters", "fhir_observations", "fhir_bundles", "fhir_counts"])
def test_bundles_are_made_and_parsed_once(spark, name):
    plan = plans.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") + plan.count("l_orderkey#") > 0 and plan.count("collect_list(") == 1


@pytest.mark.parametrize("name", ["hl7_fault_findings", "hl7_birth_dates"])
def test_messages_are_parsed_once(spark, name):
    plan = plans.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_blocks_keep_texts_where_they_are_read(spark, tmp_path):
    spark.createDataFrame([(f'{{"id": {i}}}',) for i in range(50)], "v string").coalesce(1).write.text(str(tmp_path / "f"))
    for found in (files.fhir_files(spark, str(tmp_path / "f")), files.csv_records(spark, str(tmp_path / "f"))):
        assert found.count()
        assert "REPARTITION_BY_COL" not in plan(found) and "BroadcastHashJoin" in plan(found)


def test_wide_rows_of_a_small_table_are_spread(spark):
    assert fx.csv_raw(spark, SF).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_summaries_are_worked_out_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(written, "replace_run", lambda rows, *_: made.append(rows._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(written, "append", lambda rows, *_: made.append(rows._jdf.queryExecution().optimizedPlan().toString()))
    written.stored_summaries(spark, SF)
    assert made and not any("parquet" in p and "l_orderkey" in p for p in made)


def _joined(node) -> list[str]:
    """The inputs of all joins of an optimized plan."""
    sides = [node.children().apply(i) for i in range(node.children().size())]
    return [s.toString() for s in sides if node.nodeName() == "Join"] + [t for s in sides for t in _joined(s)]


@pytest.mark.parametrize("found", [lambda rows: dq.csv_bronze_findings(rows, "patients"), dq.csv_silver_findings])
def test_long_values_are_not_joined_to_find_duplicates(spark, found):
    rows = fx.csv_raw(spark, SF).withColumn("dob", F.repeat(F.lit("19/"), (F.col("row_idx") % 1500).cast("int")))
    plan = found(rows)._jdf.queryExecution().optimizedPlan()
    inputs = _joined(plan)
    assert inputs and not any("repeat(" in i for i in inputs) and plan.toString().count("repeat(") == 1


def test_ends_are_stripped_as_by_the_pattern(spark):
    ends = ["", " ", "\n", "\r\n", "\t \x0b\x0c\x1c\x1f", "\x85", " \x85", " \u2028", "\u2029 ", "\xa0 ", " \n\x85\n", "\u3000"]
    texts = [a + m + b for a in ends for m in ("", "x", "a \n b", "é\x1d\U0001f600") for b in ends]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = rows.select("t", strip(F.col("t")).alias("a"), strip_column(F.col("t")).alias("b"), not_blank(F.col("t")).alias("some")).collect()
    assert [r.a for r in got] == [r.b for r in got] and [r.some for r in got] == [(r.a or "") != "" for r in got]


def _bundle_array(n: int, gap: str) -> bytes:
    inner = ", ".join(f'{{"resource": {{"id": "{i}", "text": "a}}{{ \\\\\\" ]"}}}}' for i in range(20))
    return ("[" + gap.join(f'{{"id": "B{i}", "entry": [{inner}]}}' for i in range(n)) + "]").encode()


def test_elements_are_found_many_chunks_at_once(monkeypatch):
    looked = []
    monkeypatch.setattr(files, "_outside", lambda chunk, inside: looked.append(chunk) or (b"", inside))
    text = _bundle_array(500, ",\n")
    found = list(files._elements(iter(text.split(b"}")), {"file_size": len(text), "block": 0}))
    assert [json.loads(b"".join(parts))["id"] for _, parts in found] == [f"B{i}" for i in range(500)]
    assert len(looked) <= 1


@pytest.mark.parametrize("separator", [b"}", b"},\n"])
@pytest.mark.parametrize("tail", ["", "\n", ",\n", ',\n17, "x}"\n]', ']\n{"b":1},\n', ',\n{"a": [1, {"b": 2}'])
def test_separators_give_the_same_elements(monkeypatch, separator, tail):
    text = _bundle_array(30, ",\n")[:-1] + tail.encode()
    chunks = text.split(b"}")
    one = [b"".join(p) for _, p in files._elements(iter(chunks if chunks[-1] else chunks[:-1]), {"file_size": len(text), "block": 0})]
    monkeypatch.setattr(files, "_MANY", 100)
    chunks = text.split(separator)
    assert one == [b"".join(p) for _, p in files._elements(iter(chunks if chunks[-1] else chunks[:-1]), {"file_size": len(text), "block": 0}, separator)]


@pytest.mark.parametrize("gap", [",\n", ",", "},\n"])
def test_bundles_on_lines_are_few_pieces(spark, tmp_path, monkeypatch, gap):
    made, whole = [], files.numbered_pieces
    monkeypatch.setattr(files, "numbered_pieces", lambda *a: made.append(whole(*a)) or made[-1])
    (tmp_path / "a.json").write_bytes(_bundle_array(200, gap) if gap != "},\n" else b'{"id": "x"},\n' + b"y" * 40_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_007)
    try:
        found = [r.raw_bundle for r in files.fhir_files(spark, str(tmp_path)).orderBy("arrival_seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    if gap == "},\n":
        assert found == ['{"id": "x"}', ",\n" + "y" * 40_000] and made[0][0].count() == 2  # a piece that isn't short: cut at brackets
    else:
        assert [json.loads(x)["id"] for x in found] == [f"B{i}" for i in range(200)]
        assert made[0][0].count() == 200 if gap == ",\n" else made[0][0].count() > 4000


def test_block_states_are_not_joined_to_pieces(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(_bundle_array(20, ","))
    found = files.fhir_files(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    below = found[found.index("MapInArrow") :]
    assert found.count("MapInArrow") == 1 and "FlatMapGroupsInPandas" not in found and "Join" not in below[: below.index("Relation")]


def test_each_bundle_file_has_a_task_of_its_own(spark, monkeypatch):
    tasks = []
    write = DataFrameWriter.text

    def text(writer, path):
        tasks.extend(r.n for r in writer._df.groupBy(F.spark_partition_id()).agg(F.count_distinct("file").alias("n")).collect())
        write(writer, path)

    monkeypatch.setattr(DataFrameWriter, "text", text)
    written.fhir_arrays(spark, SF)
    assert tasks == [1] * written.FILES
