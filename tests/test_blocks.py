"""Sources whose records span lines and blocks, against whole-file readers."""

from __future__ import annotations

import csv
import json
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from carelattice.sources import files


@pytest.fixture(params=[97, 1000, 1 << 27])
def cut(spark, request):
    """Files are split into blocks of so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def _in_order(df, column):
    return {name: [x for _, x in sorted(rows)] for name, rows in _by_file(df, column).items()}


def _by_file(df, column):
    out = {}
    for r in df.collect():
        out.setdefault(r.file_name, []).append((r.arrival_seq, r[column]))
    return out


def test_hl7_blocks(spark, tmp_path, cut):
    rng = random.Random(3)
    message = lambda i: f"MSH|^~\\&|A|{i}\nPID|1||{'x' * rng.randrange(60)}\nNTE|MSH| within a line\n" + "OBX|\n" * rng.randrange(8)
    texts = {
        "lf.txt": "".join(map(message, range(60))), "cr.txt": "\r".join(message(i).replace("\n", "\r") for i in range(40)), "crlf.txt": "\n\n".join(message(i).replace("\n", "\r\n") for i in range(20)),
        "preamble.txt": "FHS|x\nBHS|y\n" + message(0) + message(1), "none.txt": "no message here\nat all\n", "blank.txt": "\n\n", "long.txt": message(0) + "OBX|" + "y" * 3000 + "\n" + message(1),
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = files.hl7_files(spark, str(tmp_path))
    found = _by_file(got, "raw_message")
    expected = _in_order(files.split_messages(spark.createDataFrame([(n, t) for n, t in texts.items()], "file_name string, value string")), "raw_message")
    assert {n: [x for _, x in sorted(rows)] for n, rows in found.items()} == expected
    assert all(sorted(i for i, _ in rows) == list(range(len(rows))) for rows in found.values())


def test_fhir_blocks(spark, tmp_path, cut):
    rng = random.Random(5)
    odd = ['}{][', 'a "quoted" } \\', "\\", '"', "é}", ","]
    bundle = lambda i: {"resourceType": "Bundle", "id": str(i), "entry": [{"resource": {"id": rng.choice(odd), "deep": [{"x": [1, {"y": "]"}]}] * rng.randrange(4)}} for _ in range(rng.randrange(5))]}
    several = [bundle(i) for i in range(40)]
    texts = {
        "line.json": json.dumps(several), "pretty.json": json.dumps(several, indent=2), "one.json": json.dumps(bundle(99), indent=1), "plain.json": json.dumps(bundle(98)) + "\n",
        "broken.json": '[{"id": 1}, {"id": , "x": 2}, {"id": 3}]\n', "loose.json": '[1, {"id": 1}, "a, b", null, {"id": 2}, 7 ]', "cut.json": '{"id": "never closed"', "cutarray.json": '[{"id": 1}, {"id": 2, "x": "', "empty.json": "[]",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    got = _in_order(files.fhir_files(spark, str(tmp_path)), "raw_bundle")
    for name in ("line.json", "pretty.json"):
        assert list(map(json.loads, got.pop(name))) == several
    assert len(got["one.json"]) == 1 and json.loads(got.pop("one.json")[0])["id"] == "99" and json.loads(got.pop("plain.json")[0])["id"] == "98"
    assert got == {"broken.json": ['{"id": 1}', '{"id": , "x": 2}', '{"id": 3}'], "loose.json": ["1", '{"id": 1}', '"a, b"', "null", '{"id": 2}', "7"], "cut.json": ['{"id": "never closed"'], "cutarray.json": ['{"id": 1}', '{"id": 2, "x": "']}


def test_csv_blocks(spark, tmp_path, cut):
    rng = random.Random(8)
    value = lambda: rng.choice(["plain", "", "a,b", 'say "x"', "two\nlines", '"\n\n"', "é" * rng.randrange(40), "\n" * 3])
    rows = [[str(i), value(), value()] for i in range(150)]
    for name, part in (("a.csv", rows[:100]), ("b.csv", rows[100:])):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\r\n" if name == "b.csv" else "\n")
            out.writerow(["id", "x", "y"])
            for i, r in enumerate(part):
                out.writerow(r)
                if i % 9 == 0:
                    f.write("\n")
    got = files.csv_rows(spark, str(tmp_path))
    assert got.columns == ["file_path", "file_name", "row_idx", "id", "x", "y"]
    found = sorted((int(r.id), r.x or "", r.y or "", r.row_idx) for r in got.collect())
    assert found == [(i, x, y, i + 1 if i < 100 else i - 99) for i, (_, x, y) in enumerate(rows)]
    usual = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    assert sorted(map(str, usual.collect())) == sorted(map(str, got.select("id", "x", "y").collect()))


def test_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "large.txt"
    with open(path, "w") as f:
        for i in range(60_000):
            f.write(f"MSH|^~\\&|APP|F|||20240101||ADT^A01|{i}|P|2.5\nPID|1||M{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    try:
        got = files.hl7_files(spark, str(path))
        assert files.pieces(spark, str(path)).rdd.getNumPartitions() >= 10
        assert got.agg(F.count("*").alias("n"), F.countDistinct("arrival_seq").alias("d"), F.max("arrival_seq").alias("m")).first() == (60_000, 60_000, 59_999)
        assert got.filter(~F.col("raw_message").contains(F.concat(F.lit("|"), F.col("arrival_seq").cast("string"), F.lit("|P")))).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hl7_blocks_and_batches(spark, tmp_path, cut):
    rng = random.Random(7)
    lines = ["MSH|a", "MSH|", "MSH", "", " ", "PID|MSH|x", "OBX|é", "\x1f", "NTE|" + "z" * 150]
    texts = {f"{i} é%.txt": "".join(rng.choice(lines) + rng.choice(["\n", "\r\n"] if i % 2 else ["\r"]) for _ in range(rng.randrange(40))) for i in range(8)}
    texts |= {"end.txt": "MSH|1\nPID|\nMSH|", "mark.txt": "\ufeffMSH|1\nMSH|2"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = files.hl7_files(spark, str(tmp_path))
        got, sizes = ({unquote(n): x for n, x in found.items()} for found in (_in_order(rows, "raw_message"), {r.file_name: r.file_size for r in rows.collect()}))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = _in_order(files.split_messages(spark.createDataFrame([(n, t.removeprefix("\ufeff")) for n, t in texts.items()], "file_name string, value string")), "raw_message")
    assert got == expected and sizes == {n: len(texts[n].encode()) for n in got}


def test_lines_are_read_without_names_and_edges_alone_are_kept(spark, tmp_path):
    (tmp_path / "m.txt").write_text("".join(f"MSH|{i}\nPID|\n" for i in range(500)))
    plan = files.hl7_files(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    given = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert given and not any("file_path" in line or "file_name" in line for line in given)
    for made in (files.records_at(spark, str(tmp_path), lambda v: files.pc.starts_with(v, b"MSH|"), b"\n"), files.records_of_blocks(files.pieces(spark, str(tmp_path)), files._rows, b"\n")):
        edge, inner = made(True).collect(), made(False).collect()
        assert len(edge) == 1 and edge[0].last and edge[0].idx == len(inner) and sorted(r.idx for r in inner) == list(range(len(inner)))
