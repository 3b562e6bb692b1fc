"""CSV streams: any file name, quoted line breaks over lines and blocks, ragged records, evolving schemas, a gate that follows its control tables."""

import csv
import io
import json
import os
import random
import tempfile

import pytest
from govlake.plans import scenarios
from govlake.sources import sinks
from govlake.streaming import bronze as streaming
from govlake.streaming import records, schemas
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])


def folder():
    return tempfile.mkdtemp(prefix="govlake-records-", dir="/tmp")


def put(feed, name, text):
    os.makedirs(feed, exist_ok=True)
    with open(os.path.join(feed, name), "w", newline="") as f:
        f.write(text)


def run(spark, root, schema, **more):
    streaming.ingest(streaming.bronze_stream(spark, f"{root}/feed"), schema, f"{root}/bronze", f"{root}/checkpoint", **more)


def rows(spark, root):
    return sorted(((r["id"], r["note"], json.loads(r["_rescued_data"] or "{}")) for r in spark.read.parquet(f"{root}/bronze").collect()), key=repr)


@pytest.mark.parametrize("name", ["a b.csv", "a[1].csv", "50% off.csv", "{x,y}.csv", "größe?.csv", "a*b.csv", "a+b&c=d.csv"])
def test_any_file_name(spark, name):
    root = folder()
    put(f"{root}/feed", name, "id,note\n1,x\n")
    put(f"{root}/feed", "other " + name, "id,note\n2,y\n")
    put(f"{root}/feed", "plain.csv", "id,note\n3,z\n")
    run(spark, root, TWO)
    assert rows(spark, root) == [(1, "x", {}), (2, "y", {}), (3, "z", {})]  # each once


def test_every_kind_of_record_is_kept(spark):
    root = folder()
    put(f"{root}/feed", "1.csv", 'id,note\n1,"two\nlines, ""so\n\nit is"\n2,24" monitor\n3,a,surplus,b\n4\n\nbad,"q"\n5,"a "b" c"\n')
    put(f"{root}/feed", "2.csv", '﻿note,id\r\n"x\r\ny",6\r\nz,7\r\n')
    put(f"{root}/feed", "3.csv", 'id,note\n8,ok\n9,"never closed\n10,more\n')
    put(f"{root}/feed", "4.csv", 'id,note\n11," last')
    put(f"{root}/feed", "5.csv", "id,note\n12,plain\n")  # the header of files with open quotes, and none itself
    put(f"{root}/feed", "empty.csv", "")
    put(f"{root}/feed", "header only.csv", "id,note\n")
    run(spark, root, TWO)
    got = rows(spark, root)
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[1][0].split("\n") == ["two", 'lines, ""so', "", "it is"] or by_id[1][0].split("\n")[0].lstrip('"') == "two"
    assert by_id[2] == ('24" monitor', {})
    assert by_id[12] == ("plain", {}) and len(got) == 12
    assert by_id[3] == ("a", {"_line": "3,a,surplus,b"}) and by_id[4] == (None, {"_line": "4"})
    assert by_id[None] == ("q", {"id": "bad"})
    assert by_id[6] == ("x\ny", {}) and by_id[7] == ("z", {}) and by_id[8] == ("ok", {})
    # an unclosed quote takes the rest of its file along, and the text is kept
    assert "never closed\n10,more" in by_id[9][1]["_line"] and by_id[11] == (" last", {"_line": '11," last'})


def test_a_long_unclosed_quote_leaves_its_lines_apart(spark, monkeypatch):
    monkeypatch.setattr(records, "MOST_LINES", 5)
    root = folder()
    put(f"{root}/feed", "1.csv", "id,note\n" + '1,"open\n' + "".join(f"{i},x\n" for i in range(2, 20)))
    run(spark, root, TWO)
    got = rows(spark, root)
    assert [r[0] for r in got] == sorted(range(1, 20), key=lambda i: repr((i,))) and all("_line" in r[2] for r in got)


def test_records_over_blocks_equal_the_csv_module(spark):
    """Random quoted fields, cut into many blocks per file."""
    rnd = random.Random(3)
    text = lambda: "".join(rnd.choice(["a", "b", " ", ",", "\n", "\n", "é"]) for _ in range(rnd.randrange(12)))
    root, expected = folder(), []
    for k in range(3):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "note"])
        for i in range(400):
            note = text() or "-"
            expected.append((1000 * k + i, note.strip() or None))
            writer.writerow([1000 * k + i, note])
        put(f"{root}/feed", f"{k}.csv", out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = streaming.numbered(streaming.file_lines(spark, [f"{root}/feed"]))
        assert lines.select("file_path", "file_block_start").distinct().count() > 6
        got = records.records(lines).select("value", "broken").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    parsed = [next(csv.reader(io.StringIO(r.value))) for r in got if not r.value.startswith("id,")]
    assert sorted((int(i), n.strip() or None) for i, n in parsed) == sorted(expected) and not any(r.broken for r in got)


def test_no_window_when_no_quote_is_open(spark):
    root = folder()
    put(f"{root}/feed", "1.csv", 'id,note\n1,"a,b"\n2,c\n')
    lines = streaming.numbered(streaming.file_lines(spark, [f"{root}/feed"]))
    (names, parsed), = streaming.text_rows(lines)
    assert names == ["id", "note"] and "Window" not in parsed._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ schemas
def kinds(schema):
    return {f.name: f.dataType.simpleString() for f in schema}


def test_schema_follows_three_drops_and_a_restart(spark):
    root = folder()
    store = schemas.SchemaStore(spark, f"{root}/schema")
    put(f"{root}/feed", "1.csv", "id,note,day,none\n1,x,2024-01-01,\n")
    run(spark, root, store)
    assert kinds(store.at()) == {"id": "int", "note": "string", "day": "date"}
    put(f"{root}/feed", "2.csv", "id,channel,note\n3000000000,web,y\n")
    run(spark, root, schemas.SchemaStore(spark, f"{root}/schema"))  # a new session reads what is stored
    put(f"{root}/feed", "3.csv", "id,note,day,none\n2.5,7,2024-01-02 10:00:00,5\nbad,z,never,6\n")
    run(spark, root, store)
    assert kinds(store.at()) == {"id": "bigint", "note": "string", "day": "date", "channel": "string", "none": "int"}
    assert kinds(store.at(0)) == {"id": "int", "note": "string", "day": "date"} and store.versions() == [0, 1, 2]
    out = schemas.read_evolved(spark, f"{root}/bronze", store, (T.StructField("_rescued_data", T.StringType()),))
    got = sorted(((r["id"], r["note"], r["channel"], r["none"], r["_rescued_data"]) for r in out.collect()), key=repr)
    assert (1, "x", None, None, None) in got and (3000000000, "y", "web", None, None) in got
    # "bad" makes the drop's ids text, which is no wider number: both stay behind in the rescued data
    assert {json.loads(r[-1]).get("id") for r in got if r[-1]} == {"2.5", "bad"}


def test_types_widen_within_a_family():
    i, b, d, s, day, at = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampNTZType()
    assert schemas.widened(i, b) == b and schemas.widened(b, i) == b and schemas.widened(b, d) == d
    assert schemas.widened(day, at) == at and schemas.widened(i, s) == i and schemas.widened(s, i) == s and schemas.widened(day, i) == day


def test_a_batch_run_again_writes_the_same_version(spark):
    root = folder()
    store = schemas.SchemaStore(spark, f"{root}/schema")
    text = spark.createDataFrame([("1", "a"), ("2", "")], "n string, t string")
    first = store.evolve(4, text)
    wider = spark.createDataFrame([("1.5", "a", "true")], "n string, t string, ok string")
    second = store.evolve(9, wider)
    assert store.evolve(9, wider) == second and store.versions() == [4, 9] and store.at(8) == first
    assert kinds(second) == {"n": "double", "t": "string", "ok": "boolean"}
    assert schemas.found_types(spark.createDataFrame([(None,), (" ",)], "x string")) == {}


# ------------------------------------------------------------------ gate
def test_gate_follows_its_control_table(spark):
    root = folder()
    guardian, drift = f"{root}/guardian", f"{root}/drift"
    control = lambda strategy: spark.createDataFrame(
        [("bronze_t", True, "LOW", json.dumps({"strategy": strategy, "silver_filter_condition": "id > 1", "correction_expression": {}}), scenarios.T1)],
        scenarios.GUARDIAN_CONTROL_SCHEMA)
    for k in range(3):
        put(f"{root}/feed", f"{k}.csv", f"id,note\n{k},x\n{k + 10},y\n")
        os.utime(f"{root}/feed/{k}.csv", (1_700_000_000 + k, 1_700_000_000 + k))

    def after(number):
        sinks.write_version(control("QUARANTINE" if number == 0 else "BLOCK"), guardian)

    stream = streaming.bronze_stream(spark, f"{root}/feed", 1)
    streaming.stream_governed(stream, TWO, "bronze_t", guardian, drift, f"{root}/out", f"{root}/checkpoint", after=after)
    got = {(r["id"], r["route"]): (r["guardian_strategy"], r["control_version"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert {k: v[0] for k, v in got.items()} == {
        (0, "silver"): None, (10, "silver"): None,  # no decision yet
        (1, "GUARDIAN_FILTER_FAILED"): "QUARANTINE", (11, "silver"): "QUARANTINE",
        (2, "GUARDIAN_BLOCK"): "BLOCK", (12, "GUARDIAN_BLOCK"): "BLOCK"}
    assert got[0, "silver"][1] == "none,none" and got[11, "silver"][1] != got[12, "GUARDIAN_BLOCK"][1]
    # a repeated batch takes the versions it took first
    again = streaming.pinned_versions(spark, f"{root}/out-pins", 1, [guardian, drift])
    assert again[0].rsplit("/", 1)[1] == got[11, "silver"][1].split(",")[0] and again[1] is None


def test_lines_are_read_once(spark):
    """Header, types and rows of a batch come from its kept lines."""
    root = folder()
    put(f"{root}/feed", "1.csv", "id,note\n1,x\n")
    seen = []
    run(spark, root, TWO, transform=lambda df, n: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df.withColumn("n", F.lit(n)))
    assert "InMemoryTableScan" in seen[0] and spark.read.parquet(f"{root}/bronze").first()["n"] == 0
