"""Bucketed upsert: equal to the whole-table form, rewrites touched buckets only, survives a killed write."""

import datetime as dt

import pytest
from govlake.operators.control import upsert_latest
from govlake.sources import sinks
from govlake.sources.buckets import BucketedTable, bucket_of
from pyspark.sql import functions as F

KEYS = ["day", "id"]


def rows(spark, n, version=0):
    at = F.timestamp_seconds(F.lit(1_700_000_000 + version))
    return spark.range(n).select((F.col("id") % 100).alias("day"), "id", F.lit(version).alias("v"), at.alias("updated_at"))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_upsert_equals_the_whole_table_form_and_rewrites_its_share(spark):
    base, root = rows(spark, 5000), sinks.scratch_dir(spark, "buckets")
    table = BucketedTable.create(base, root, KEYS, "updated_at", 50, cluster="day")
    assert same(table.read(), base) and table.version == 0
    one = rows(spark, 6000, 1).where("day = 7")  # one percent of the days, some keys new
    after = table.upsert(one)
    assert len(after.rewritten) == 1 and same(after.read(), upsert_latest(base, one, KEYS, "updated_at"))
    assert after.rewritten == [one.select(bucket_of(KEYS, "day", 50)).first()[0]]
    kept = set(table.read().inputFiles())
    assert len(kept - set(after.read().inputFiles())) == 1 and same(after.read(version=0), base)
    again = after.upsert(one)
    assert same(again.read(), after.read())  # the same rows
    with pytest.raises(Exception, match="ALREADY_EXISTS"):  # from a version that is not the newest
        after.upsert(rows(spark, 10, 3))
    assert same(BucketedTable(spark, root).read(), again.read())
    older = rows(spark, 5000, 0).where("day = 7").withColumn("v", F.lit(9)).withColumn("updated_at", F.lit(None).cast("timestamp"))
    assert same(again.upsert(older).read(), after.read())


def test_only_touched_buckets_are_read(spark):
    root = sinks.scratch_dir(spark, "buckets")
    table = BucketedTable.create(rows(spark, 1000), root, ["id"], "updated_at", 16)
    number = rows(spark, 1000).where("id = 5").select(bucket_of(["id"], None, 16)).first()[0]
    for f in table.read([number]).inputFiles():
        assert f"bucket={number}/" in f
    assert table.upsert(rows(spark, 1000, 1).where("id = 5")).rewritten == [number]


def test_killed_write_leaves_the_old_version(spark):
    root = sinks.scratch_dir(spark, "buckets")
    table = BucketedTable.create(rows(spark, 100), root, ["id"], "updated_at", 4)
    bad = rows(spark, 100, 1).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad).read().collect()
    rows(spark, 10, 5).write.parquet(f"{root}/data/died/bucket=0")  # data files that no manifest names
    again = BucketedTable(spark, root)
    assert again.version == 0 and same(again.read(), rows(spark, 100))
    assert same(again.upsert(rows(spark, 10, 2)).read(), upsert_latest(rows(spark, 100), rows(spark, 10, 2), ["id"], "updated_at"))


def test_empty_null_and_repeated_rows(spark):
    schema = "id long, v string, updated_at timestamp"
    root = sinks.scratch_dir(spark, "buckets")
    table = BucketedTable.create(spark.createDataFrame([], schema), root, ["id"], "updated_at", 8)
    assert table.read().count() == 0 and table.upsert(spark.createDataFrame([], schema)).version == 0
    t = dt.datetime(2024, 1, 1)
    some = [(None, "a", t), (None, "b", t + dt.timedelta(1)), (1, "c", None), (1, "c", None), (2, None, t)]
    # narrower keys and other columns of the updates fit the table's types
    updates = spark.createDataFrame(some, "id int, v string, updated_at timestamp").withColumn("bucket", F.lit("x"))
    out = table.upsert(updates)
    assert {(r.id, r.v) for r in out.read().collect()} == {(None, "b"), (1, "c"), (2, None)}
    wide = spark.createDataFrame([(2, "z", t)], schema)
    assert {(r.id, r.v) for r in out.upsert(wide).read().collect()} == {(None, "b"), (1, "c"), (2, "z")}


def test_refusals(spark):
    root = sinks.scratch_dir(spark, "buckets")
    with pytest.raises(ValueError, match="no complete version"):
        BucketedTable(spark, root)
    BucketedTable.create(rows(spark, 3), root, ["id"], "updated_at", 2)
    with pytest.raises(ValueError, match="holds a table"):
        BucketedTable.create(rows(spark, 3), root, ["id"], "updated_at", 2)
    with pytest.raises(ValueError, match="taken by the layout"):
        BucketedTable.create(rows(spark, 3).withColumn("bucket", F.lit(1)), root + "b", ["id"], "updated_at", 2)
