"""Upsert of tables that are not small (A9): only the buckets with touched keys are rewritten.

A table is a folder with rows dealt to buckets by a hash of their keys. An upsert
finds the buckets of its updates, reads the current files of those, merges and
writes them as a new version of each; all others stay where they are::

    data/<write>/bucket=<b>/    rows of bucket b as one write left them
    manifest/version=<v>/       one row: the write whose files of each bucket are current

A version counts once its manifest is complete, so readers see a whole version,
and a write that was killed leaves the one before. Files of older versions stay
for readers that began on them. Each write has a folder of its own; one that began
on a version that is no longer the newest fails and changes nothing.

``buckets`` is fixed when the table is made. A bucket is merged by one task, so
choose as many as give buckets of some 256 MB; updates of one percent of the keys
then rewrite few rows beside theirs only if they fall into few buckets, as the
keys of a day's drop do where ``cluster`` names a leading part of the key.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.operators.control import upsert_latest
from govlake.sources.sinks import cut_lineage, partition_values

BUCKET, VERSION = "bucket", "version"
MANIFEST = "keys array<string>, ts string, cluster string, buckets int, schema string, current map<int,string>, rewritten array<int>"


class BucketedTable:
    """A keyed table at ``root``; its layout is read from the newest complete manifest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        done = self.versions()
        if not done:
            raise ValueError(f"no complete version of a bucketed table at {root}")
        self.version = done[-1]
        m = self._manifest(self.version)
        self.keys, self.ts, self.cluster, self.buckets = list(m["keys"]), m["ts"], m["cluster"], m["buckets"]
        self.schema = T.StructType.fromJson(json.loads(m["schema"]))
        self.current, self.rewritten = dict(m["current"]), sorted(m["rewritten"])

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: list[str], ts: str, buckets: int, cluster: str | None = None) -> BucketedTable:
        """Write the first version: the newest row of each key by ``ts``, as ``upsert_latest`` picks it.

        ``cluster`` is an SQL expression over the keys whose equal values share a bucket.
        """
        spark, root = df.sparkSession, root.rstrip("/")
        if BUCKET in df.columns:
            raise ValueError(f"a column named {BUCKET!r} is taken by the layout")
        if _versions(spark, root):
            raise ValueError(f"{root} holds a table")
        layout = {"keys": keys, "ts": ts, "cluster": cluster, "buckets": buckets, "schema": df.schema.json()}
        _write(upsert_latest(df.limit(0), df, keys, ts), root, 0, layout, {})
        return cls(spark, root)

    def versions(self) -> list[int]:
        return _versions(self.spark, self.root)

    def _manifest(self, version: int):
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{VERSION}={version}").first()

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the table, or of some buckets, now or as of an earlier version."""
        current = self.current if version is None else dict(self._manifest(version)["current"])
        paths = [f"{self.root}/data/{write}/{BUCKET}={b}" for b, write in sorted(current.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, updates: DataFrame) -> BucketedTable:
        """The table with one row per key, the newer by ``ts``; on a tie the update. NULL ``ts`` loses.

        The updates are cut to the newest row per key and stored first (task-side
        maxima, so a key with very many updates is no hot one), then told by bucket.
        Their bucket numbers, at most ``buckets`` integers, are read by the driver to
        name the folders. The same updates again leave the same rows.
        """
        # keys are hashed by type, so updates take the table's types
        updates = updates.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        latest = cut_lineage(upsert_latest(updates.limit(0), updates, self.keys, self.ts), "upsert")
        touched = sorted(r[0] for r in latest.select(bucket_of(self.keys, self.cluster, self.buckets)).distinct().collect())
        if not touched:
            return self
        merged = upsert_latest(self.read(touched), latest, self.keys, self.ts)
        layout = {"keys": self.keys, "ts": self.ts, "cluster": self.cluster, "buckets": self.buckets, "schema": self.schema.json()}
        _write(merged, self.root, self.version + 1, layout, self.current)
        return BucketedTable(self.spark, self.root)


def bucket_of(keys: list[str], cluster: str | None, buckets: int) -> Column:
    by = F.expr(cluster) if cluster else F.struct(*[F.col(f"`{k}`") for k in keys])
    return F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int").alias(BUCKET)


def _write(rows: DataFrame, root: str, version: int, layout: dict, current: dict[int, str]) -> None:
    """Write the buckets of ``rows`` as ``version``, then the manifest that makes them current."""
    spark, write = rows.sparkSession, uuid.uuid4().hex
    dealt = rows.withColumn(BUCKET, bucket_of(layout["keys"], layout["cluster"], layout["buckets"]))
    dealt.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/data/{write}")
    written = sorted(map(int, _folders(spark, f"{root}/data/{write}")))
    row = (layout["keys"], layout["ts"], layout["cluster"], layout["buckets"], layout["schema"], {**current, **dict.fromkeys(written, write)}, written)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/{VERSION}={version}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [x.getPath().getName() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{BUCKET}=")]


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(map(int, partition_values(spark, f"{root}/manifest", VERSION)))
