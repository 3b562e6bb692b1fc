"""Stored, evolving schemas of feeds (A2).

A feed's schema is a document in the shared folder, one version per batch that
changed it. A batch's types are found in one aggregate over its text values and
merged into the version before it:

* a column the schema lacks, with a value, is added at the end;
* a number or day type that its values outgrow is widened (int to bigint to
  double, date to timestamp);
* any other mismatch leaves the type; the values go to the rescued data.

The version of a batch is made from those before it only, so a batch that is run
again writes the same document. A column without any value is not added until it
has one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.sources.sinks import partition_values

BATCH = "batch"
#: Types that values are tried against, narrowest first, and what values of the type look like beyond the cast.
KINDS: tuple[tuple[T.DataType, str | None], ...] = (
    (T.IntegerType(), None),
    (T.LongType(), None),
    (T.DoubleType(), None),
    (T.BooleanType(), "(?i)^(true|false)$"),
    (T.DateType(), r"^\d{4}-\d{1,2}-\d{1,2}$"),
    (T.TimestampNTZType(), r"^\d{4}-\d{1,2}-\d{1,2}[T ]"),
)
#: A type is widened along one of these only.
WIDER = ((T.IntegerType(), T.LongType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType()))


def found_types(rows: DataFrame) -> dict[str, T.DataType]:
    """The narrowest type that every value of a text column fits, for columns with a value; one aggregate, one row read."""
    aggs: list[Column] = []
    for i, c in enumerate(rows.columns):
        raw = F.col("`" + c.replace("`", "``") + "`")
        value = F.when(F.trim(raw) != "", F.trim(raw))
        aggs.append(F.count(value).alias(f"n{i}"))
        for k, (kind, looks) in enumerate(KINDS):
            fits = value.try_cast(kind).isNotNull()
            aggs.append(F.bool_and(F.when(value.isNotNull(), fits & value.rlike(looks) if looks else fits)).alias(f"k{i}_{k}"))
    if not aggs:
        return {}
    row = rows.agg(*aggs).first()
    fitting = lambda i: next((kind for k, (kind, _) in enumerate(KINDS) if row[f"k{i}_{k}"]), T.StringType())
    return {c: fitting(i) for i, c in enumerate(rows.columns) if row[f"n{i}"]}


def widened(stored: T.DataType, found: T.DataType) -> T.DataType:
    """The wider of two types of one family, else the stored one."""
    for family in WIDER:
        if stored in family and found in family:
            return family[max(family.index(stored), family.index(found))]
    return stored


def merged(stored: T.StructType | None, found: dict[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(f.name, widened(f.dataType, found.get(f.name, f.dataType)), True) for f in (stored or T.StructType([]))]
    known = {f.name for f in fields}
    return T.StructType(fields + [T.StructField(c, kind, True) for c, kind in found.items() if c not in known])


class SchemaStore:
    """Versions of a feed's schema, by the batch that made them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(map(int, partition_values(self.spark, self.path, BATCH)))

    def read(self, batch: int) -> T.StructType:
        text = self.spark.read.parquet(f"{self.path}/{BATCH}={batch}").first()["document"]
        return T.StructType.fromJson(json.loads(text))

    def at(self, batch: int | None = None) -> T.StructType | None:
        """The schema that holds after a batch (the newest if none is given)."""
        past = [v for v in self.versions() if batch is None or v <= batch]
        return self.read(past[-1]) if past else None

    def write(self, batch: int, schema: T.StructType) -> None:
        document = self.spark.createDataFrame([(schema.json(),)], "document string").coalesce(1)
        document.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")

    def evolve(self, batch: int, rows: DataFrame) -> T.StructType:
        """Merge the types of a batch's text rows; a new version is written if they change the schema."""
        before = self.at(batch - 1)
        after = merged(before, found_types(rows))
        if after != before:
            self.write(batch, after)
        return after


def read_evolved(spark: SparkSession, table: str, store: SchemaStore, more: tuple[T.StructField, ...] = ()) -> DataFrame:
    """A table written batch by batch, in its newest schema: each batch is read with
    the schema it was written with, and widened. ``more`` are columns beside it."""
    versions, batches = store.versions(), sorted(map(int, partition_values(spark, table, BATCH)))
    newest = T.StructType([*(store.at() or T.StructType([])), *more])
    out = spark.createDataFrame([], newest)
    for k, v in enumerate(versions):
        until = versions[k + 1] if k + 1 < len(versions) else None
        some = [b for b in batches if b >= v and (until is None or b < until)]
        if not some:
            continue
        written = T.StructType([*store.read(v), *more])
        part = spark.read.schema(written).parquet(*[f"{table}/{BATCH}={b}" for b in some])
        have = set(written.fieldNames())
        columns = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in newest]
        out = out.unionByName(part.select(*columns))
    return out
