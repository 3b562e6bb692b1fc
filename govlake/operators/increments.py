"""Profiles added up from drops (E1, E2, E4): a new drop is scanned, earlier ones are not.

A drop's partial profile has one row per column: rows, non-NULL rows, the exact
sum of a numeric column and a HyperLogLog sketch of its values. All of them can
be added: sums are summed and sketches joined, so the profile of a table is an
aggregate over the partial profiles of its drops, a few kilobytes per column and
drop. The store has one folder per drop; a drop that is profiled again replaces
its own folder and nothing else.

A table is a folder with one subfolder ``batch=<number>`` per drop, as the file
stream writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.operators.profile import as_text, numeric_columns, quoted, share
from govlake.sources.sinks import partition_values

#: Size of a sketch, 2^14 registers: a standard error of 0.8 %.
REGISTERS = 14
#: Three standard errors of a distinct count, as a part of it.
ERROR = 3 * 1.04 / (1 << REGISTERS) ** 0.5
#: Exact sums have six places; values of a DOUBLE column are rounded to them.
SUM = T.DecimalType(38, 6)
DROP = "batch"
#: ``leads`` marks one row per drop, whose ``n_rows`` counts for the table.
PARTIAL = f"column_name string, n_rows long, leads boolean, non_null long, total decimal(38,6), distinct binary, {DROP} long"


def partial_profile(df: DataFrame, drop: Column) -> DataFrame:
    """One row per drop and column; ``drop`` names the drop of a row.

    One aggregate: sums and sketches are combined in each task, so a task sends
    one row per drop, and nothing is expanded.
    """
    columns, numeric = [c for c in df.columns if c != DROP], set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        total = F.sum(quoted(c).cast(SUM)) if c in numeric else F.lit(None)
        aggs += [F.count(quoted(c)).alias(f"n{i}"), total.cast(SUM).alias(f"t{i}"), F.hll_sketch_agg(as_text(df, c), F.lit(REGISTERS)).alias(f"d{i}")]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(i == 0).alias("leads"), F.col(f"n{i}").alias("non_null"),
                     F.col(f"t{i}").alias("total"), F.col(f"d{i}").alias("distinct")) for i, c in enumerate(columns)]
    return df.groupBy(drop.cast("long").alias(DROP)).agg(*aggs).select(DROP, "n_rows", F.inline(F.array(*rows)))


def added_up(parts: DataFrame) -> DataFrame:
    """(column_name, n_rows, null_percent, distinct_count, average) over all drops.

    A column that a drop lacks is NULL in the drop's rows. The distinct count is
    within ``ERROR`` of the exact one, at three standard errors.
    """
    table = parts.agg(F.sum(F.when(F.col("leads"), F.col("n_rows"))).alias("n_rows"), F.collect_set("column_name").alias("names"))
    rows = table.select("n_rows", F.explode("names").alias("column_name"))  # as many rows as the table has columns
    columns = parts.groupBy("column_name").agg(
        F.sum("non_null").alias("non_null"), F.sum("total").alias("total"), F.hll_union_agg("distinct").alias("distinct"))
    return columns.join(F.broadcast(rows), "column_name").select(
        "column_name", "n_rows", share(F.col("n_rows") - F.col("non_null"), F.col("n_rows")).alias("null_percent"),
        F.hll_sketch_estimate("distinct").alias("distinct_count"),
        F.try_divide(F.col("total").cast("double"), F.col("non_null").cast("double")).alias("average"),
    )


def new_drops(spark: SparkSession, table: str, store: str) -> list[int]:
    """Drops of the table that the store has no partial profile of; folder listings only."""
    return sorted(set(map(int, partition_values(spark, table, DROP))) - set(map(int, partition_values(spark, store, DROP))))


def profile_drops(spark: SparkSession, table: str, store: str, drops: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Profile new drops (or the given ones, again) into the store and return their partial profiles.

    Only the folders of those drops are read. ``schema`` is that of the table;
    unset, it is read from the files of each drop, which may differ.
    """
    drops = new_drops(spark, table, store) if drops is None else drops
    for d in drops:
        reader = spark.read if schema is None else spark.read.schema(schema)
        parts = partial_profile(reader.parquet(f"{table}/{DROP}={d}"), F.lit(d))
        parts.drop(DROP).write.mode("overwrite").parquet(f"{store}/{DROP}={d}")
    return partials(spark, store).where(F.col(DROP).isin(drops))


def partials(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(PARTIAL).parquet(store)


def stored_profile(spark: SparkSession, store: str) -> DataFrame:
    """The profile of the whole table from the partial profiles of its drops."""
    return added_up(partials(spark, store))
