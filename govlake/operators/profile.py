"""Table profiles in long format.

The reference ran one Spark job per column (and one more per numeric and per
string column). Here a table is measured by three plans, whatever its width:

* figures: row count, null shares, averages and distinct counts, one aggregate
  per ``BATCH`` columns. An exact distinct count makes Spark expand its input
  once per column of the same aggregate, so the batch bounds that factor, and
  each batch scans its own columns only. ``approx=True`` takes HyperLogLog
  sketches instead for every column but the primary key: no value is shuffled,
  and the key has a batch without sketches, as a distinct count shuffles the
  other figures of its aggregate once per value.
* candidates: a frequent-items sketch per string column, built in each task,
  merged in buckets and then per column. It shuffles sketches, never values.
* value counts: rows per candidate, counted exactly in a second scan against
  the broadcast candidates, which the parameters below bound.

A column reports its ``TOP_VALUES`` most frequent values (ties by value) of those
that hold at least one row in ``LEAST_PART``; the sketch's error is a fifth of
that, so none of them can be missing, and the count of each is exact. What is
not reported is one "other" share. Values that someone asks for (``watched``:
the ones reported last time, and the statuses that the drift rules read) are
counted and reported too, be they rare or gone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.config import CATEGORY_DRIFT_COLUMNS, NEGATIVE_CATEGORIES, POSITIVE_CATEGORIES, PRIMARY_KEYS

RESCUED = "_rescued_data"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

#: Columns whose exact distinct counts share one aggregate.
BATCH = 8
#: Values that a column reports, and the part of the rows one of them holds at least (1 in 1000).
TOP_VALUES, LEAST_PART = 50, 1000
#: Values a sketch tracks; its counts are off by at most 3.5 / 16384 of the rows.
TRACKED = 8192
#: Sketches of tasks are merged in this many groups before they are merged per column.
BUCKETS = 64
#: NULL as a value in metric names.
NULL_LABEL = "None"
#: Longest list of candidates of a column: twice the values that can hold 1 row in ``LEAST_PART``.
CANDIDATES = 2 * LEAST_PART

WATCHED = "column_name string, value string, always boolean"


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by type (B11); DECIMAL and SHORT count too."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    """String columns except the rescued-data column."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != RESCUED]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(df: DataFrame, name: str) -> Column:
    """A value as text that keeps distinctness: -0.0 and 0.0 are one value,
    as in Spark's own grouping of floating point keys."""
    c = quoted(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)
    return c.cast("string")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --------------------------------------------------------------------------- figures
def figures(df: DataFrame, columns: list[str], sketched: set[str] = frozenset()) -> DataFrame:
    """(column_name, n_rows, non_null, distinct_count, average) per column.

    ``average`` is the exact sum over the non-NULL count in DOUBLE, NULL for a
    column that is not numeric or has no values (S15). ``n_rows`` is in each row.
    """
    numeric = set(numeric_columns(df))

    def batch(names: list[str]) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for i, c in enumerate(names):
            distinct = F.approx_count_distinct(as_text(df, c)) if c in sketched else F.countDistinct(quoted(c))
            total = F.sum(quoted(c)).cast("double") if c in numeric else F.lit(None).cast("double")
            aggs += [F.count(quoted(c)).alias(f"nn{i}"), distinct.alias(f"d{i}"),
                     F.try_divide(total, F.count(quoted(c)).cast("double")).alias(f"a{i}")]
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"nn{i}").alias("non_null"),
                         F.col(f"d{i}").alias("distinct_count"), F.col(f"a{i}").alias("average")) for i, c in enumerate(names)]
        return df.agg(*aggs).select("n_rows", F.inline(F.array(*rows)))

    exact, rest = [c for c in columns if c not in sketched], [c for c in columns if c in sketched]
    return union_all([batch(names[k : k + BATCH]) for names in (exact, rest) for k in range(0, len(names), BATCH)])


def sketched_columns(columns: list[str], table: str, approx: bool) -> set[str]:
    return {c for c in columns if c != PRIMARY_KEYS.get(table)} if approx else set()


def share(n: Column, total: Column) -> Column:
    """n in percent of the total; NULL for an empty table (the reference divided by zero)."""
    return F.try_divide(n.cast("double"), total.cast("double")) * F.lit(100.0)


# --------------------------------------------------------------------------- E1
def column_profile(df: DataFrame, table: str, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """(table_name, column_name, null_percent, distinct_count) per column.

    ``distinct_count`` ignores NULL, as ``count(DISTINCT)`` does.
    """
    columns = list(columns if columns is not None else df.columns)
    return figures(df, columns, sketched_columns(columns, table, approx)).select(
        F.lit(table).alias("table_name"), "column_name",
        share(F.col("n_rows") - F.col("non_null"), F.col("n_rows")).alias("null_percent"),
        F.col("distinct_count").cast("bigint").alias("distinct_count"),
    )


# --------------------------------------------------------------------------- E2, E4
def numeric_profile(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, metric_name, metric_value): ``row_count`` and ``<c>_avg``
    for numeric columns, in one global aggregate."""
    columns = list(columns if columns is not None else numeric_columns(df))
    aggs = [F.count(F.lit(1)).cast("double").alias("row_count")]
    aggs += [F.try_divide(F.sum(quoted(c)).cast("double"), F.count(quoted(c)).cast("double")).alias(f"{c}_avg") for c in columns]
    one = df.agg(*aggs)
    items = [F.struct(F.lit(n).alias("metric_name"), quoted(n).alias("metric_value")) for n in one.columns]
    return one.select(F.lit(table).alias("table_name"), F.inline(F.array(*items)))


# --------------------------------------------------------------------------- E5
def frequent_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_rows, non_null, items) per column, one scan: the items are
    all values that may hold one row in ``LEAST_PART``, and some more."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        name = "`" + c.replace("`", "``") + "`"
        aggs += [F.count(quoted(c)).alias(f"nn{i}"), F.expr(f"approx_top_k_accumulate({name}, {TRACKED})").alias(f"s{i}")]
    parts = df.groupBy((F.spark_partition_id() % BUCKETS).alias("bucket")).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"nn{i}").alias("non_null"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(columns)]
    per_column = parts.select("n_rows", F.inline(F.array(*rows))).groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("non_null").alias("non_null"),
        F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    items = F.expr(f"transform(approx_top_k_estimate(sketch, {CANDIDATES}), x -> x.item)")
    return per_column.select("column_name", "n_rows", "non_null", items.alias("items"))


def value_counts(df: DataFrame, columns: list[str], candidates: DataFrame) -> DataFrame:
    """(column_name, value, n): rows per candidate, exact; only candidates are shuffled."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).join(F.broadcast(candidates), ["column_name", "value"]).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, columns: list[str], watched: DataFrame | None = None, label: str | None = None) -> DataFrame:
    """(column_name, kind, value, n, n_rows): reported values (kind ``value``) and the rest (kind ``other``).

    NULL is a value (kind ``null`` unless it has a ``label``, which then joins a
    text that is spelt so). ``watched`` is (column_name, value, always): its
    values are reported if they have rows, or always.
    """
    found = frequent_values(df, columns)
    asked = df.sparkSession.createDataFrame([], WATCHED) if watched is None else watched
    asked = asked.where(F.col("column_name").isin(columns) & F.col("value").isNotNull())
    # the condition keeps all of a sketch scan's columns here too, so that one scan serves every use of ``found``
    listed = found.where("n_rows > 0 AND non_null > 0").select("column_name", F.explode("items").alias("value")).where(F.col("value").isNotNull())
    counted = value_counts(df, columns, listed.unionByName(asked.select("column_name", "value")).distinct())
    nulls = found.withColumn("n", F.col("n_rows") - F.col("non_null")).where("n > 0")
    no = F.lit(None).cast("boolean").alias("always")
    rows = counted.select("column_name", "value", "n", no).unionByName(asked.select("column_name", "value", F.lit(0).cast("long").alias("n"), "always"))
    rows = rows.unionByName(nulls.select("column_name", F.lit(label).alias("value"), "n", no))
    rows = rows.groupBy("column_name", "value").agg(F.sum("n").alias("n"), F.max("always").alias("always"))
    # one short list per column, CANDIDATES and the watched at most: most frequent first, ties by value, NULL last
    place = F.struct((-F.col("n")).alias("less"), F.col("value").isNull().alias("is_null"), "value", "n", "always")
    lists = rows.groupBy("column_name").agg(F.array_sort(F.collect_list(place)).alias("items"))
    per_column = found.select("column_name", "n_rows").join(F.broadcast(lists), "column_name", "left")
    often = lambda x: x["n"] * LEAST_PART >= F.col("n_rows")
    shown = F.filter("items", lambda x, i: (often(x) & (i < TOP_VALUES)) | F.coalesce(x["always"] | (x["n"] > 0) & x["always"].isNotNull(), F.lit(False)))
    per_column = per_column.withColumn("shown", F.coalesce(shown, F.array().cast(lists.schema["items"].dataType)))  # a column without rows
    total = F.aggregate("shown", F.lit(0).cast("long"), lambda t, x: t + x["n"])
    line = lambda kind, value, n: F.struct(kind.alias("kind"), value.alias("value"), n.alias("n"))
    values = F.transform("shown", lambda x: line(F.when(x["value"].isNull(), "null").otherwise("value"), x["value"], x["n"]))
    rest = F.array(line(F.lit("other"), F.lit(None).cast("string"), F.col("n_rows") - total))
    return per_column.select("column_name", F.inline(F.concat(values, rest)), "n_rows")


def category_profile(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, kind, value, n, share_pct): the reported values
    of every string column and, per column, one ``other`` row; a column's shares
    add up to 100. Share NULL for an empty table."""
    columns = list(columns if columns is not None else string_columns(df))
    if not columns:
        return df.sparkSession.createDataFrame([], f"table_name string, column_name string, kind string, value string, n long, share_pct double")
    return top_values(df, columns).select(
        F.lit(table).alias("table_name"), "column_name", "kind", "value", "n", share(F.col("n"), F.col("n_rows")).alias("share_pct"))


# --------------------------------------------------------------------------- F1
#: Metric names end with these; a value's share is ``<column>::<value>``.
NULL_PCT, DISTINCT, AVERAGE, OTHER = "_null_pct", "_distinct_cnt", "_avg", "_other_pct"


def column_of_value(metric_name: Column) -> Column:
    """The column of a value-share metric, NULL for other metrics."""
    return F.when(metric_name.contains("::"), F.split(metric_name, "::", 2)[0])


def reported_before(metrics: DataFrame) -> DataFrame:
    """(column_name, value) to watch: per column the ``TOP_VALUES`` largest shares of a snapshot's metrics."""
    parts = F.split("metric_name", "::", 2)
    rows = metrics.where(F.col("metric_name").contains("::") & (F.col("metric_value") > 0)).select(
        "table_name", parts[0].alias("column_name"), parts[1].alias("value"), "metric_value")
    largest = Window.partitionBy("table_name", "column_name").orderBy(F.col("metric_value").desc(), "value")  # one snapshot's report
    return rows.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= TOP_VALUES).select("table_name", "column_name", "value")


def rule_values(df: DataFrame, table: str) -> DataFrame:
    """(column_name, value, always) that the drift rules read, whatever their share."""
    rows = [(c, v, False) for c in CATEGORY_DRIFT_COLUMNS.get(table, ()) if c in df.columns for v in (*POSITIVE_CATEGORIES, *NEGATIVE_CATEGORIES)]
    return df.sparkSession.createDataFrame(rows, WATCHED)


def drift_metrics(df: DataFrame, table: str, approx: bool = False, previous: DataFrame | None = None) -> DataFrame:
    """All drift metrics of one table snapshot in long format
    (table_name, metric_name, metric_value double): ``row_count``,
    ``<c>_null_pct``, ``<c>_distinct_cnt``, ``<c>_avg``, and for string columns
    ``<c>::<value>`` (share in %, NULL labelled ``None``) and ``<c>_other_pct``.

    ``previous`` are the metrics of the snapshot before: its largest values of
    each column are counted again, so a value that is no longer among the most
    frequent ones is not taken for gone; one without rows has the share 0.
    Statuses that the drift rules read are reported when they have rows.
    """
    columns, numeric = df.columns, numeric_columns(df)
    known = figures(df, columns, sketched_columns(columns, table, approx))
    metric = lambda suffix, value: F.struct(F.lit(suffix).alias("suffix"), value.cast("double").alias("metric_value"))
    items = F.array(
        metric(NULL_PCT, share(F.col("n_rows") - F.col("non_null"), F.col("n_rows"))),
        metric(DISTINCT, F.col("distinct_count")),
        metric(AVERAGE, F.col("average")),
    )
    out = known.select("column_name", F.inline(items)).where((F.col("suffix") != AVERAGE) | F.col("column_name").isin(numeric))
    out = out.select(F.concat("column_name", "suffix").alias("metric_name"), "metric_value").unionByName(
        df.agg(F.count(F.lit(1)).cast("double").alias("metric_value")).select(F.lit("row_count").alias("metric_name"), "metric_value"))
    strings = string_columns(df)
    if strings:
        watched = rule_values(df, table)
        if previous is not None:
            before = reported_before(previous.where(F.col("table_name") == table)).select("column_name", "value", F.lit(True).alias("always"))
            watched = watched.unionByName(before).groupBy("column_name", "value").agg(F.max("always").alias("always"))
        told = top_values(df, strings, watched, NULL_LABEL)
        name = F.when(F.col("kind") == "other", F.concat("column_name", F.lit(OTHER))).otherwise(F.concat("column_name", F.lit("::"), "value"))
        out = out.unionByName(told.select(name.alias("metric_name"), share(F.col("n"), F.col("n_rows")).alias("metric_value")))
    return out.select(F.lit(table).alias("table_name"), "metric_name", "metric_value")


def profile_of_metrics(metrics: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """The column profile (E1) that a snapshot's drift metrics already hold; ``columns`` by table, from the schema."""
    names = [(t, c, c + NULL_PCT, c + DISTINCT) for t, of in columns.items() for c in of]
    wanted = metrics.sparkSession.createDataFrame(names, "table_name string, column_name string, null_name string, distinct_name string")
    here = lambda name: F.col("metric_name") == F.col(name)
    rows = metrics.join(F.broadcast(wanted), "table_name").where(here("null_name") | here("distinct_name"))
    return rows.groupBy("table_name", "column_name").agg(
        F.max(F.when(here("null_name"), F.col("metric_value"))).alias("null_percent"),
        F.max(F.when(here("distinct_name"), F.col("metric_value"))).cast("bigint").alias("distinct_count"),
    )


def stamp(df: DataFrame, captured_at, column: str = "captured_at") -> DataFrame:
    """Add the capture time (A7); a literal so reruns are reproducible."""
    return df.withColumn(column, F.lit(captured_at).cast("timestamp"))
