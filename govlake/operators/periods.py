"""Datasets that follow their drops (A6, E11-E13, E15-E17, H1): only changed periods are computed again.

Orders belong to a period, the day of ``order_date`` (or what ``pattern`` makes of
it); payments and refunds to the periods of their orders. A drop brings new rows of
any feed. Its rows are written under their periods, the periods it changed are
found from them, and fact, daily KPIs and sums per payment method of those periods
are replaced; no other period is read or written::

    <feed>/batch=<drop>/period=<p>/    orders, payments, refunds as they came
    customers/batch=<drop>/
    fact/period=<p>/, kpi/period=<p>/, method/period=<p>/
                                       replaced by dynamic partition overwrite
    drops/batch=<drop>/                the periods that the drop changed; written last

The result is that of a full run over all drops, whatever order the rows came in:

* a payment or refund without a known order waits under ``UNPLACED`` until a later
  drop brings the order
* an order id that comes again on another day gets the payments and refunds of the
  id there too, as a join over everything would give
* a customer id that is repeated by a drop changes the periods of all its orders
* orders without a date have a period of their own

Drops are numbered from 0 and added in turn. One that is added again, or was killed
and starts again, replaces its own files and leaves each row once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.config import DEFAULT_AS_OF
from govlake.operators import facts, kpis
from govlake.operators.policy import apply_row_rules
from govlake.sources.sinks import cut_lineage, partition_values

PERIOD, BATCH = "period", "batch"
UNDATED, UNPLACED = "undated", "unplaced"
SIDES = ("payments", "refunds")
BY_DAY, BY_MONTH = "yyyy-MM-dd", "yyyy-MM"
#: An id on two days has its payments under both: rows meet by id and period.
KEYS = ("order_id", PERIOD)


class PeriodStore:
    """Feeds, fact and daily KPIs under one shared root. ``schemas`` names the columns of the four feeds."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], rules: Sequence[dict] = (),
                 pattern: str = BY_DAY, as_of: _dt.datetime = DEFAULT_AS_OF):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        self.rules, self.pattern, self.as_of = list(rules), pattern, as_of

    # ------------------------------------------------------------------ reads
    def drops(self) -> list[int]:
        return sorted(map(int, partition_values(self.spark, f"{self.root}/drops", BATCH)))

    def feed(self, name: str, upto: int, periods: list[str] | None = None) -> DataFrame:
        """Rows of the drops up to ``upto``, of all or some periods; with ``period``, without the drop's number."""
        schema = self.schemas[name]
        if name != "customers":
            schema = T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])
        if upto < 0:
            return self._nothing(schema)
        schema = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        rows = rows if periods is None else rows.where(F.col(PERIOD).isin(periods))
        return rows.where(F.col(BATCH) <= upto).drop(BATCH)

    def dataset(self, name: str) -> DataFrame:
        """``fact`` or ``kpi`` as the last drop left it."""
        return self.spark.read.parquet(f"{self.root}/{name}").drop(PERIOD)

    def method_performance(self) -> DataFrame:
        """E15 over all periods, added up from one row per period and method."""
        names = kpis.KPIS["payment_method_performance"][1]
        return self.dataset("method").groupBy("payment_method").agg(*[F.sum(n).alias(n) for n in names])

    def changes(self) -> DataFrame:
        """(period, batch): which periods each drop changed."""
        return self.spark.read.schema(f"{PERIOD} string, {BATCH} int").parquet(f"{self.root}/drops")

    # ------------------------------------------------------------------ a drop
    def add(self, drop: int, feeds: dict[str, DataFrame]) -> list[str]:
        """Take a drop in, and return the periods it changed. A feed that is not given brings no rows."""
        last = max(self.drops(), default=-1)
        if drop not in (last, last + 1):
            raise ValueError(f"drop {drop} does not follow drop {last}")
        new = {n: feeds[n].select(*s.names) if n in feeds else self._nothing(s) for n, s in self.schemas.items()}
        orders = new["orders"].withColumn(PERIOD, self.period_of("order_date"))
        self._write(orders, "orders", drop)
        new["customers"].write.mode("overwrite").parquet(f"{self.root}/customers/{BATCH}={drop}")
        known, fresh = self._pairs(drop, orders, new)
        for side in SIDES:
            placed = new[side].join(known.unionByName(fresh), "order_id", "left").withColumn(PERIOD, F.coalesce(PERIOD, F.lit(UNPLACED)))
            self._write(placed.unionByName(self._earlier(side, drop, known, fresh)), side, drop)
        changed = set().union(*(self._written(name, drop) for name in ("orders", *SIDES)), self._multiplied(drop, new["customers"])) - {UNPLACED}
        periods = sorted(changed)
        self.compute(drop, periods)
        rows = self.spark.createDataFrame([(p,) for p in periods], f"{PERIOD} string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/drops/{BATCH}={drop}")
        return periods

    def compute(self, drop: int, periods: list[str]) -> None:
        """Replace fact and KPIs of some periods; the scans are pruned to them."""
        if not periods:
            return
        valid = {n: apply_row_rules(self.feed(n, drop, periods), n, self.rules)[0] for n in ("orders", *SIDES)}
        customers = apply_row_rules(self.feed("customers", drop), "customers", self.rules)[0]
        feeds = [valid["orders"], customers, valid["payments"], valid["refunds"]]
        fact = facts.fact_orders(*feeds, as_of=self.as_of, keys=KEYS)
        # the feeds are joined once for both sums
        joined = cut_lineage(kpis.method_contributions(*feeds, keys=KEYS), "period-contributions")
        kpi = kpis.kpi_daily_all_orders(kpis.order_contributions(*feeds, keys=KEYS, joined=joined))
        period = self.period_of("order_date").alias(PERIOD)
        method = kpis.kpi_payment_method_performance_orders(*feeds, by=[period], keys=KEYS, joined=joined)
        for name, rows in (("fact", fact.withColumn(PERIOD, period)), ("kpi", kpi.withColumn(PERIOD, period)), ("method", method)):
            rows.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(f"{self.root}/{name}")

    # ------------------------------------------------------------------ parts
    def _nothing(self, schema: T.StructType) -> DataFrame:
        """No rows, which the optimizer knows: joins with them are not run."""
        return self.spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def period_of(self, column: str) -> Column:
        return F.coalesce(F.date_format(column, self.pattern), F.lit(UNDATED))

    def _write(self, rows: DataFrame, name: str, drop: int) -> None:
        # a large period becomes several files and tasks, small ones share a task
        rows.hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(f"{self.root}/{name}/{BATCH}={drop}")

    def _written(self, name: str, drop: int) -> set[str]:
        """Periods that the drop wrote, by listing."""
        path = f"{self.root}/{name}/{BATCH}={drop}"
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        listed = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
        return {x.getPath().getName().split("=", 1)[1] for x in listed if x.isDirectory()}

    def _pairs(self, drop: int, orders: DataFrame, new: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
        """(order_id, period) of the drop's order ids: those of earlier drops, and those that are new. One scan of ids."""
        named = [new[n].select("order_id") for n in ("orders", *SIDES)]
        touched = named[0].unionByName(named[1]).unionByName(named[2]).where("order_id IS NOT NULL").distinct()
        known = self.feed("orders", drop - 1).select("order_id", PERIOD).join(touched, "order_id", "left_semi").distinct()
        known = cut_lineage(known, "known-orders")
        own = orders.where("order_id IS NOT NULL").select("order_id", PERIOD).distinct()
        return known, cut_lineage(own.join(known, ["order_id", PERIOD], "left_anti"), "fresh-orders")

    def _earlier(self, side: str, drop: int, known: DataFrame, fresh: DataFrame) -> DataFrame:
        """Rows of earlier drops that the new orders claim: waiting ones, or those of the same id on another day."""
        columns, at = self.schemas[side].names, F.min(PERIOD).alias("source")
        source = fresh.join(known.groupBy("order_id").agg(at), "order_id", "left").withColumn("source", F.coalesce("source", F.lit(UNPLACED)))
        periods = [r[0] for r in source.select("source").distinct().collect()]  # as many as the calendar has
        held = self.feed(side, drop - 1, periods).withColumnRenamed(PERIOD, "source")
        return held.join(source, ["order_id", "source"]).select(*columns, PERIOD)

    def _multiplied(self, drop: int, customers: DataFrame) -> set[str]:
        """Periods with orders of a customer id that the drop repeats."""
        ids = customers.select("customer_id").where("customer_id IS NOT NULL").distinct()
        all_rows = self.feed("customers", drop).join(ids, "customer_id", "left_semi")
        repeated = cut_lineage(all_rows.groupBy("customer_id").count().where("count > 1").select("customer_id"), "repeated")
        if repeated.isEmpty():
            return set()
        rows = self.feed("orders", drop).select("customer_id", PERIOD).join(repeated, "customer_id", "left_semi")
        return {r[0] for r in rows.select(PERIOD).distinct().collect()}
