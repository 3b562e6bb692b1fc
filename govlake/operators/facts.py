"""Order fact table (H1-H3).

An order is matched with its customers, payments and refunds, all left outer
on the orders side, so the order of the joins does not matter. Customers add
no columns (S20): they only multiply the rows of a repeated customer id. Ids
with one row or none multiply by one, so only the repeated ones are joined;
that table is small or empty and stored, and its real size decides the join.

Payments and refunds are shuffled once each, by ``order_id``. An order with very
many of either would put their product into one task: frequent-items sketches
of the scans name such orders and about how many rows they have, without a
shuffle by order. In the same join, the rows of a named order's larger side are
dealt over salts, as many as its estimate asks for, and its other rows repeated
per salt. Named are all orders with more than both ``HOT_ROWS`` rows and one row
in ``LEAST_PART`` of their table; one that is named needlessly costs a few rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import DEFAULT_AS_OF
from govlake.operators.policy import apply_row_rules
from govlake.sources.sinks import cut_lineage

FACT_COLUMNS = (
    "order_id", "customer_id", "payment_id", "refund_id", "order_date", "order_status",
    "payment_status", "payment_method", "payment_amount", "refund_status", "refund_amount",
    "refund_reason", "discount_amount", "net_amount", "processed_at",
)


#: Payments or refunds of one order from which it is dealt, and over how many parts at most.
HOT_ROWS, SALTS = 100_000, 64
#: Orders that a sketch tracks (its estimates are within 3.5 / 2^18 of the rows), the
#: buckets in which sketches are merged, and the share of rows from which an order is named.
TRACKED, BUCKETS, LEAST_PART = 1 << 17, 64, 50_000

#: Fact columns taken over from each input, by the fact's name.
_FROM = {
    "payments": {"payment_id": "payment_id", "payment_status": "payment_status", "payment_method": "payment_method", "payment_amount": "amount"},
    "refunds": {"refund_id": "refund_id", "refund_status": "refund_status", "refund_amount": "refund_amount", "refund_reason": "refund_reason"},
}


def _valid(frames: dict[str, DataFrame], rules: Sequence[dict]) -> dict[str, DataFrame]:
    """Each input reduced to the rows that satisfy its policy row rules."""
    return {name: apply_row_rules(df, name, rules)[0] for name, df in frames.items()}


def _side(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(source).alias(out) for out, source in _FROM[name].items()])


def _multiplied(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, repeated as often as their customer id has rows."""
    repeated = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    times = cut_lineage(repeated, "repeated-customers")
    joined = orders.join(times, "customer_id", "left")
    each = F.explode(F.array_repeat(F.lit(1), F.coalesce("_rows", F.lit(1)).cast("int")))
    return joined.withColumn("_each", each).drop("_rows", "_each")


def _frequent_orders(side: DataFrame) -> DataFrame:
    """(order_id, n): at most ``LEAST_PART`` orders, the most frequent first, with their estimated rows."""
    parts = side.where("order_id IS NOT NULL").groupBy((F.spark_partition_id() % BUCKETS).alias("bucket")).agg(
        F.expr(f"approx_top_k_accumulate(order_id, {TRACKED})").alias("sketch"))
    # grouped by a constant: no rows from no rows
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    items = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {LEAST_PART})")).alias("i"))
    return items.select(F.col("i.item").alias("order_id"), F.col("i.count").alias("n"))


def hot_orders(paid: DataFrame, refunded: DataFrame, hot_rows: int, salts: int) -> DataFrame:
    """(order_id, _dealt, _salts): the side to deal of each hot order and over how many salts.

    At most ``2 * LEAST_PART`` rows, whatever the tables' sizes.
    """
    found = [_frequent_orders(df).where(F.col("n") > hot_rows).withColumn("_dealt", F.lit(name))
             for df, name in ((paid, "payments"), (refunded, "refunds"))]
    largest = found[0].unionByName(found[1]).groupBy("order_id").agg(F.max_by("_dealt", F.struct("n", "_dealt")).alias("_dealt"), F.max("n").alias("n"))
    parts = F.least(F.lit(salts), 1 + F.ceil(F.col("n") / F.lit(hot_rows)))
    return largest.select("order_id", "_dealt", parts.cast("int").alias("_salts"))


def _dealt_keys(hot: DataFrame, paid: DataFrame, refunded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hot orders by all keys, those under which the dealt side has rows: one row per hot order and its other keys."""
    found = [df.join(F.broadcast(hot.where(F.col("_dealt") == name)), "order_id").select(*keys, "_dealt", "_salts").distinct()
             for df, name in ((paid, "payments"), (refunded, "refunds"))]
    return cut_lineage(found[0].unionByName(found[1]), "dealt-keys")


def _with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str], side: str | None = None) -> DataFrame:
    """The rows with a ``_salt``: 0, for a hot order every salt, or the row's own where its ``side`` is dealt."""
    marked = df.join(F.broadcast(hot), list(keys), "left")  # bounded, see hot_orders
    each = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    if side is not None:
        own = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_salts")).cast("int")
        each = F.when(F.col("_dealt") == side, F.array(own)).otherwise(each)
        return marked.select(*df.columns, F.explode(each).alias("_salt"), F.lit(side).alias(f"_of_{side}"))
    return marked.select(*df.columns, "_dealt", F.explode(each).alias("_salt"))


def _fan_out(orders: DataFrame, paid: DataFrame, refunded: DataFrame, hot_rows: int, salts: int, keys: Sequence[str]) -> DataFrame:
    """Orders with every (payment, refund) combination; hot orders are spread over tasks."""
    hot = cut_lineage(hot_orders(paid, refunded, hot_rows, salts), "hot-orders")
    if hot.isEmpty():
        return orders.join(paid, list(keys), "left").join(refunded, list(keys), "left")
    if len(keys) > 1:
        hot = _dealt_keys(hot, paid, refunded, keys)
    by = [*keys, "_salt"]
    rows = _with_salts(orders, hot, keys).join(_with_salts(paid, hot, keys, "payments"), by, "left").join(_with_salts(refunded, hot, keys, "refunds"), by, "left")
    # a dealt side has rows, but not in every salt
    missed = ((F.col("_dealt") == "payments") & F.col("_of_payments").isNull()) | ((F.col("_dealt") == "refunds") & F.col("_of_refunds").isNull())
    return rows.where(~F.coalesce(missed, F.lit(False))).drop("_salt", "_dealt", "_of_payments", "_of_refunds")


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    rules: Sequence[dict] = (),
    as_of: _dt.datetime = DEFAULT_AS_OF,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    keys: Sequence[str] = ("order_id",),
) -> DataFrame:
    """The 15-column order fact from four inputs (H1). ``keys``: the columns by which
    orders, payments and refunds meet, ``order_id`` and others that all three have."""
    v = _valid({"orders": orders, "customers": customers, "payments": payments, "refunds": refunds}, rules)
    base = v["orders"].select(*keys, "customer_id", "order_date", "order_status", "discount_amount")
    rows = _fan_out(
        _multiplied(base, v["customers"]), _side(v["payments"], "payments", keys), _side(v["refunds"], "refunds", keys), hot_rows, salts, keys
    )
    return rows.withColumns({
        "net_amount": F.col("payment_amount") - F.col("discount_amount"),
        "processed_at": F.lit(as_of).cast("timestamp"),
    }).select(*FACT_COLUMNS)


def fact_orders_dedup(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    rules: Sequence[dict] = (),
    as_of: _dt.datetime = DEFAULT_AS_OF,
) -> DataFrame:
    """One row per order without the payments x refunds fan-out.

    Payments and refunds are pre-aggregated per order (map-side partial
    aggregation, so a hot order id never reaches one task whole) and then
    joined; customers are reduced to distinct ids so duplicates cannot
    multiply orders.
    """
    v = _valid({"orders": orders, "customers": customers, "payments": payments, "refunds": refunds}, rules)
    o, c, p, r = v.values()
    pay = p.groupBy("order_id").agg(
        F.count("payment_id").alias("payment_count"),
        F.sum(F.when(F.col("payment_status") == "SUCCESS", 1).otherwise(0)).cast("bigint").alias("successful_payments"),
        F.sum("amount").alias("payment_amount"),
        F.sum(F.when(F.col("payment_status") == "SUCCESS", F.col("amount"))).alias("successful_amount"),
    )
    ref = r.groupBy("order_id").agg(
        F.count("refund_id").alias("refund_count"),
        F.sum("refund_amount").alias("refund_amount"),
    )
    # stored, so the join is between two plain inputs and a hot customer's orders can be split
    known = cut_lineage(c.select("customer_id").distinct(), "customer-ids").withColumn("customer_known", F.lit(True))
    return (
        o.join(known, "customer_id", "left")
        .join(pay, "order_id", "left")
        .join(ref, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            F.coalesce("customer_known", F.lit(False)).alias("customer_known"),
            "order_date",
            "order_status",
            F.coalesce("payment_count", F.lit(0)).alias("payment_count"),
            F.coalesce("successful_payments", F.lit(0)).cast("bigint").alias("successful_payments"),
            "payment_amount",
            "successful_amount",
            F.coalesce("refund_count", F.lit(0)).alias("refund_count"),
            "refund_amount",
            "discount_amount",
            (F.col("payment_amount") - F.col("discount_amount")).alias("net_amount"),
            F.lit(as_of).cast("timestamp").alias("processed_at"),
        )
    )
