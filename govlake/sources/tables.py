"""Batch reads of named tables (A4) and the four sales entities over the
driver's TPC-H-like tables.

The reference ships no data; its four feeds (customers, orders, payments,
refunds) are mapped onto ``customer``, ``nation``, ``orders`` and ``lineitem``
by arithmetic on keys, which plants NULLs, bad values, missing payments and
repeated attempts. The mapping is plain column expressions, so Catalyst
prunes columns and pushes filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table by name (A4)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c: Column, scale: int = 2) -> Column:
    return c.cast(f"decimal(18,{scale})")


def _method(priority: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "CARD")
        .when(priority == "2-HIGH", "UPI")
        .when(priority == "3-MEDIUM", "WALLET")
        .when(priority == "4-NOT SPECIFIED", "NETBANKING")
        .otherwise("COD")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, customer_name, age, city, segment."""
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    age = F.when(F.col("c_custkey") % 29 == 0, F.lit(None).cast("int")).otherwise(
        ((F.col("c_custkey") * 7) % 131 - 5).cast("int")
    )
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        age.alias("age"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, customer_id, product_id, order_date, order_status, amount, discount_amount."""
    o = load(spark, sf_dir, "orders")
    li = load(spark, sf_dir, "lineitem")
    disc = li.groupBy("l_orderkey").agg(
        F.sum(_money(F.col("l_extendedprice")) * F.col("l_discount").cast("decimal(4,2)"))
        .cast("decimal(18,4)")
        .alias("disc")
    )
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("CANCELLED")
    )
    price = _money(F.col("o_totalprice"))
    amount = F.when(key % 53 == 0, -price).otherwise(price)
    discount = F.when(key % 41 == 0, F.lit(None).cast("decimal(18,4)")).otherwise(
        F.coalesce(F.col("disc"), F.lit(0).cast("decimal(18,4)"))
    )
    return o.join(disc, o.o_orderkey == disc.l_orderkey, "left").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (key % 97).alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("order_status"),
        amount.alias("amount"),
        discount.alias("discount_amount"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payment_id, order_id, payment_status, payment_method, amount.

    One attempt per order except every 11th order (none) and a second,
    successful attempt for every 13th order.
    """
    o = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = (
        F.when(key % 10 == 0, "FAILED").when(key % 10 == 1, "PENDING").otherwise("SUCCESS")
    )
    first = o.filter(key % 11 != 0).select(
        (key * 10 + 1).alias("payment_id"),
        key.alias("order_id"),
        status.alias("payment_status"),
        _method(F.col("o_orderpriority")).alias("payment_method"),
        _money(F.col("o_totalprice")).alias("amount"),
    )
    second = o.filter(key % 13 == 0).select(
        (key * 10 + 2).alias("payment_id"),
        key.alias("order_id"),
        F.lit("SUCCESS").alias("payment_status"),
        _method(F.col("o_orderpriority")).alias("payment_method"),
        _money(F.col("o_totalprice")).alias("amount"),
    )
    return first.unionByName(second)


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """refund_id, order_id, refund_status, refund_amount, refund_reason."""
    li = load(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    status = (
        F.when(line % 3 == 0, "REJECTED").when(line % 3 == 1, "APPROVED").otherwise("PENDING")
    )
    amount = F.when(line == 7, F.lit(0).cast("decimal(18,4)")).otherwise(
        (_money(F.col("l_extendedprice")) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
        .cast("decimal(18,4)")
    )
    reason = F.when(F.col("l_linestatus") == "F", "DAMAGED").otherwise("LATE")
    return li.filter(F.col("l_returnflag") == "R").select(
        (F.col("l_orderkey") * 10 + line).alias("refund_id"),
        F.col("l_orderkey").alias("order_id"),
        status.alias("refund_status"),
        amount.alias("refund_amount"),
        reason.alias("refund_reason"),
    )


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four bronze entities keyed by entity name."""
    return {
        "orders": sales_orders(spark, sf_dir),
        "customers": customers(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "refunds": refunds(spark, sf_dir),
    }


def register_views(spark: SparkSession, frames: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose DataFrames to SQL users as temp views (A11); returns the names."""
    names = []
    for name, df in frames.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
