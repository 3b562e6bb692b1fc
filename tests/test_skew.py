"""Hot keys: one customer with a third of all orders, one order with many
payments and refunds. Results stay exact; no pairs are needed for KPIs."""

import collections

from pyspark.sql import functions as F

from govlake.operators import facts, kpis, profile


def fbag(df):
    return collections.Counter(tuple(float(x) if hasattr(x, "as_tuple") else x for x in r)
                               for r in df.select(*sorted(df.columns)).collect())


def test_hot_customer_and_hot_order(spark):
    n = 3000
    orders = spark.range(1, n + 1).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("customer_id"),
        F.expr("CAST(date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) AS TIMESTAMP_NTZ)").alias("order_date"),
        F.lit("COMPLETED").alias("order_status"),
        F.lit(10).cast("decimal(18,2)").alias("amount"),
        F.lit(1).cast("decimal(18,4)").alias("discount_amount"),
    )
    customers = spark.range(1, n + 1).select(F.col("id").alias("customer_id"))
    # order 1 is hot: 40 payments and 60 refunds (2,400 fact rows)
    payments = spark.range(0, n + 40).select(
        (F.col("id") + 1000000).alias("payment_id"),
        F.when(F.col("id") < 40, F.lit(1)).otherwise(F.col("id") - 39).cast("bigint").alias("order_id"),
        F.when(F.col("id") % 4 == 0, "FAILED").otherwise("SUCCESS").alias("payment_status"),
        F.lit("CARD").alias("payment_method"),
        F.lit(10).cast("decimal(18,2)").alias("amount"),
    )
    refunds = spark.range(0, 60).select(
        (F.col("id") + 5000000).alias("refund_id"), F.lit(1).cast("bigint").alias("order_id"),
        F.lit("APPROVED").alias("refund_status"), F.lit(2).cast("decimal(18,4)").alias("refund_amount"),
        F.lit("LATE").alias("refund_reason"),
    )
    args = (orders, customers, payments, refunds)
    fact = facts.fact_orders(*args)
    contrib = kpis.order_contributions(*args)
    assert fbag(kpis.over_fact(fact, "daily_all")) == fbag(kpis.kpi_daily_all_orders(contrib))
    assert fbag(kpis.over_fact(fact, "customer_lifetime_value")) == fbag(kpis.kpi_customer_lifetime_value_orders(contrib))
    assert contrib.count() == n  # one row per order, however hot
    hot = {r["customer_id"]: r["total_orders"] for r in kpis.kpi_customer_lifetime_value_orders(contrib).collect()}
    assert hot[7] == n // 3 + 1
    prof = {r["column_name"]: r for r in profile.column_profile(orders, "orders").collect()}
    assert prof["customer_id"]["distinct_count"] == orders.select("customer_id").distinct().count()


def test_hot_order_is_spread_and_exact(spark):
    """Orders over the limit are joined apart, by payments or by refunds, with the same rows."""
    o = spark.range(1, 30).selectExpr("id AS order_id", "id % 5 AS customer_id", "TIMESTAMP_NTZ'2024-01-01' AS order_date",
                                      "'COMPLETED' AS order_status", "CAST(10 AS DECIMAL(18,2)) AS amount", "CAST(1 AS DECIMAL(18,4)) AS discount_amount")
    c = spark.createDataFrame([(1,), (1,), (2,)], "customer_id long")
    p = spark.range(60).selectExpr("id AS payment_id", "CASE WHEN id < 40 THEN 3 ELSE id - 38 END AS order_id", "'SUCCESS' AS payment_status",
                                   "'CARD' AS payment_method", "CAST(10 AS DECIMAL(18,2)) AS amount")
    r = spark.range(50).selectExpr("id AS refund_id", "CASE WHEN id < 30 THEN 4 WHEN id < 35 THEN 3 ELSE id - 30 END AS order_id",
                                   "'APPROVED' AS refund_status", "CAST(2 AS DECIMAL(18,4)) AS refund_amount", "'LATE' AS refund_reason")
    plain = facts.fact_orders(o, c, p, r)
    spread = facts.fact_orders(o, c, p, r, hot_rows=20, salts=7)
    assert fbag(spread) == fbag(plain) and plain.count() > 40 * 5 + 30
    assert spread.columns == list(facts.FACT_COLUMNS)


def test_payments_and_refunds_are_shuffled_once(spark):
    """With and without hot orders; an order that is hot on both sides, one without an order row, and null ids."""
    o = spark.range(1, 30).selectExpr("id AS order_id", "id % 5 AS customer_id", "TIMESTAMP_NTZ'2024-01-01' AS order_date",
                                      "'COMPLETED' AS order_status", "CAST(10 AS DECIMAL(18,2)) AS amount", "CAST(1 AS DECIMAL(18,4)) AS discount_amount")
    c = spark.range(5).selectExpr("id AS customer_id")
    p = spark.range(90).selectExpr("NULLIF(id, 5) AS payment_id", "CASE WHEN id < 30 THEN 3 WHEN id < 60 THEN 99 WHEN id < 85 THEN NULL ELSE id - 80 END AS order_id",
                                   "'SUCCESS' AS payment_status", "'CARD' AS payment_method", "CAST(10 AS DECIMAL(18,2)) AS amount")
    r = spark.range(50).selectExpr("id AS refund_id", "CASE WHEN id < 40 THEN 3 ELSE id - 30 END AS order_id",
                                   "'APPROVED' AS refund_status", "CAST(2 AS DECIMAL(18,4)) AS refund_amount", "'LATE' AS refund_reason")
    hot = {x["order_id"]: (x["_dealt"], x["_salts"]) for x in facts.hot_orders(p, r, 20, 7).collect()}
    assert hot == {3: ("refunds", 3), 99: ("payments", 3)}
    plain = facts.fact_orders(o, c, p, r)
    spread = facts.fact_orders(o, c, p, r, hot_rows=20, salts=7)
    assert fbag(spread) == fbag(plain) and plain.where("order_id = 3").count() == 30 * 40
    assert facts.hot_orders(p.limit(0), r.limit(0), 20, 7).count() == 0
    for fact in (plain, spread):
        text = fact._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("payment_id") and text.count("Range (0, 90") == 1 and text.count("Range (0, 50") == 1


def test_kpis_do_not_join_all_orders_on_the_customer(spark):
    """A hot customer: with unique customers nothing is shuffled on customer_id."""
    o = spark.range(3000).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS customer_id", "TIMESTAMP_NTZ'2024-01-01' AS order_date",
                                     "CAST(1 AS DECIMAL(18,4)) AS discount_amount")
    c = spark.range(3000).selectExpr("id AS customer_id")
    p = spark.range(10).selectExpr("id AS payment_id", "id AS order_id", "'SUCCESS' AS payment_status", "CAST(10 AS DECIMAL(18,2)) AS amount")
    r = spark.range(10).selectExpr("id AS refund_id", "id AS order_id", "CAST(2 AS DECIMAL(18,4)) AS refund_amount")
    contrib = kpis.order_contributions(o, c, p, r)
    contrib.collect()
    plan = contrib._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [customer_id" in plan and "hashpartitioning(customer_id" not in plan


def _feeds(spark):
    """Orders with payments by several methods and by none, an order that comes twice, ids that are NULL."""
    o = spark.range(12).selectExpr("NULLIF(IF(id = 11, 3, id), 10) AS order_id", "id % 3 AS customer_id", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(CAST(id % 2 AS INT)) AS order_date",
                                   "'COMPLETED' AS order_status", "CAST(10 AS DECIMAL(18,2)) AS amount", "CAST(NULLIF(id, 5) AS DECIMAL(18,4)) AS discount_amount")
    c = spark.createDataFrame([(1,), (1,), (2,)], "customer_id long")
    p = spark.range(40).selectExpr("id AS payment_id", "NULLIF(id % 9, 8) AS order_id", "IF(id % 4 = 0, 'FAILED', 'SUCCESS') AS payment_status",
                                   "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 < 3 THEN 'CARD' ELSE 'UPI' END AS payment_method",
                                   "CAST(IF(id % 9 = 2, NULL, id) AS DECIMAL(18,2)) AS amount")
    r = spark.range(9).selectExpr("id AS refund_id", "id % 4 AS order_id", "'APPROVED' AS refund_status", "CAST(2 AS DECIMAL(18,4)) AS refund_amount", "'LATE' AS refund_reason")
    return o, c, p, r


def test_one_join_gives_both_kinds_of_contributions(spark):
    feeds = _feeds(spark)
    joined = kpis.method_contributions(*feeds)
    own, read = kpis.order_contributions(*feeds), kpis.order_contributions(*feeds, joined=joined)
    assert read.dtypes == own.dtypes and fbag(read) == fbag(own)
    own, read = (kpis.kpi_payment_method_performance_orders(*feeds, joined=j) for j in (None, joined))
    assert read.dtypes == own.dtypes and fbag(read) == fbag(own) == fbag(kpis.over_fact(facts.fact_orders(*feeds), "payment_method_performance"))


def test_hot_orders_meet_by_all_keys(spark):
    """Order 3 is hot under one day and has no payments, or none at all, under others."""
    day = lambda df, *days: df.crossJoin(spark.createDataFrame([(d,) for d in days], "day string"))
    o, c, p, r = _feeds(spark)
    o, p, r = day(o, "a", "b", "c"), day(p, "a").unionByName(day(p.where("order_id <> 3"), "b")), day(r, "a", "b")
    keys = ("order_id", "day")
    plain, spread = facts.fact_orders(o, c, p, r, keys=keys), facts.fact_orders(o, c, p, r, hot_rows=3, salts=3, keys=keys)
    text = F.concat(F.col("order_id").cast("string"), F.lit("@"), "day")
    by_text = facts.fact_orders(o.withColumn("order_id", text), c, p.withColumn("order_id", text), r.withColumn("order_id", text))
    want = by_text.withColumn("order_id", F.split("order_id", "@")[0].cast("long"))
    assert fbag(spread) == fbag(plain) == fbag(want)
