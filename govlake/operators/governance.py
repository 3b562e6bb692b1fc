"""Governance questions over decision logs, and the KPI checks the reference
documents without code (O1-O3, P1-P3).

All are grouped aggregates or windows over day-sized series; none pulls rows
to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# --------------------------------------------------------------------------- O1
def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per day, table and reason.

    Input: union of quarantine outputs with a ``table_name`` column."""
    return quarantine.groupBy(
        F.to_date("quarantined_at").alias("quarantine_day"), "table_name", "quarantine_reason"
    ).agg(F.count(F.lit(1)).alias("records"))


# --------------------------------------------------------------------------- O2
def drift_alerts_weekly(audit: DataFrame, severities=("MEDIUM", "HIGH")) -> DataFrame:
    """Drift alerts (MEDIUM and HIGH by default) per week, issue and severity."""
    return (
        audit.filter(F.col("severity").isin(*severities))
        .groupBy(F.to_date(F.date_trunc("week", "event_time")).alias("week_start"), "issue_type", "severity")
        .agg(F.count(F.lit(1)).alias("alerts"), F.countDistinct("table_name").alias("tables"))
    )


# --------------------------------------------------------------------------- O3
def top_failed_rules(failed: DataFrame, k: int = 10, column: str = "failed_rules") -> DataFrame:
    """The ``k`` rules broken by most rows (top-k is the feature).

    Input rows carry ``table_name`` and an array of broken rule names; the
    explode + count is partially aggregated, so a hot rule is combined per
    map task before the shuffle."""
    return (
        failed.select("table_name", F.explode(column).alias("rule_name"))
        .groupBy("table_name", "rule_name")
        .agg(F.count(F.lit(1)).alias("failed_rows"))
        .orderBy(F.col("failed_rows").desc(), "table_name", "rule_name")
        .limit(k)
    )


# --------------------------------------------------------------------------- P1
def churn(orders: DataFrame, days: int = 90) -> DataFrame:
    """Share of customers with no order in the ``days`` before the data's
    last order day. One row: reference_day, customers, churned, churn_rate
    (none for a feed without orders).

    Customers are counted by the day of their last order; the reference day
    and the shares come from that frame of one row per day.
    """
    last = orders.groupBy("customer_id").agg(F.max(F.to_date("order_date")).alias("last_day"))
    by_day = last.groupBy("last_day").agg(F.count(F.lit(1)).alias("n"))
    dated = by_day.withColumn("reference_day", F.max("last_day").over(Window.partitionBy(F.lit(1))))
    gone = F.col("last_day") < F.date_sub("reference_day", days)
    return dated.groupBy("reference_day").agg(
        F.sum("n").alias("customers"),
        F.sum(F.when(gone, F.col("n")).otherwise(0)).cast("bigint").alias("churned"),
    ).withColumn("churn_rate", F.try_divide(F.col("churned").cast("double") * 100.0, F.col("customers").cast("double")))


# --------------------------------------------------------------------------- P2
def kpi_anomaly_score(daily: DataFrame, value: str = "net_revenue", window: int = 28, threshold: float = 3.0) -> DataFrame:
    """z-score of a daily KPI against the ``window`` previous days.

    Mean and variance come from exact sums (DECIMAL money stays exact) taken
    to DOUBLE once, so the score does not depend on summation order. The
    input is one row per day, so the ordered window is day-bounded.
    """
    w = Window.orderBy("order_date").rowsBetween(-window, -1)
    x = F.col(value)
    n = F.count(x).over(w)
    s1 = F.sum(x).over(w).cast("double")
    # DECIMAL(18,4) squares are exact (37 digits); wider operands would be
    # rounded to 6 places by Spark's precision cap.
    xd = x.cast("decimal(18,4)")
    s2 = F.sum(xd * xd).over(w).cast("double")
    mean = F.try_divide(s1, n.cast("double"))
    var = F.try_divide(s2 - s1 * s1 / n.cast("double"), (n - 1).cast("double"))
    out = daily.select("order_date", x.cast("double").alias(value), n.alias("window_days"), mean.alias("window_mean"),
                       F.when(var > 0, F.sqrt(var)).alias("window_std"))
    z = F.try_divide(F.col(value) - F.col("window_mean"), F.col("window_std"))
    return out.withColumn("z_score", z).withColumn("is_anomaly", F.coalesce(F.abs(z) > threshold, F.lit(False)))


# --------------------------------------------------------------------------- P3
def freshness_sla(tables: dict[str, DataFrame], check_time: _dt.datetime, limit_hours: float = 24.0,
                  ts_col: str = "processed_at") -> DataFrame:
    """Per table: rows, last stamp, hours since it at ``check_time`` and
    whether that is within the limit (an empty table is not)."""
    frames = []
    for name, df in tables.items():
        frames.append(df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.max(ts_col).cast("timestamp").alias("last_processed_at"),
        ))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    lag = (F.lit(check_time).cast("timestamp").cast("long") - F.col("last_processed_at").cast("long")) / 3600.0
    return out.withColumn("lag_hours", lag).withColumn(
        "within_sla", F.coalesce(F.col("lag_hours") <= F.lit(limit_hours), F.lit(False))
    )
