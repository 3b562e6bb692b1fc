"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1). Each query is executed to completion with the
``noop`` sink (the whole plan runs, nothing is collected): one warm-up, then
the median of ``$BENCH_REPEAT`` (default 3) timed runs. Prints one JSON line.

Besides the library's queries it times the reference's way of doing the same
work (one Spark job per column, four KPI scans, silver and quarantine as two
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from govlake.operators import gate, kpis  # noqa: E402
from govlake.plans import registry  # noqa: E402
from govlake.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def run_df(df):
    df.write.format("noop").mode("overwrite").save()


def reference_column_profile(spark, sf_dir):
    """One job per column, as the reference's guardian did."""
    df = registry.entities(spark, sf_dir)["orders"]
    for c in df.columns:
        df.select(
            (F.count(F.when(F.col(c).isNull(), 1)) / F.count(F.lit(1)) * 100).alias("null_pct"),
            F.countDistinct(F.col(c)).alias("distinct_cnt"),
        ).first()


def reference_kpis_apart(spark, sf_dir):
    fact = registry.base_fact(spark, sf_dir)
    for kpi in ("daily_order_revenue", "payment_success_rate", "refund_rate", "discount_impact"):
        run_df(kpis.over_fact(fact, kpi))


def reference_silver_quarantine_apart(spark, sf_dir):
    dec = registry.scenario_decision(spark, "bronze_orders")
    orders = registry.entities(spark, sf_dir)["orders"]
    run_df(gate.to_silver(orders, dec))
    run_df(gate.to_quarantine(orders, dec))


def reference_drift_metrics(spark, sf_dir):
    """The reference's drift profiler: a count, one job per column, one per
    numeric column and one per string column (collecting up to 50 groups)."""
    from govlake.operators import profile

    df = registry.entities(spark, sf_dir)["orders"]
    df.count()
    for c in df.columns:
        df.select((F.count(F.when(F.col(c).isNull(), 1)) / F.count(F.lit(1)) * 100), F.countDistinct(F.col(c))).first()
    for c in profile.numeric_columns(df):
        df.select(F.avg(c)).first()
    total = df.count()
    for c in profile.string_columns(df):
        df.groupBy(c).count().withColumn("pct", F.col("count") / F.lit(total) * 100).limit(50).collect()


def orders_drift_metrics(spark, sf_dir):
    from govlake.operators import profile

    run_df(profile.drift_metrics(registry.entities(spark, sf_dir)["orders"], "orders"))


def reference_kpi_over_fanout(spark, sf_dir):
    """kpi_daily_all over the materialised payments x refunds fact."""
    run_df(kpis.over_fact(registry.base_fact(spark, sf_dir), "daily_all"))


def library(name):
    return lambda spark, sf_dir: run_df(registry.QUERIES[name](spark, sf_dir))


def orders_profile(approx):
    from govlake.operators import profile

    return lambda spark, sf_dir: run_df(profile.column_profile(registry.entities(spark, sf_dir)["orders"], "orders", approx=approx))


BENCH = {
    "fact_orders": library("fact_orders"),
    "kpi_daily_all": library("kpi_daily_all"),
    "kpi_four_apart_reference": reference_kpis_apart,
    "kpi_daily_all_over_fanout_reference": reference_kpi_over_fanout,
    "column_profile_orders": orders_profile(False),
    "column_profile_orders_approx": orders_profile(True),
    "column_profile_per_column_reference": reference_column_profile,
    "drift_metrics_orders": orders_drift_metrics,
    "drift_metrics_per_column_reference": reference_drift_metrics,
    "route_orders": library("route_orders"),
    "silver_quarantine_apart_reference": reference_silver_quarantine_apart,
    "guardian_decision": library("guardian_decision"),
    "drift_decision": library("drift_decision"),
    "daily_insights": library("daily_insights"),
    "pipeline_kpi_daily": library("pipeline_kpi_daily"),
}


def main():
    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2)
    t0 = time.time()
    registry.entities(spark, SF_DIR)  # bronze written once (the ingestion step)
    bronze_s = time.time() - t0
    times = {"bronze_materialise": round(bronze_s, 3)}
    for name, fn in BENCH.items():
        fn(spark, SF_DIR)  # warm-up
        runs = []
        for _ in range(REPEAT):
            t = time.time()
            fn(spark, SF_DIR)
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)
    headline = [k for k in times if not k.endswith("_reference")]
    total = round(sum(times[k] for k in headline), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of median query seconds (library queries)",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(CPUS),
        "repeat": REPEAT,
    }))


if __name__ == "__main__":
    main()
