"""Plan shape: pruning and pushdown reach the scan, no Python in the hot
path, group-wise limits are partial, exact profiles scan once."""

from govlake.operators import profile
from govlake.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scan_pruned_and_filter_pushed(spark, sf_dir):
    p = plan(registry.QUERIES["fact_orders"](spark, sf_dir))
    assert "GreaterThan(amount,0" in p  # policy rule pushed to the orders scan
    # columns the fact does not have are not read
    assert "product_id" not in p and "customer_name" not in p


def test_no_python_nodes_in_insight_chain(spark, sf_dir):
    for name in ("daily_insights", "insight_context", "pipeline_kpi_daily", "drift_decision", "guardian_decision"):
        p = plan(registry.QUERIES[name](spark, sf_dir))
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_exact_profile_scans_once(spark, sf_dir):
    orders = registry.entities(spark, sf_dir)["orders"]
    p = profile.column_profile(orders, "orders")._jdf.queryExecution().sparkPlan().toString()
    assert p.count("FileScan parquet") == 1


def test_drift_metrics_scans(spark, sf_dir):
    """One aggregate of figures, one of sketches, one value count, and the row count from the file footers."""
    df = profile.drift_metrics(registry.entities(spark, sf_dir)["customers"], "customers")
    df.collect()
    p = plan(df)
    final = p[p.index("Final Plan"):p.index("Initial Plan")]
    scans = [x.split("\n")[0] for x in final.split("FileScan parquet")[1:]]
    assert len(scans) == 4 and sum("ReadSchema: struct<>" in x for x in scans) == 1
