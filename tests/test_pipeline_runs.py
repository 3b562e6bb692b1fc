"""Two pipeline runs over one root: histories, controls and datasets build up."""

import datetime as dt

from govlake.plans import pipeline, registry
from govlake.plans.snapshots import as_of
from govlake.sources.sinks import scratch_dir


def test_two_runs(spark, sf_dir):
    root = scratch_dir(spark, "test-pipeline")
    e = registry.entities(spark, sf_dir)
    laws = registry.law_table(spark)
    first = pipeline.run(as_of(e, "2001-06-01"), laws, root, dt.datetime(2024, 1, 1))
    assert {r["drift_severity"] for r in first.quarantine["orders"].select("drift_severity").distinct().collect()} <= {"LOW"}
    changed = dict(e, customers=e["customers"].drop("city"), refunds=e["refunds"].where("refund_id % 3 = 0"))
    out = pipeline.run(changed, laws, root, dt.datetime(2024, 1, 2))
    assert out.silver["customers"].count() == out.silver["refunds"].count() == 0
    days = out.kpi_daily.count()
    again = pipeline.run(changed, laws, root, dt.datetime(2024, 1, 2))  # the same run again replaces its datasets

    guardian = {r["table_name"]: r for r in again.guardian_control.collect()}
    assert len(guardian) == 4 and guardian["bronze_customers"]["severity"] == "HIGH"  # a removed column
    assert not guardian["bronze_customers"]["allow_processing"] and guardian["bronze_orders"]["allow_processing"]
    drifts = {r["table_name"]: r["severity"] for r in again.drift_control.collect()}
    # more orders with more open than completed ones: MEDIUM, which alerts and does not close
    assert drifts == {"bronze_orders": "MEDIUM", "bronze_customers": "LOW", "bronze_payments": "LOW", "bronze_refunds": "HIGH"}
    assert again.quarantine["customers"].count() == e["customers"].count()
    assert {r["quarantine_reason"] for r in again.quarantine["refunds"].select("quarantine_reason").distinct().collect()} == {"DRIFT_HIGH_SEVERITY"}
    for name in ("drift", "quality", "schema"):
        stamps = spark.read.parquet(f"{root}/history/{name}").select("captured_at").distinct().count()
        assert stamps == 2
    # every log has both runs, and the repeated run left each of its rows once
    for name in pipeline.LOGS:
        log = pipeline.read_log(spark, root, name)
        assert {str(r["run"]) for r in log.select("run").distinct().collect()} <= {"20240101T000000", "20240102T000000"}
    audit = pipeline.read_log(spark, root, "guardian_audit")
    assert audit.count() == audit.distinct().count() > 4 and audit.count() == pipeline.read_log(spark, root, "guardian_events").count()
    assert audit.where("issue_type = 'SCHEMA_DRIFT' OR severity = 'HIGH'").select("run").distinct().count() == 1
    quarantined = {r["table_name"]: r["n"] for r in pipeline.read_log(spark, root, "quarantine").where("run = '20240102T000000'").groupBy("table_name").sum("records").withColumnRenamed("sum(records)", "n").collect()}
    assert quarantined["customers"] == e["customers"].count() and quarantined["refunds"] == changed["refunds"].count()
    assert len(again.kpis) == 6 and all(k.count() > 0 for k in again.kpis.values())
    broken = again.gold_quarantine["payments"].select("failed_rules").distinct().collect()
    assert [r["failed_rules"] for r in broken] == [["successful_payment"]]
    row = again.policy_control.collect()
    assert len(row) == 1 and row[0]["table_name_list"] == ["bronze_" + t for t in e]
    assert spark.read.parquet(f"{root}/runs/20240102T000000/kpi_daily").count() == days > 0


def test_nothing_reads_bronze_after_the_route(spark, sf_dir):
    e = registry.entities(spark, sf_dir)
    out = pipeline.run(e, registry.law_table(spark), scratch_dir(spark, "test-pipeline"))
    for df in (out.fact, out.kpi_daily, out.silver["orders"], out.quarantine["orders"]):
        assert "govlake-bronze" not in df._jdf.queryExecution().executedPlan().toString()
