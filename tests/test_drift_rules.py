"""Drift rule bands at their edges (FIXTURES.md §3)."""

import pytest

from govlake.operators import drift

PAIRS_SCHEMA = "table_name string, metric_name string, current_value double, previous_value double, in_current boolean"


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIRS_SCHEMA)


def sev(df):
    return {r["metric_name"]: r["severity"] for r in df.collect()}


@pytest.mark.parametrize("change,expected", [(24.9, "LOW"), (25.0, "MEDIUM"), (50.0, "MEDIUM"), (50.1, "HIGH"), (-60.0, "HIGH")])
def test_volume_bands(spark, change, expected):
    p = pairs(spark, [("orders", "row_count", 1000.0 * (1 + change / 100), 1000.0, True)])
    out = drift.drift_volume(p).collect()
    assert len(out) == 1 and out[0]["severity"] == expected


def test_volume_first_run_and_zero_previous(spark):
    p = pairs(spark, [("orders", "row_count", 10.0, None, True), ("refunds", "row_count", 10.0, 0.0, True)])
    out = {r["table_name"]: r for r in drift.drift_volume(p).collect()}
    assert not out  # no previous snapshot (S14), or none to compare with: no issue


@pytest.mark.parametrize("rise,expected", [(19.9, "LOW"), (20.0, "MEDIUM"), (40.0, "MEDIUM"), (40.1, "HIGH"), (-30.0, "LOW")])
def test_null_bands(spark, rise, expected):
    p = pairs(spark, [("orders", "amount_null_pct", 50.0 + rise, 50.0, True)])
    out = drift.drift_null(p).collect()
    assert out[0]["severity"] == expected
    assert out[0]["column"] == "amount"


@pytest.mark.parametrize("fall,expected", [(14.9, "LOW"), (15.0, "MEDIUM"), (30.0, "MEDIUM"), (30.1, "HIGH")])
def test_cardinality_fall(spark, fall, expected):
    p = pairs(spark, [("orders", "order_id_distinct_cnt", 1000.0 * (1 - fall / 100), 1000.0, True),
                      ("orders", "customer_id_distinct_cnt", 1.0, 1000.0, True)])
    out = drift.drift_cardinality(p).collect()
    assert len(out) == 1  # primary key only
    assert out[0]["severity"] == expected


def test_cardinality_rise_uses_status_shares(spark):
    good = pairs(spark, [("orders", "order_id_distinct_cnt", 1200.0, 1000.0, True),
                         ("orders", "order_status::COMPLETED", 70.0, 70.0, True),
                         ("orders", "order_status::PENDING", 30.0, 30.0, True)])
    bad = pairs(spark, [("orders", "order_id_distinct_cnt", 1200.0, 1000.0, True),
                        ("orders", "order_status::COMPLETED", 20.0, 70.0, True),
                        ("orders", "order_status::CANCELLED", 80.0, 30.0, True)])
    assert drift.drift_cardinality(good).first()["severity"] == "LOW"
    assert drift.drift_cardinality(bad).first()["severity"] == "MEDIUM"


@pytest.mark.parametrize("change,expected", [(-39.9, "LOW"), (-40.0, "MEDIUM"), (-70.0, "MEDIUM"), (-70.1, "HIGH"),
                                             (90.0, "LOW"), (90.1, "MEDIUM")])
def test_numeric_bands(spark, change, expected):
    p = pairs(spark, [("orders", "amount_avg", 100.0 * (1 + change / 100), 100.0, True),
                      ("orders", "order_id_avg", 1.0, 100.0, True)])
    out = drift.drift_numeric(p).collect()
    assert len(out) == 1 and out[0]["severity"] == expected


@pytest.mark.parametrize("metric,change,expected", [
    ("payment_status::SUCCESS", -15.0, "MEDIUM"), ("payment_status::SUCCESS", -30.0, "MEDIUM"),
    ("payment_status::SUCCESS", -30.1, "HIGH"), ("payment_status::SUCCESS", -14.0, "LOW"),
    ("payment_status::FAILED", 25.0, "MEDIUM"), ("payment_status::FAILED", 50.0, "MEDIUM"),
    ("payment_status::FAILED", 50.1, "HIGH"), ("payment_status::FAILED", 24.0, "LOW"),
])
def test_category_bands(spark, metric, change, expected):
    p = pairs(spark, [("payments", metric, 40.0 * (1 + change / 100), 40.0, True)])
    assert sev(drift.drift_category(p))[metric] == expected


def test_category_value_gone_counts_as_zero(spark):
    p = pairs(spark, [("payments", "payment_status::SUCCESS", None, 40.0, False)])
    out = drift.drift_category(p).first()
    assert out["current_value"] == 0.0 and out["severity"] == "HIGH"


def test_decision_overall_and_no_drift(spark):
    p = pairs(spark, [("orders", "row_count", 2000.0, 1000.0, True), ("customers", "row_count", 100.0, 100.0, True)])
    issues = drift.drift_issues(p)
    tables = spark.createDataFrame([("orders",), ("customers",), ("refunds",)], "table_name string")
    dec = {r["table_name"]: r for r in drift.drift_decision(issues, tables).collect()}
    assert dec["orders"]["overall_severity"] == "HIGH" and dec["orders"]["allow_processing"] is False
    assert dec["customers"]["overall_severity"] == "LOW" and dec["customers"]["allow_processing"] is True
    assert dec["refunds"]["issue_count"] == 0
    audit = drift.drift_audit(issues, drift.drift_decision(issues, tables), "2024-01-02 00:00:00")
    assert audit.filter("table_name = 'refunds' AND issue_type = 'NO_DRIFT'").count() == 1


def test_pairs_previous_is_latest_non_null(spark):
    h = spark.createDataFrame(
        [("t", "m", 1.0, "2024-01-01 00:00:00"), ("t", "m", None, "2024-01-02 00:00:00"),
         ("t", "m", 3.0, "2024-01-03 00:00:00"), ("t", "gone", 5.0, "2024-01-02 00:00:00")],
        "table_name string, metric_name string, metric_value double, captured_at string",
    ).selectExpr("table_name", "metric_name", "metric_value", "CAST(captured_at AS TIMESTAMP) AS captured_at")
    out = {r["metric_name"]: r for r in drift.drift_pairs(h).collect()}
    assert out["m"]["current_value"] == 3.0 and out["m"]["previous_value"] == 1.0
    assert out["gone"]["current_value"] is None and out["gone"]["in_current"] is False


def test_unchanged_metrics_are_no_issues(spark):
    p = pairs(spark, [("orders", "row_count", 10.0, 10.0, True), ("orders", "amount_null_pct", 5.0, 5.0, True),
                      ("orders", "order_status::COMPLETED", 50.0, 50.0, True)])
    assert drift.drift_issues(p).count() == 0


def test_rare_value_keeps_its_share_beside_many_new_ones(spark):
    """A status at 1 % in both snapshots is not drift, however many other values are more frequent."""
    from govlake.operators import profile

    def snapshot(others):
        rows = [("SUCCESS",)] * 10 + [(f"V{i % others}",) for i in range(990)]
        return profile.drift_metrics(spark.createDataFrame(rows, "payment_status string"), "payments")

    first = profile.stamp(snapshot(3), "2024-01-01 00:00:00")
    second = profile.stamp(snapshot(66), "2024-01-02 00:00:00")
    out = drift.drift_category(drift.drift_pairs(first.unionByName(second)))
    assert not [r for r in out.collect() if r["severity"] == "HIGH" or "SUCCESS" in r["metric_name"]]


def test_null_and_the_text_none_are_one_metric(spark):
    from govlake.operators import profile

    df = spark.createDataFrame([("None",), (None,), (None,), ("SUCCESS",)], "payment_status string")
    shares = {r["metric_name"]: r["metric_value"] for r in profile.drift_metrics(df, "payments").collect() if "::" in r["metric_name"]}
    assert shares == {"payment_status::None": 75.0, "payment_status::SUCCESS": 25.0}
