"""Value shares of all string columns, and values that leave the report without being gone."""

import datetime as dt
import tempfile

import pytest
from govlake.operators import drift, profile


def shares(spark, rows, schema="c string", **more):
    return {(r["column_name"], r["kind"], r["value"]): (r["n"], r["share_pct"]) for r in profile.category_profile(spark.createDataFrame(rows, schema), "t", **more).collect()}


def test_top_by_count_then_value_and_the_rest(spark):
    rows = [(f"v{i:03d}",) for i in range(80) for _ in range(2 if i >= 60 else 1)] + [(None,)] * 5
    got = shares(spark, rows)
    values = [v for (_, kind, v) in got if kind == "value"]
    # NULL is the most frequent value, then the 20 that come twice, then 29 of the others in order
    assert sorted(values) == sorted([f"v{i:03d}" for i in range(60, 80)] + [f"v{i:03d}" for i in range(29)])
    assert got["c", "null", None] == (5, 5 / 105 * 100) and got["c", "other", None][0] == 31
    assert sum(p for _, p in got.values()) == pytest.approx(100.0)


def test_hot_value_and_high_cardinality(spark):
    """A hot value among a hundred thousand rare ones: it alone is reported, with its exact count."""
    df = spark.range(300000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 500 = 1 THEN 'warm' ELSE concat('v', id) END AS c", "'one' AS d")
    got = {(r["column_name"], r["kind"], r["value"]): r["n"] for r in profile.category_profile(df, "t").collect()}
    warm = df.where("c = 'warm'").count()
    assert got == {("c", "value", "hot"): 100000, ("c", "value", "warm"): warm, ("c", "other", None): 200000 - warm, ("d", "value", "one"): 300000, ("d", "other", None): 0}


def test_two_scans_and_no_shuffle_of_values(spark):
    path = tempfile.mkdtemp(prefix="govlake-values-", dir="/tmp")
    spark.range(0, 200000, 1, 8).selectExpr("concat('v', id) AS c", "concat('w', id % 5) AS d").write.mode("overwrite").parquet(path)
    out = profile.category_profile(spark.read.parquet(path), "t")
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("Final Plan") : text.index("Initial Plan")]
    assert final.count("FileScan") == 2  # sketches, then exact counts
    # below a shuffle of values there is the join with the candidates
    counts = final[final.index("partial_count(1)]") :]
    assert "approx_top_k_accumulate" in final and "BroadcastHashJoin" in counts[: counts.index("FileScan")]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_special_column_names_and_empty_tables(spark):
    got = shares(spark, [("x", "a"), ("y", "a")], "`a b` string, `c.d` string")
    assert got["a b", "value", "x"][0] == 1 and got["c.d", "value", "a"] == (2, 100.0)
    empty = spark.createDataFrame([], "c string, _rescued_data string")
    assert all(r["n"] == 0 and r["share_pct"] is None for r in profile.category_profile(empty, "t").collect())
    assert profile.category_profile(spark.createDataFrame([(1,)], "n int"), "t").collect() == []
    names = {r["metric_name"] for r in profile.drift_metrics(empty, "t").collect()}
    assert {"row_count", "c_null_pct", "c_distinct_cnt"} <= names and not any("_rescued_data::" in n for n in names)


def snapshots(spark, *runs):
    """Histories of runs over one column, each watching the one before."""
    history, before = None, None
    for day, rows in enumerate(runs, 1):
        metrics = profile.drift_metrics(spark.createDataFrame([(r,) for r in rows], "city string"), "customers", previous=before)
        before = spark.createDataFrame(metrics.collect(), metrics.schema)
        stamped = profile.stamp(before, dt.datetime(2024, 1, day))
        history = stamped if history is None else history.unionByName(stamped)
    return history


def test_a_value_that_leaves_the_top_is_not_gone(spark):
    crowd = [f"v{i:02d}" for i in range(60)]
    first = ["a"] * 30 + ["b"] * 30 + crowd[:10]
    second = [c for c in crowd for _ in range(100)] + ["a"]  # a is far behind 60 others, b has no row
    pairs = {r["metric_name"]: r for r in drift.drift_pairs(snapshots(spark, first, second)).collect()}
    assert pairs["city::a"]["current_value"] == pytest.approx(1 / 6001 * 100)
    assert pairs["city::b"]["current_value"] == 0.0 and pairs["city::b"]["in_current"]
    issues = {r["metric_name"] for r in drift.drift_category(drift.drift_pairs(snapshots(spark, first, second))).collect()}
    assert {"city::a", "city::b"} <= issues  # both changed; neither is mistaken for the other


def test_values_reported_two_runs_ago_are_not_compared(spark):
    first, second, third = ["a"] * 10 + ["b"] * 10, ["a"] * 20, ["a"] * 20 + ["b"] * 5
    pairs = {r["metric_name"]: r for r in drift.drift_pairs(snapshots(spark, first, second, third)).collect()}
    assert pairs["city::b"]["previous_value"] == 0.0 and pairs["city::b"]["current_value"] == 20.0
    crowd = [f"v{i:03d}" for i in range(150)]
    # 120 values with one row each: 50 are reported; the others never were, so none of them is gone later
    gone = drift.drift_pairs(snapshots(spark, crowd[:120], crowd[:120] + ["x"] * 3)).where("NOT in_current").collect()
    assert gone == []


def test_statuses_of_the_rules_are_counted_however_rare(spark):
    rows = ["SUCCESS"] * 5000 + ["FAILED"]
    df = spark.createDataFrame([(r,) for r in rows], "payment_status string")
    got = {r["metric_name"]: r["metric_value"] for r in profile.drift_metrics(df, "payments").collect()}
    assert got["payment_status::FAILED"] == pytest.approx(1 / 5001 * 100) and got["payment_status_other_pct"] == 0.0
    assert "payment_status::REJECTED" not in got


def test_profile_of_metrics_is_the_column_profile(spark, sf_dir):
    from govlake.plans import registry

    e = registry.entities(spark, sf_dir)["refunds"]
    metrics = profile.drift_metrics(e, "refunds")
    got = sorted(tuple(r) for r in profile.profile_of_metrics(metrics, {"refunds": e.columns}).collect())
    assert got == sorted(tuple(r) for r in profile.column_profile(e, "refunds").collect())


def test_wide_exact_profile_is_batched(spark):
    df = spark.range(40).selectExpr(*[f"id % {i + 1} AS c{i}" for i in range(40)])
    plan = profile.column_profile(df, "wide")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Expand") == 40 // profile.BATCH


def test_sketches_do_not_share_an_aggregate_with_an_exact_count(spark):
    """Else every key would be shuffled with a sketch buffer per column."""
    df = spark.range(40).selectExpr("id AS payment_id", "id % 3 AS order_id", "CAST(id % 2 AS STRING) AS payment_status")
    prof = profile.column_profile(df, "payments", approx=True)
    plan = prof._jdf.queryExecution().sparkPlan().toString()
    by_key = [line for line in plan.split("\n") if "keys=[payment_id" in line]
    assert by_key and not any("approx_count_distinct" in line for line in by_key)
    assert {r["column_name"]: r["distinct_count"] for r in prof.collect()} == {"payment_id": 40, "order_id": 3, "payment_status": 2}
