"""Partial profiles per drop: only new drops are scanned, and they add up to the whole."""

import tempfile

import pytest
from govlake.operators import increments, profile


def rows(df):
    return {r["column_name"]: r for r in df.collect()}


def test_two_drops_add_up(spark):
    root = tempfile.mkdtemp(prefix="govlake-inc-", dir="/tmp")
    whole = spark.range(50000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 1000) AS a", "CAST(id % 300 AS DECIMAL(10,2)) / 3 AS d", "concat('s', id % 20000) AS s")
    whole.where("id < 30000").write.parquet(f"{root}/t/batch=0")
    first = increments.profile_drops(spark, f"{root}/t", f"{root}/p")
    assert {r["n_rows"] for r in first.collect()} == {30000}
    whole.where("id >= 30000").write.parquet(f"{root}/t/batch=1")
    assert increments.new_drops(spark, f"{root}/t", f"{root}/p") == [1]
    second = increments.profile_drops(spark, f"{root}/t", f"{root}/p")
    assert {r["n_rows"] for r in second.collect()} == {20000} and increments.new_drops(spark, f"{root}/t", f"{root}/p") == []
    got, exact, figures = rows(increments.stored_profile(spark, f"{root}/p")), rows(profile.column_profile(whole, "t")), rows(profile.figures(whole, whole.columns))
    for c, e in exact.items():
        assert got[c]["n_rows"] == 50000 and got[c]["null_percent"] == pytest.approx(e["null_percent"])
        assert abs(got[c]["distinct_count"] - e["distinct_count"]) <= increments.ERROR * e["distinct_count"] + 1
        if c != "s":
            assert got[c]["average"] == pytest.approx(figures[c]["average"], rel=1e-6)
    # the table's files are not read for the profile
    plan = increments.stored_profile(spark, f"{root}/p")._jdf.queryExecution().executedPlan().toString()
    assert f"{root}/t" not in plan


def test_a_drop_profiled_again_counts_once_and_columns_may_come_later(spark):
    root = tempfile.mkdtemp(prefix="govlake-inc-", dir="/tmp")
    spark.range(10).write.parquet(f"{root}/t/batch=0")
    spark.range(5).selectExpr("id", "'x' AS channel").write.parquet(f"{root}/t/batch=7")
    increments.profile_drops(spark, f"{root}/t", f"{root}/p")
    increments.profile_drops(spark, f"{root}/t", f"{root}/p", drops=[7])
    got = rows(increments.stored_profile(spark, f"{root}/p"))
    assert got["id"]["n_rows"] == 15 and got["id"]["distinct_count"] == 10
    assert got["channel"]["null_percent"] == pytest.approx(10 / 15 * 100) and got["channel"]["distinct_count"] == 1


def test_nothing_new(spark):
    root = tempfile.mkdtemp(prefix="govlake-inc-", dir="/tmp")
    assert increments.new_drops(spark, f"{root}/none", f"{root}/p") == []
