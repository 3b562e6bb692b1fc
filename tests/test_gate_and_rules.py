"""Gate truth table, null semantics, rule text handling, control tables."""

import datetime as dt
import json

import pytest

from govlake.functions.rules import and_all, normalize_expression
from govlake.operators import control, gate, policy
from govlake.operators.control import Decision


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, 30, " ok "), (2, -1, "x"), (3, None, "y"), (4, 200, "z")], "id int, age int, note string"
    )


@pytest.mark.parametrize("strategy", ["QUARANTINE", "CORRECT", "BOTH", "BLOCK", None])
@pytest.mark.parametrize("severity", ["LOW", "MEDIUM", "HIGH", None])
def test_gate_truth_table(spark, people, strategy, severity):
    d = Decision("t", strategy, "age BETWEEN 0 AND 120", (("note", "trim(note)"),), severity)
    silver = gate.to_silver(people, d)
    q = gate.to_quarantine(people, d)
    open_ = strategy != "BLOCK" and severity != "HIGH"
    assert silver.count() == (1 if open_ else 0)
    reasons = {r["quarantine_reason"] for r in q.collect()}
    if strategy == "BLOCK":
        assert q.count() == 4 and reasons == {"GUARDIAN_BLOCK"}
    elif severity == "HIGH":
        assert q.count() == 4 and reasons == {"DRIFT_HIGH_SEVERITY"}
    else:
        assert q.count() == 2 and reasons == {"GUARDIAN_FILTER_FAILED"}  # NULL age is in neither (S1)
    if open_ and strategy in ("CORRECT", "BOTH"):
        assert silver.first()["note"] == "ok"


def test_missing_decision_is_open(spark, people):
    empty_g = spark.createDataFrame([], "table_name string, allow_processing boolean, severity string, fix_json string, updated_at timestamp")
    empty_d = spark.createDataFrame([], "table_name string, allow_processing boolean, severity string, agent_result_json string, updated_at timestamp")
    d = control.read_decision(empty_g, empty_d, "t")
    assert d.open and d.filter_condition is None
    assert gate.to_silver(people, d).count() == 4


def test_nullsafe_split_is_exact(spark, people):
    d = Decision("t", "QUARANTINE", "age BETWEEN 0 AND 120", (), "LOW")
    routed = gate.route(people, d, null_policy="quarantine", quarantine_on="corrected")
    assert routed.count() == 4
    assert {r["id"]: r["route"] for r in routed.collect()}[3] == "GUARDIAN_FILTER_FAILED"


def test_corrections_are_sequential(spark):
    df = spark.createDataFrame([(-5, None)], "amount int, discount int")
    d = Decision("t", "BOTH", "amount > 0 AND discount <= amount",
                 (("discount", "coalesce(discount, 0)"), ("amount", "abs(amount)")), "LOW")
    row = gate.to_silver(df, d).first()
    assert row["amount"] == 5 and row["discount"] == 0
    # quarantine tests the received row (S2): it is in both outputs
    assert gate.to_quarantine(df, d).count() == 1
    assert gate.to_quarantine(df, d, quarantine_on="corrected").count() == 0


def test_correction_order_survives_json(spark):
    fix = {"strategy": "CORRECT", "silver_filter_condition": "", "correction_expression": {"b": "1", "a": "2", "c": "3"}}
    g = spark.createDataFrame([("t", True, "LOW", json.dumps(fix), dt.datetime(2024, 1, 1))],
                              "table_name string, allow_processing boolean, severity string, fix_json string, updated_at timestamp")
    d_empty = spark.createDataFrame([], "table_name string, allow_processing boolean, severity string, agent_result_json string, updated_at timestamp")
    d = control.read_decision(g, d_empty, "t")
    assert [c for c, _ in d.corrections] == ["b", "a", "c"]


def test_rule_text_helpers():
    assert normalize_expression("payment_status = SUCCESS") == "payment_status = 'SUCCESS'"
    assert normalize_expression("payment_status != SUCCESS") == "payment_status != 'SUCCESS'"
    assert and_all(["a > 0", "b = 1 OR c = 2", "  "]) == "(a > 0) AND (b = 1 OR c = 2)"


def test_or_rule_is_parenthesised(spark):
    df = spark.createDataFrame([(1, None), (2, -3), (3, 5)], "id int, age int")
    rules = [{"table": "c", "rule_name": "age", "expression": "age >= 0 OR age IS NULL"},
             {"table": "c", "rule_name": "id", "expression": "id < 3"}]
    valid, bad = policy.apply_row_rules(df, "c", rules)
    assert sorted(r["id"] for r in valid.collect()) == [1]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]
    failed = {r["id"]: r["failed_rules"] for r in policy.failed_rules(df, "c", rules).collect()}
    assert failed == {1: [], 2: ["age"], 3: ["id"]}


def test_no_rules_means_all_valid(spark):
    df = spark.createDataFrame([(1,)], "id int")
    valid, bad = policy.apply_row_rules(df, "x", [])
    assert valid.count() == 1 and bad.count() == 0 and bad.columns == df.columns


def test_latest_and_upsert(spark):
    schema = "table_name string, v int, updated_at timestamp"
    cur = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("a", 2, dt.datetime(2024, 1, 2)),
                                 ("b", 3, dt.datetime(2024, 1, 1))], schema)
    latest = {r["table_name"]: r["v"] for r in control.latest_control(cur).collect()}
    assert latest == {"a": 2, "b": 3}
    upd = spark.createDataFrame([("b", 9, dt.datetime(2024, 1, 5)), ("c", 7, dt.datetime(2024, 1, 5))], schema)
    once = control.upsert_latest(control.latest_control(cur), upd, ["table_name"], "updated_at")
    twice = control.upsert_latest(once, upd, ["table_name"], "updated_at")
    assert sorted(once.collect()) == sorted(twice.collect())  # idempotent
    assert {r["table_name"]: r["v"] for r in once.collect()} == {"a": 2, "b": 9, "c": 7}


def test_bad_rule_text_is_refused_before_running(spark, people):
    d = Decision("t", "QUARANTINE", "no_such_column > 1", (), "LOW")
    with pytest.raises(Exception):
        gate.to_silver(people, d)


def test_active_laws_and_latest_policy(spark):
    laws = spark.createDataFrame(
        [('{"row_rules": []}', True, dt.datetime(2024, 1, 1)), ('{"row_rules": [{"table": "x"}]}', True, dt.datetime(2024, 1, 2)),
         ('{"old": 1}', False, dt.datetime(2024, 1, 3))],
        "policy_json string, is_active boolean, created_at timestamp")
    assert policy.active_laws(laws).first()["policy_json"] == '{"row_rules": [{"table": "x"}]}'
    ctrl = spark.createDataFrame(
        [("p", ["orders"], json.dumps({"strategy": "A", "row_rules": [], "metric_rules": []}), dt.datetime(2024, 1, 1)),
         ("p", ["orders"], json.dumps({"strategy": "B", "row_rules": [{"table": "orders", "rule_name": "r",
                                                                       "expression": "amount > 0"}],
                                       "metric_rules": [{"table": "payments", "metric": "failure_rate",
                                                         "threshold_pct": 10}]}), dt.datetime(2024, 1, 2))],
        "pipeline_name string, table_name_list array<string>, policy_decision_json string, updated_timestamp timestamp")
    doc = policy.read_policy(policy.latest_policy(ctrl, "p"))
    assert doc["strategy"] == "B" and doc["row_rules"][0]["expression"] == "amount > 0"
    # numbers inside the rule maps arrive as strings
    assert doc["metric_rules"][0]["threshold_pct"] == "10"
    assert policy.metric_rules(policy.latest_policy(ctrl, "p")).first()["threshold_pct"] == 10.0


def test_malformed_policy_gives_no_rules(spark):
    ctrl = spark.createDataFrame([("not json",)], "policy_decision_json string")
    doc = policy.read_policy(ctrl)
    assert doc["row_rules"] == [] and doc["metric_rules"] == []


def test_register_views(spark):
    from govlake.sources.tables import register_views

    df = spark.createDataFrame([(1,)], "a int")
    assert register_views(spark, {"t_view": df}) == ["t_view"]
    assert spark.sql("SELECT SUM(a) AS s FROM t_view").first()["s"] == 1


def test_read_decisions_equals_read_decision(spark):
    from govlake.plans import registry

    g, d = registry.scenario_controls(spark)
    tables = list(registry.ENTITY_OF) + ["bronze_missing"]
    many = control.read_decisions(g, d, tables)
    for t in tables:
        assert many[t] == control.read_decision(g, d, t)


@pytest.mark.parametrize("text", [
    "(SELECT max(order_id) FROM t) > 1", "reflect('java.lang.Math', 'abs', 1) > 0", "`java_method`('a', 'b') = 'c'", "amount > 0; DROP TABLE t",
    "amount > 0 -- always", "EXISTS (SELECT 1)",
])
def test_rule_text_is_a_plain_condition(spark, text):
    from govlake.functions import rules

    with pytest.raises(ValueError):
        rules.validate_expressions(spark.range(1).selectExpr("id AS amount"), [text])


def test_rule_text_may_use_listed_functions(spark):
    from govlake.functions import rules

    df = spark.range(1).selectExpr("id AS amount", "'x' AS status")
    rules.validate_expressions(df, ["upper(trim(status)) IN ('A (b', 'select') AND (coalesce(amount, 0) BETWEEN 1 AND 2 OR NOT (amount > 3))"])


def test_laws_without_row_rules(spark):
    from govlake.operators import policy

    silver = {"payments": spark.createDataFrame([("FAILED",), ("SUCCESS",)], "payment_status string")}
    metric = {"metric_rules": [{"table": "payments", "metric": "failure_rate", "threshold_pct": "10", "severity": "HIGH", "on_fail": "ALERT"}]}
    assert [(r["kind"], r["observed"]) for r in policy.policy_decision(silver, metric).collect()] == [("metric", 50.0)]
    assert policy.policy_decision(silver, {}).count() == 0
    assert policy.read_policy(policy.policy_decision_json(policy.policy_decision(silver, {})))["row_rules"] == []


def law(table, metric, text, limit="1"):
    return {"table": table, "metric": metric, "metric_expression": text, "threshold_pct": limit, "severity": "LOW", "on_fail": "ALERT"}


def test_metric_laws_bring_their_expression(spark):
    from govlake.operators import policy

    silver = {"payments": spark.createDataFrame([("FAILED", 3), ("SUCCESS", 5)], "payment_status string, amount int"),
              "visits": spark.createDataFrame([(10, "a"), (30, "b"), (None, "it's")], "pages int, who string")}
    laws = {"metric_rules": [law("visits", "mean_pages", "avg(pages)"), law("visits", "named", "count_if(who LIKE '%''s')", "0"),
                             law("visits", "seldom", "count(1) - count(pages)", "1"), law("payments", "failure_rate", "sum(amount)", "7")]}
    decision = policy.policy_decision(silver, laws)
    got = {(r["table"], r["name"]): (r["observed"], r["expression"]) for r in decision.collect()}
    assert got == {("visits", "mean_pages"): (20.0, "avg(pages)"), ("visits", "named"): (1.0, "count_if(who LIKE '%''s')"),
                   ("payments", "failure_rate"): (8.0, "sum(amount)")}
    # the document carries the expressions, so reading it back decides the same
    again = policy.read_policy(policy.policy_decision_json(decision))
    assert sorted(map(str, policy.policy_decision(silver, again).collect())) == sorted(map(str, decision.collect()))
    plan = policy.policy_aggregates(silver, [], laws["metric_rules"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == len(silver)  # one aggregate per table
    empty = {"visits": silver["visits"].where("pages > 99")}
    assert policy.policy_decision(empty, {"metric_rules": [law("visits", "mean_pages", "avg(pages)")]}).count() == 0


@pytest.mark.parametrize("text", [
    "pages", "max(who)", "count(DISTINCT who)", "sum(pages) OVER ()", "collect_list(pages)", "(SELECT 1)", "avg(unknown)",
    "java_method('java.lang.System', 'exit', '1')", "max(pages); drop", "reflect('a', 'b')", "count(1) -- x", ""])
def test_metric_text_is_guarded(spark, text):
    from pyspark.errors import AnalysisException

    from govlake.operators import policy

    visits = {"visits": spark.createDataFrame([(1, "a")], "pages int, who string")}
    with pytest.raises((ValueError, AnalysisException)):
        policy.policy_aggregates(visits, [], [law("visits", "m", text)]).collect()


def test_one_metric_has_one_definition(spark):
    from govlake.operators import policy

    visits = {"visits": spark.createDataFrame([(1,)], "pages int")}
    with pytest.raises(ValueError, match="twice"):
        policy.policy_aggregates(visits, [], [law("visits", "m", "max(pages)"), law("visits", "m", "min(pages)")])


def test_two_corrections_of_one_column_are_chained(spark):
    from govlake.operators import quality

    checks = (quality.Check("t", "a", "ENUM", "s", "s = trim(s)", correction="trim(s)"),
              quality.Check("t", "b", "ENUM", "s", "s = upper(s)", correction="upper(s)"),
              quality.Check("t", "c", "NULL", "n", correction="coalesce(n, 0)"))
    _, dec = quality.guardian_run({"t": spark.createDataFrame([(" x", None)], "s string, n int")}, checks)
    dec.collect()
    assert [tuple(e) for e in dec.first()["corrections"]] == [("s", "upper((trim(s)))"), ("n", "coalesce(n, 0)")]
    assert quality.guardian_control(dec, "2024-01-01 00:00:00").first()["fix_json"]


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    from govlake.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))
