"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the full driver tables at ``sf_dir`` through the entity mapping
and returns a report frame (money as DOUBLE, fixed ``as_of`` stamps) whose
columns match the oracle SQL in ``govlake.plans.oracle``.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.config import DATASETS, DEFAULT_AS_OF
from govlake.operators import facts, kpis
from govlake.plans.scenarios import BASE_POLICY
from govlake.sources import tables
from govlake.sources.bronze import bronze_tables, stored_path, stored_table
from govlake.sources.sinks import cut_lineage, scratch_dir
from govlake.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def report(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE at the edge (the oracle does the same)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(df[f.name].cast("double").alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four bronze feeds, materialised once per data directory."""
    return bronze_tables(spark, sf_dir)


def base_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir)
    return facts.fact_orders(e["orders"], e["customers"], e["payments"], e["refunds"], BASE_POLICY["row_rules"])


# ---------------------------------------------------------------- step 1-2
@register("fact_orders")
def q_fact_orders(spark, sf_dir):
    return report(base_fact(spark, sf_dir))


def base_contrib(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order contributions under the base policy (KPIs without fan-out)."""
    e = entities(spark, sf_dir)
    return kpis.order_contributions(e["orders"], e["customers"], e["payments"], e["refunds"], BASE_POLICY["row_rules"])


@register("kpi_daily_order_revenue")
def q_kpi_daily_order_revenue(spark, sf_dir):
    return report(kpis.daily_kpi(base_kpi_all(spark, sf_dir), "daily_order_revenue"))


@register("kpi_payment_success_rate")
def q_kpi_payment_success_rate(spark, sf_dir):
    return report(kpis.daily_kpi(base_kpi_all(spark, sf_dir), "payment_success_rate"))


@register("kpi_refund_rate")
def q_kpi_refund_rate(spark, sf_dir):
    return report(kpis.daily_kpi(base_kpi_all(spark, sf_dir), "refund_rate"))


@register("kpi_customer_lifetime_value")
def q_kpi_customer_lifetime_value(spark, sf_dir):
    return report(kpis.kpi_customer_lifetime_value_orders(base_contrib(spark, sf_dir)))


@register("kpi_payment_method_performance")
def q_kpi_payment_method_performance(spark, sf_dir):
    e = entities(spark, sf_dir)
    return report(kpis.kpi_payment_method_performance_orders(
        e["orders"], e["customers"], e["payments"], e["refunds"], BASE_POLICY["row_rules"]))


@register("kpi_discount_impact")
def q_kpi_discount_impact(spark, sf_dir):
    return report(kpis.daily_kpi(base_kpi_all(spark, sf_dir), "discount_impact"))


@register("kpi_daily_all")
def q_kpi_daily_all(spark, sf_dir):
    return report(kpis.kpi_daily_all_orders(base_contrib(spark, sf_dir)))


@register("fact_orders_dedup")
def q_fact_orders_dedup(spark, sf_dir):
    e = entities(spark, sf_dir)
    return report(
        facts.fact_orders_dedup(e["orders"], e["customers"], e["payments"], e["refunds"], BASE_POLICY["row_rules"])
    )


# ---------------------------------------------------------------- step 3, 9
from govlake.plans import insights, signals  # noqa: E402


def base_kpi_all(spark, sf_dir):
    return kpis.kpi_daily_all_orders(base_contrib(spark, sf_dir))


def base_signals(spark, sf_dir):
    return signals.signals_from_kpi_all(base_kpi_all(spark, sf_dir))


def base_insights(spark, sf_dir):
    return insights.daily_insights(base_signals(spark, sf_dir))


@register("daily_metrics")
def q_daily_metrics(spark, sf_dir):
    return report(signals.daily_metrics_onepass(base_kpi_all(spark, sf_dir)))


@register("daily_metrics_joined")
def q_daily_metrics_joined(spark, sf_dir):
    # the day table is written once; its four KPI views are joined from files
    kpi_all = cut_lineage(base_kpi_all(spark, sf_dir), "kpi-daily")
    views = ("daily_order_revenue", "payment_success_rate", "refund_rate", "discount_impact")
    return report(signals.daily_metrics(*[kpis.daily_kpi(kpi_all, v) for v in views]))


@register("daily_trends")
def q_daily_trends(spark, sf_dir):
    return report(signals.daily_trends(signals.daily_metrics_onepass(base_kpi_all(spark, sf_dir))))


@register("weekly_change")
def q_weekly_change(spark, sf_dir):
    return report(signals.weekly_change(signals.daily_metrics_onepass(base_kpi_all(spark, sf_dir))))


@register("health_signals")
def q_health_signals(spark, sf_dir):
    return report(base_signals(spark, sf_dir))


@register("insight_input")
def q_insight_input(spark, sf_dir):
    return report(signals.insight_input(base_signals(spark, sf_dir)))


@register("revenue_driver")
def q_revenue_driver(spark, sf_dir):
    s = insights.revenue_driver(base_signals(spark, sf_dir))
    return report(s.select("order_date", "net_revenue_wow_pct", "orders_wow_pct", "revenue_driver"))


@register("daily_insights")
def q_daily_insights(spark, sf_dir):
    return report(base_insights(spark, sf_dir))


@register("recent_insights")
def q_recent_insights(spark, sf_dir):
    return report(insights.recent_insights(base_insights(spark, sf_dir)))


@register("insight_context")
def q_insight_context(spark, sf_dir):
    return insights.insight_context(base_insights(spark, sf_dir))


@register("fenced_json")
def q_fenced_json(spark, sf_dir):
    # every answer in one of the forms a model gives: a JSON fence, a plain fence, bare text
    conv = tables.load(spark, sf_dir, "conversations")
    doc = F.format_string('{"turn": %d}', "turn")
    form = (F.col("conv_id") + F.col("turn")) % 3
    conv = conv.withColumn(
        "text",
        F.when(form == 0, F.concat(F.lit("Sure:\n```json\n"), doc, F.lit("\n```\n"), "text"))
        .when(form == 1, F.concat(F.lit("```\n"), "text", F.lit("\n```")))
        .otherwise(F.when(F.col("turn") % 2 == 0, doc).otherwise(F.col("text"))),
    )
    return insights.extract_fenced_json(conv).select("conv_id", "turn", "role", "fence", "json_text", "is_json")


# ---------------------------------------------------------------- step 4: gate
from govlake.operators import control, gate  # noqa: E402
from govlake.plans import scenarios  # noqa: E402

ENTITY_OF = {f.bronze: f.name for f in DATASETS}


def scenario_controls(spark, guardian_overrides=None, drift_overrides=None):
    g = spark.createDataFrame(scenarios.guardian_control_rows(guardian_overrides), scenarios.GUARDIAN_CONTROL_SCHEMA)
    d = spark.createDataFrame(scenarios.drift_control_rows(drift_overrides), scenarios.DRIFT_CONTROL_SCHEMA)
    return g, d


def scenario_decision(spark, bronze, guardian_overrides=None, drift_overrides=None):
    g, d = scenario_controls(spark, guardian_overrides, drift_overrides)
    return control.read_decision(g, d, bronze)


def bronze(spark, sf_dir, bronze_name):
    return entities(spark, sf_dir)[ENTITY_OF[bronze_name]]


def _silver_query(bronze_name):
    def q(spark, sf_dir):
        dec = scenario_decision(spark, bronze_name)
        return report(gate.to_silver(bronze(spark, sf_dir, bronze_name), dec))

    return q


def _quarantine_query(bronze_name):
    def q(spark, sf_dir):
        dec = scenario_decision(spark, bronze_name)
        return report(gate.to_quarantine(bronze(spark, sf_dir, bronze_name), dec))

    return q


for _b, _e in ENTITY_OF.items():
    register(f"silver_{_e}")(_silver_query(_b))
    register(f"quarantine_{_e}")(_quarantine_query(_b))

_BLOCK = {"bronze_orders": {"strategy": "BLOCK", "silver_filter_condition": "amount > 0", "correction_expression": {}}}


@register("quarantine_guardian_block")
def q_quarantine_guardian_block(spark, sf_dir):
    dec = scenario_decision(spark, "bronze_orders", guardian_overrides=_BLOCK)
    return report(gate.to_quarantine(bronze(spark, sf_dir, "bronze_orders"), dec))


@register("quarantine_drift_high")
def q_quarantine_drift_high(spark, sf_dir):
    dec = scenario_decision(spark, "bronze_payments", drift_overrides={"bronze_payments": "HIGH"})
    return report(gate.to_quarantine(bronze(spark, sf_dir, "bronze_payments"), dec))


@register("silver_gate_closed")
def q_silver_gate_closed(spark, sf_dir):
    """Rows per table on both sides of closed and open gates: orders are
    blocked by the guardian, payments by drift, the others pass."""
    g, d = scenario_controls(spark, _BLOCK, {"bronze_payments": "HIGH"})
    decisions = control.read_decisions(g, d, list(ENTITY_OF))
    sides = []
    for b, t in ENTITY_OF.items():
        for side, f in (("silver", gate.to_silver), ("quarantine", gate.to_quarantine)):
            rows = f(bronze(spark, sf_dir, b), decisions[b]).agg(F.count(F.lit(1)).alias("rows"))
            sides.append(rows.select(F.lit(t).alias("table_name"), F.lit(side).alias("side"), F.lit(decisions[b].open).alias("gate_open"), "rows"))
    return snapshots.union_all(sides)


@register("route_orders")
def q_route_orders(spark, sf_dir):
    dec = scenario_decision(spark, "bronze_orders")
    return report(gate.route(bronze(spark, sf_dir, "bronze_orders"), dec))


@register("route_nullsafe")
def q_route_nullsafe(spark, sf_dir):
    dec = scenario_decision(spark, "bronze_customers")
    routed = gate.route(bronze(spark, sf_dir, "bronze_customers"), dec, null_policy="quarantine", quarantine_on="corrected")
    return report(routed)


# ---------------------------------------------------------------- step 6, 8: profile, drift
from govlake.operators import drift, increments, profile  # noqa: E402
from govlake.plans import snapshots  # noqa: E402


def _per_table(spark, sf_dir, fn):
    e = entities(spark, sf_dir)
    return snapshots.union_all([fn(e[t], t) for t in snapshots.TABLE_ORDER])


@register("column_profile")
def q_column_profile(spark, sf_dir):
    return _per_table(spark, sf_dir, lambda df, t: profile.column_profile(df, t))


@register("column_profile_approx")
def q_column_profile_approx(spark, sf_dir):
    """Sketched distinct counts beside the exact ones: each must be within the
    sketch's error bound (5 % standard error, three of them)."""
    exact = _per_table(spark, sf_dir, lambda df, t: profile.column_profile(df, t))
    sketch = _per_table(spark, sf_dir, lambda df, t: profile.column_profile(df, t, approx=True)).withColumnRenamed("distinct_count", "approx")
    off = F.abs(F.col("approx") - F.col("distinct_count"))
    return exact.join(sketch.drop("null_percent"), ["table_name", "column_name"]).select(
        "table_name", "column_name", "null_percent", "distinct_count", (off <= 0.15 * F.col("distinct_count") + 1).alias("within_bound"))


@register("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    return _per_table(spark, sf_dir, lambda df, t: profile.numeric_profile(df, t))


@register("category_profile")
def q_category_profile(spark, sf_dir):
    return _per_table(spark, sf_dir, lambda df, t: profile.category_profile(df, t))


@register("drift_metrics")
def q_drift_metrics(spark, sf_dir):
    return _per_table(spark, sf_dir, lambda df, t: profile.drift_metrics(df, t))


@register("column_profile_incremental")
def q_column_profile_incremental(spark, sf_dir):
    """Each feed in two drops, profiled after each: the second run scans the
    second drop only and its profile is that of the whole feed."""
    e = entities(spark, sf_dir)
    early, out = snapshots.as_of(e), []
    for f in DATASETS:
        root = scratch_dir(spark, "increments")
        key = early[f.name].select(f.primary_key).distinct()
        early[f.name].write.parquet(f"{root}/table/batch=0")
        increments.profile_drops(spark, f"{root}/table", f"{root}/profile")
        e[f.name].join(key, f.primary_key, "left_anti").write.parquet(f"{root}/table/batch=1")
        scanned = increments.profile_drops(spark, f"{root}/table", f"{root}/profile")
        scanned = scanned.groupBy("column_name").agg(F.sum("n_rows").alias("rows_scanned"))
        merged = increments.stored_profile(spark, f"{root}/profile").withColumnRenamed("distinct_count", "estimate")
        exact = profile.column_profile(e[f.name], f.name).drop("null_percent")
        off = F.abs(F.col("estimate") - F.col("distinct_count"))
        out.append(merged.join(scanned, "column_name").join(exact, "column_name").select(
            "table_name", "column_name", "n_rows", "rows_scanned", "null_percent", "average", "distinct_count",
            (off <= increments.ERROR * F.col("distinct_count") + 1).alias("within_bound")))
    return snapshots.union_all(out)


def drift_pairs_of(spark, sf_dir):
    """A drift run: the earlier snapshot's metrics are the stored history
    table (written by the earlier run, here once per data folder); this run
    profiles the current feeds, appends, and pairs the metrics. History and
    pairs are small tables read by every rule, so they are checkpointed to
    the shared folder once instead of being recomputed per rule."""
    checkpoint_dir(spark)
    e = entities(spark, sf_dir)
    earlier = stored_table(spark, "drift-history-t1",
                           lambda: snapshots.snapshot_metrics(snapshots.as_of(e), scenarios.T1), sf_dir,
                           snapshots.CUTOFF, profile.TOP_VALUES, profile.LEAST_PART)
    history = earlier.unionByName(snapshots.snapshot_metrics(e, scenarios.T2, earlier))
    history = snapshots.compact(history).checkpoint(eager=True)
    return snapshots.compact(drift.drift_pairs(history)).checkpoint(eager=True)


@register("drift_pairs")
def q_drift_pairs(spark, sf_dir):
    return drift_pairs_of(spark, sf_dir)


for _name, _rule in (("drift_volume", drift.drift_volume), ("drift_null", drift.drift_null),
                     ("drift_cardinality", drift.drift_cardinality), ("drift_numeric", drift.drift_numeric),
                     ("drift_category", drift.drift_category)):
    register(_name)((lambda rule: (lambda spark, sf_dir: rule(drift_pairs_of(spark, sf_dir))))(_rule))


def _table_list(spark):
    return spark.createDataFrame([(t,) for t in snapshots.TABLE_ORDER], "table_name string")


@register("drift_decision")
def q_drift_decision(spark, sf_dir):
    issues = drift.drift_issues(drift_pairs_of(spark, sf_dir))
    return drift.drift_decision(issues, _table_list(spark))


# ---------------------------------------------------------------- step 7: quality, guardian, control
from govlake.config import FEEDS_BY_NAME  # noqa: E402
from govlake.operators import quality  # noqa: E402

BRONZE_NAMES = {t: FEEDS_BY_NAME[t].bronze for t in snapshots.TABLE_ORDER}


def _evolved(t, df):
    """The feeds as a later file drop: the orders' amount arrives as DOUBLE, a
    channel column is added and product_id is gone; three in ten refunds have
    lost their reason."""
    if t == "orders":
        return df.select(
            "order_id", "customer_id", "order_date", "order_status",
            F.col("amount").cast("double").alias("amount"), "discount_amount", F.lit("web").alias("channel"),
        )
    if t == "refunds":
        return df.withColumn("refund_reason", F.when(F.col("refund_id") % 10 >= 3, F.col("refund_reason")))
    return df


def _drops(spark, sf_dir):
    """Two written drops per feed: as of the cut-off day, and evolved."""
    e = entities(spark, sf_dir)
    early = snapshots.as_of(e)
    first = {t: cut_lineage(early[t], "drop") for t in snapshots.TABLE_ORDER}
    return first, {t: cut_lineage(_evolved(t, e[t]), "drop") for t in snapshots.TABLE_ORDER}


def _schema_history(first, second):
    at = [(d, s) for d, s in ((first, scenarios.T1), (second, scenarios.T2))]
    return snapshots.union_all([quality.schema_snapshot(d[t], t, s) for d, s in at for t in snapshots.TABLE_ORDER])


@register("schema_drift")
def q_schema_drift(spark, sf_dir):
    history = _schema_history(*_drops(spark, sf_dir))
    rows = history.groupBy("table_name").agg(
        F.min_by("rows", "captured_at").alias("previous_rows"), F.max_by("rows", "captured_at").alias("current_rows"))
    return quality.schema_drift(history).join(rows, "table_name")


def _guardian_all(spark, sf_dir):
    """The guardian over the evolved drops with all four detections."""
    first, second = _drops(spark, sf_dir)
    checkpoint_dir(spark)
    nulls = snapshots.snapshot_quality(first, scenarios.T1).unionByName(snapshots.snapshot_quality(second, scenarios.T2))
    return quality.guardian_run(second, schema_history=_schema_history(first, second),
                                null_history=snapshots.compact(nulls).checkpoint(eager=True))


@register("guardian_issues_all")
def q_guardian_issues_all(spark, sf_dir):
    issues, _ = _guardian_all(spark, sf_dir)
    return issues.select("table_name", "check_name", "issue_type", "severity", "column_name", "failing_rows")


@register("guardian_decision_all")
def q_guardian_decision_all(spark, sf_dir):
    return _decision_report(_guardian_all(spark, sf_dir)[1])


@register("null_spikes")
def q_null_spikes(spark, sf_dir):
    checkpoint_dir(spark)
    e = entities(spark, sf_dir)
    earlier = stored_table(spark, "quality-history-t1",
                           lambda: snapshots.snapshot_quality(snapshots.as_of(e), scenarios.T1), sf_dir,
                           snapshots.CUTOFF)
    history = snapshots.compact(earlier.unionByName(snapshots.snapshot_quality(e, scenarios.T2))).checkpoint(eager=True)
    return quality.null_spikes(history)


@register("enum_violations")
def q_enum_violations(spark, sf_dir):
    e = entities(spark, sf_dir)
    return snapshots.union_all(
        [quality.enum_violations(e[t], t, quality.allowed_values(t)) for t in snapshots.TABLE_ORDER if quality.allowed_values(t)]
    )


@register("range_violations")
def q_range_violations(spark, sf_dir):
    e = entities(spark, sf_dir)
    return snapshots.union_all([quality.range_violations(e[t], t, quality.valid_ranges(t)) for t in snapshots.TABLE_ORDER])


@register("guardian_issues")
def q_guardian_issues(spark, sf_dir):
    issues, _ = quality.guardian_run(entities(spark, sf_dir))
    return issues.select("table_name", "check_name", "issue_type", "severity", "column_name", "message",
                         "failing_rows", "failing_pct")


def _decision_report(decision):
    return decision.select(
        "table_name", "strategy", "silver_filter_condition",
        quality.corrections_text("corrections").alias("corrections"),
        "overall_severity", "allow_processing", "issue_count",
    )


@register("guardian_decision")
def q_guardian_decision(spark, sf_dir):
    _, decision = quality.guardian_run(entities(spark, sf_dir))
    return _decision_report(decision)


def _guardian_controls(spark, sf_dir, early_tables=snapshots.TABLE_ORDER, late_tables=snapshots.TABLE_ORDER):
    e = entities(spark, sf_dir)
    early = snapshots.as_of(e)
    _, d1 = quality.guardian_run({t: early[t] for t in early_tables})
    _, d2 = quality.guardian_run({t: e[t] for t in late_tables})
    return (quality.guardian_control(d1, scenarios.T1, BRONZE_NAMES),
            quality.guardian_control(d2, scenarios.T2, BRONZE_NAMES))


def _control_report(ctrl):
    parsed = control.parse_guardian(ctrl).select(
        "table_name", "strategy", "silver_filter_condition",
        quality.corrections_text("corrections").alias("corrections"), "updated_at",
    )
    return parsed.join(ctrl.select("table_name", "allow_processing", "severity"), "table_name")


@register("guardian_control")
def q_guardian_control(spark, sf_dir):
    _, decision = quality.guardian_run(entities(spark, sf_dir))
    return _control_report(quality.guardian_control(decision, scenarios.T2, BRONZE_NAMES))


@register("control_latest")
def q_control_latest(spark, sf_dir):
    c1, c2 = _guardian_controls(spark, sf_dir)
    return _control_report(control.latest_control(c1.unionByName(c2)))


@register("control_upsert")
def q_control_upsert(spark, sf_dir):
    c1, c2 = _guardian_controls(spark, sf_dir, late_tables=("orders", "payments"))
    return _control_report(control.upsert_latest(c1, c2, ["table_name"], "updated_at"))


# ---------------------------------------------------------------- step 5: policy, gold
from govlake.operators import policy  # noqa: E402
from govlake.plans.scenarios import FULL_POLICY  # noqa: E402

PK = {f.name: f.primary_key for f in DATASETS}


def silver_tables(spark, sf_dir):
    """The four silver tables under the scenario decisions."""
    g, d = scenario_controls(spark)
    decisions = control.read_decisions(g, d, list(ENTITY_OF))
    return {t: gate.to_silver(bronze(spark, sf_dir, b), decisions[b]) for b, t in ENTITY_OF.items()}


def _policy_metrics(s):
    return policy.policy_metrics(s["customers"], s["orders"], s["payments"], s["refunds"])


@register("policy_metrics")
def q_policy_metrics(spark, sf_dir):
    return _policy_metrics(silver_tables(spark, sf_dir))


def _metric_rules_frame(spark, laws):
    return spark.createDataFrame(
        [(r["table"], r["metric"], float(r["threshold_pct"]), r.get("severity"), r.get("on_fail"))
         for r in laws["metric_rules"]],
        "table string, metric string, threshold_pct double, severity string, on_fail string",
    )


@register("policy_metric_violations")
def q_policy_metric_violations(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return policy.metric_violations(_policy_metrics(s), F.broadcast(_metric_rules_frame(spark, FULL_POLICY)))


def _policy_decision(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return policy.policy_decision(s, FULL_POLICY)


@register("policy_decision")
def q_policy_decision(spark, sf_dir):
    return _policy_decision(spark, sf_dir)


@register("policy_decision_json")
def q_policy_decision_json(spark, sf_dir):
    """The decision document, read back rule by rule."""
    doc = policy.policy_decision_json(_policy_decision(spark, sf_dir))
    strategy = policy.parse_policy(doc).select(F.col("policy.strategy").alias("strategy"))
    rows = policy.policy_rules(doc).select(F.lit("row").alias("kind"), "table", F.col("rule_name").alias("name"), "expression",
                                           F.lit(None).cast("double").alias("threshold_pct"), "severity", "on_fail")
    metrics = policy.metric_rules(doc).select(F.lit("metric").alias("kind"), "table", F.col("metric").alias("name"),
                                              F.lit(None).cast("string").alias("expression"), "threshold_pct", "severity", "on_fail")
    return rows.unionByName(metrics).withColumn("strategy", F.lit(strategy.first()["strategy"]))


@register("policy_rules")
def q_policy_rules(spark, sf_dir):
    return policy.policy_rules(policy.policy_decision_json(_policy_decision(spark, sf_dir)))


@register("policy_metric_laws")
def q_policy_metric_laws(spark, sf_dir):
    """Metric laws with their own expressions, decided over the feeds and a fifth table."""
    lines = {"order_lines": tables.load(spark, sf_dir, "lineitem")}
    return policy.policy_decision(silver_tables(spark, sf_dir) | lines, scenarios.METRIC_LAWS)


def _gold_quarantine_query(table):
    def q(spark, sf_dir):
        return report(policy.gold_quarantine(silver_tables(spark, sf_dir)[table], table, FULL_POLICY["row_rules"]))

    return q


for _t in snapshots.TABLE_ORDER:
    register(f"gold_quarantine_{_t}")(_gold_quarantine_query(_t))


@register("policy_failed_rules")
def q_policy_failed_rules(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    frames = []
    for t in snapshots.TABLE_ORDER:
        marked = policy.failed_rules(s[t], t, FULL_POLICY["row_rules"])
        frames.append(
            marked.filter(F.size("failed_rules") > 0).select(
                F.lit(t).alias("table_name"), F.col(PK[t]).alias("row_key"),
                F.array_join("failed_rules", ",").alias("failed_rules"),
            )
        )
    return snapshots.union_all(frames)


@register("fact_orders_governed")
def q_fact_orders_governed(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return report(facts.fact_orders(s["orders"], s["customers"], s["payments"], s["refunds"], FULL_POLICY["row_rules"]))


# ---------------------------------------------------------------- step 10: streams
from govlake.sources import sinks  # noqa: E402
from govlake.sources.sinks import path_exists  # noqa: E402
from govlake.streaming import bronze as streaming  # noqa: E402
from govlake.streaming import schemas  # noqa: E402


def _write_drops(spark, sf_dir, bad_text: bool):
    """Two CSV drops of the orders feed in a fresh folder: orders before the
    snapshot cut-off, then the rest (optionally with amounts of cancelled
    orders written as text with a currency prefix, which do not parse)."""
    orders = entities(spark, sf_dir)["orders"]
    root = scratch_dir(spark, "stream")
    early = F.col("order_date") < F.lit(snapshots.CUTOFF).cast("timestamp_ntz")
    first = orders.filter(early)
    second = orders.filter(~early)
    if bad_text:
        # the later drop has a new column, its columns in another order, and amounts that do not parse
        usd = F.concat(F.lit("USD "), F.col("amount").cast("string"))
        second = second.select(
            F.when(F.col("order_id") % 4 == 0, "web").alias("channel"),
            F.when(F.col("order_status") == "CANCELLED", usd).otherwise(F.col("amount").cast("string")).alias("amount"),
            *[c for c in reversed(orders.columns) if c != "amount"],
        )
    return orders.schema, root, first, second


def _ingest_two_drops(spark, sf_dir, bad_text):
    schema, root, first, second = _write_drops(spark, sf_dir, bad_text)
    feed, table, ckpt = f"{root}/feed", f"{root}/bronze", f"{root}/checkpoint"
    first.write.option("header", True).csv(feed)
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)
    _deliver(spark, second.write.option("header", True), root, feed)
    streaming.ingest(streaming.bronze_stream(spark, feed), schema, table, ckpt)
    return spark.read.parquet(table).drop("batch")


def _deliver(spark, writer, root, feed) -> int:
    """Files of a drop, named as people name them, put into the feed's folder; how many."""
    drop = f"{root}/drop-{uuid.uuid4().hex}"
    writer.csv(drop)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to_path(drop).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to_path(feed))
    files = [f.getPath() for f in fs.listStatus(to_path(drop)) if f.getPath().getName().startswith("part-")]
    for i, f in enumerate(files):
        fs.rename(f, to_path(to_path(feed), f"orders [{i}] 100% \u00fcber {uuid.uuid4().hex}.csv"))
    return len(files)


@register("bronze_stream_orders")
def q_bronze_stream_orders(spark, sf_dir):
    return report(_ingest_two_drops(spark, sf_dir, bad_text=True))


@register("bronze_rescued")
def q_bronze_rescued(spark, sf_dir):
    df = _ingest_two_drops(spark, sf_dir, bad_text=True)
    return report(df.filter(F.col("_rescued_data").isNotNull()).select("order_id", "amount", "_rescued_data"))


@register("stream_route")
def q_stream_route(spark, sf_dir):
    schema, root, first, second = _write_drops(spark, sf_dir, bad_text=False)
    feed, out, ckpt = f"{root}/feed", f"{root}/routed", f"{root}/checkpoint"
    dec = scenario_decision(spark, "bronze_orders")
    first.write.option("header", True).csv(feed)
    streaming.stream_route(streaming.bronze_stream(spark, feed), schema, dec, out, ckpt)
    second.write.mode("append").option("header", True).csv(feed)
    streaming.stream_route(streaming.bronze_stream(spark, feed), schema, dec, out, ckpt)
    routed = spark.read.parquet(out)
    return report(routed.select(*[c for c in gate.route(entities(spark, sf_dir)["orders"], dec).columns]))


@register("bronze_malformed")
def q_bronze_malformed(spark, sf_dir):
    """Drops with quoted line breaks, with surplus fields and with missing ones: every record is kept."""
    orders = entities(spark, sf_dir)["orders"].select("order_id", "order_status", F.col("amount").cast("string").alias("amount"))
    root = scratch_dir(spark, "stream")
    part = F.col("order_id") % 3
    note = F.concat(F.lit("first, then\nsecond "), "order_status")
    _deliver(spark, orders.where(part == 0).select("order_id", note.alias("order_status"), "amount").write.option("header", True), root, f"{root}/feed")
    raw = F.concat_ws(",", F.col("order_id").cast("string"), "order_status", F.when(part == 1, F.concat("amount", F.lit(",late"))))
    lines = orders.where(part != 0).select(raw.alias("order_id,order_status,amount"))
    _deliver(spark, lines.write.option("header", True).option("quote", "").option("sep", "\t"), root, f"{root}/feed")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_status", T.StringType()), T.StructField("amount", T.DoubleType())])
    streaming.ingest(streaming.bronze_stream(spark, f"{root}/feed"), schema, f"{root}/bronze", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/bronze").drop("batch")


@register("schema_evolution")
def q_schema_evolution(spark, sf_dir):
    """A stream without a schema argument over three drops, started anew for each: whole
    amounts; amounts with cents and a new column; product ids that do not parse."""
    orders = entities(spark, sf_dir)["orders"].withColumn("drop", F.when(F.year("order_date") < 1997, 1).when(F.year("order_date") < 1999, 2).otherwise(3))
    root = scratch_dir(spark, "stream")
    store = schemas.SchemaStore(spark, f"{root}/schema")
    bad = F.concat(F.when((F.col("drop") == 3) & (F.col("order_status") == "CANCELLED"), "P").otherwise(""), F.col("product_id").cast("string"))
    amount = F.when(F.col("drop") == 1, F.floor("amount").cast("string")).otherwise(F.col("amount").cast("string"))
    rows = orders.select("drop", "order_id", bad.alias("product_id"), "order_date", amount.alias("amount"), F.col("order_status").alias("channel"))
    for number in (1, 2, 3):
        some = rows.where(F.col("drop") == number).drop("drop", *(["channel"] if number == 1 else []))
        _deliver(spark, some.write.option("header", True), root, f"{root}/feed")
        streaming.ingest(streaming.bronze_stream(spark, f"{root}/feed"), store, f"{root}/bronze", f"{root}/checkpoint")
    rescued = T.StructField(streaming.RESCUED, T.StringType())
    out = schemas.read_evolved(spark, f"{root}/bronze", store, (rescued,))
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in store.at().fields)
    return out.withColumns({"order_id": F.col("order_id").cast("bigint"), "product_id": F.col("product_id").cast("bigint"),
                            "versions": F.lit(len(store.versions())), "types": F.lit(kinds.replace("order_id:bigint", "order_id:int"))})


@register("stream_governed")
def q_stream_governed(spark, sf_dir):
    """Two batches of one run; the guardian blocks the orders after the first."""
    schema, root, first, second = _write_drops(spark, sf_dir, bad_text=False)
    guardian, drift_control_root = f"{root}/guardian", f"{root}/drift"
    g, d = scenario_controls(spark)
    sinks.write_version(g, guardian)
    sinks.write_version(d, drift_control_root)
    files = _deliver(spark, first.write.option("header", True), root, f"{root}/feed")
    _deliver(spark, second.repartition(files).write.option("header", True), root, f"{root}/feed")

    def block(number: int) -> None:
        if number == 0:
            sinks.write_version(scenario_controls(spark, _BLOCK)[0], guardian)

    streaming.stream_governed(streaming.bronze_stream(spark, f"{root}/feed", files), schema, "bronze_orders", guardian, drift_control_root,
                              f"{root}/routed", f"{root}/checkpoint", after=block)
    return report(spark.read.parquet(f"{root}/routed").drop("control_version", "batch"))


@register("inferred_schema")
def q_inferred_schema(spark, sf_dir):
    """The schema found in a written CSV drop of each feed, with the rows it was found in."""
    out = []
    for t, df in entities(spark, sf_dir).items():
        drop = scratch_dir(spark, "drop")
        df.write.option("header", True).csv(drop)
        found = streaming.infer_feed_schema(spark, drop)
        types = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type")) for f in found.fields])
        rows = spark.read.schema(found).option("header", True).csv(drop).agg(F.count(F.lit(1)).alias("rows"))
        out.append(rows.select(F.lit(t).alias("table_name"), "rows", F.explode(types).alias("f")).select("table_name", "f.column_name", "f.type", "rows"))
    return snapshots.union_all(out)


# ---------------------------------------------------------------- datasets
@register("dataset_registry")
def q_dataset_registry(spark, sf_dir):
    """The registered feeds with their rows and the distinct values of their key."""
    e = entities(spark, sf_dir)
    return snapshots.union_all([
        e[f.name].agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(f.primary_key).alias("keys")).select(
            F.lit(f.bronze).alias("dataset"), F.lit(f.kind).alias("kind"), F.lit(f.primary_key).alias("primary_key"), "rows", "keys")
        for f in DATASETS
    ])


@register("sql_views")
def q_sql_views(spark, sf_dir):
    """A SQL user's question over the feeds as temp views."""
    tables.register_views(spark, entities(spark, sf_dir), "feed_")
    return spark.sql("""
        SELECT o.order_status, p.payment_status, count(*) AS payments, CAST(sum(p.amount) AS DOUBLE) AS amount
        FROM feed_orders o JOIN feed_payments p ON o.order_id = p.order_id GROUP BY o.order_status, p.payment_status""")


# ---------------------------------------------------------------- step 11: governance
from govlake.operators import governance  # noqa: E402
from govlake.plans import pipeline  # noqa: E402


def _scenario_quarantine(spark, sf_dir):
    g, d = scenario_controls(spark)
    decisions = control.read_decisions(g, d, list(ENTITY_OF))
    return {t: gate.to_quarantine(bronze(spark, sf_dir, b), decisions[b]) for b, t in ENTITY_OF.items()}


@register("quarantine_summary")
def q_quarantine_summary(spark, sf_dir):
    return governance.quarantine_summary(pipeline.quarantine_union(_scenario_quarantine(spark, sf_dir)))


@register("drift_alerts_weekly")
def q_drift_alerts_weekly(spark, sf_dir):
    issues = drift.drift_issues(drift_pairs_of(spark, sf_dir))
    dec = drift.drift_decision(issues, _table_list(spark))
    return governance.drift_alerts_weekly(drift.drift_audit(issues, dec, scenarios.T2))


@register("top_failed_rules")
def q_top_failed_rules(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    marked = snapshots.union_all([
        policy.failed_rules(s[t], t, FULL_POLICY["row_rules"]).select(F.lit(t).alias("table_name"), "failed_rules")
        for t in snapshots.TABLE_ORDER
    ])
    return governance.top_failed_rules(marked, k=10)


@register("churn_rate")
def q_churn_rate(spark, sf_dir):
    return governance.churn(entities(spark, sf_dir)["orders"], days=90)


@register("kpi_anomaly_score")
def q_kpi_anomaly_score(spark, sf_dir):
    daily = signals.daily_metrics_onepass(base_kpi_all(spark, sf_dir))
    return report(governance.kpi_anomaly_score(daily, "net_revenue", window=28))


@register("freshness_sla")
def q_freshness_sla(spark, sf_dir):
    """Hours since the newest row of the stored feeds that carry a data time."""
    e = entities(spark, sf_dir)
    stamped = {
        "orders": e["orders"].select(F.col("order_date").alias("processed_at")),
        "completed_orders": e["orders"].where("order_status = 'COMPLETED'").select(F.col("order_date").alias("processed_at")),
        "events": tables.load(spark, sf_dir, "events").select(F.col("ts").alias("processed_at")),
    }
    return governance.freshness_sla(stamped, scenarios.FRESHNESS_CHECK, limit_hours=24.0)


# ---------------------------------------------------------------- step 12: end to end
def law_table(spark):
    """Law documents as stored: an inactive draft, an older law and the one in force."""
    rows = [
        (json.dumps(dict(FULL_POLICY, row_rules=[])), True, scenarios.T1),
        (json.dumps(FULL_POLICY), True, scenarios.T2),
        (json.dumps({"strategy": "ALLOW", "row_rules": [], "metric_rules": []}), False, DEFAULT_AS_OF),
    ]
    return spark.createDataFrame(rows, "policy_json string, is_active boolean, created_at timestamp")


def _pipeline_root(spark, sf_dir):
    """Two runs: over the feeds of two months earlier, when two thirds of the
    refunds had not arrived, and over all of them now. The earlier run is
    stored once per data folder; this one starts from what it left."""
    e = entities(spark, sf_dir)
    day = "2001-06-01"
    before = stored_path(spark, "pipeline-t1", sf_dir, day, "logs")
    if not path_exists(spark, f"{before}/done/_SUCCESS"):
        early = snapshots.as_of(e, day)
        early["refunds"] = early["refunds"].where("refund_id % 3 = 0")
        pipeline.run(early, law_table(spark), before, scenarios.T1, scenarios.PIPELINE_NAME)
        _table_list(spark).write.mode("overwrite").parquet(f"{before}/done")
    root = scratch_dir(spark, "pipeline")
    pipeline.carry_over(spark, before, root)
    return root, pipeline.run(e, law_table(spark), root, DEFAULT_AS_OF, scenarios.PIPELINE_NAME)


def _pipeline_runs(spark, sf_dir):
    return _pipeline_root(spark, sf_dir)[1]


@register("pipeline_governance")
def q_pipeline_governance(spark, sf_dir):
    """O1-O3 asked of what the two runs left in their logs: quarantined rows per
    day, table and reason; drift alerts per week; rows per broken rule; and the
    audit and event rows per run."""
    root, _ = _pipeline_root(spark, sf_dir)
    log = lambda name: pipeline.read_log(spark, root, name)
    row = lambda question, day, about, what, n: [F.lit(question).alias("question"), F.col(day).cast("date").alias("day"), about.alias("about"), what.alias("what"), n.alias("n")]
    quarantined = log("quarantine").groupBy("quarantine_day", "table_name", "quarantine_reason").agg(F.sum("records").alias("n"))
    alerts = governance.drift_alerts_weekly(log("drift_audit"))
    rules = log("failed_rules").groupBy("table_name", "rule_name").agg(F.sum("failed_rows").alias("n")).withColumn("day", F.lit(None).cast("date"))
    audits = log("guardian_audit").groupBy(F.to_date("event_time").alias("day"), "table_name").agg(F.count(F.lit(1)).alias("n"))
    events = log("guardian_events").groupBy(F.to_date("event_time").alias("day"), "table_name").agg(F.count(F.lit(1)).alias("n"))
    return snapshots.union_all([
        quarantined.select(*row("O1", "quarantine_day", F.col("table_name"), F.col("quarantine_reason"), F.col("n"))),
        alerts.select(*row("O2", "week_start", F.col("issue_type"), F.col("severity"), F.col("alerts"))),
        rules.select(*row("O3", "day", F.col("table_name"), F.col("rule_name"), F.col("n"))),
        audits.select(*row("audit", "day", F.col("table_name"), F.lit("rows"), F.col("n"))),
        events.select(*row("events", "day", F.col("table_name"), F.lit("rows"), F.col("n"))),
    ])


@register("pipeline_datasets")
def q_pipeline_datasets(spark, sf_dir):
    """Rows of every dataset that the second run left."""
    out = _pipeline_runs(spark, sf_dir)
    sets = {f"silver_{t}": d for t, d in out.silver.items()} | {f"quarantine_{t}": d for t, d in out.quarantine.items()}
    sets |= {f"gold_quarantine_{t}": d for t, d in out.gold_quarantine.items()} | {f"kpi_{k}": d for k, d in out.kpis.items()}
    sets |= {"fact_orders": out.fact, "insights": out.insights}
    return snapshots.union_all([d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, d in sets.items()])


@register("pipeline_kpi_daily")
def q_pipeline_kpi_daily(spark, sf_dir):
    return report(_pipeline_runs(spark, sf_dir).insights)


@register("pipeline_controls")
def q_pipeline_controls(spark, sf_dir):
    """What the second run left: a control row per table and the rows on each side of its gate."""
    out = _pipeline_runs(spark, sf_dir)
    rows = snapshots.union_all([
        part[t].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(BRONZE_NAMES[t]).alias("table_name"), F.lit(side).alias("side"), "rows")
        for side, part in (("silver", out.silver), ("quarantine", out.quarantine)) for t in snapshots.TABLE_ORDER
    ])
    listed = out.policy_control.select("pipeline_name", F.explode("table_name_list").alias("table_name"))
    d = out.drift_control.select("table_name", F.col("severity").alias("drift_severity"), F.col("allow_processing").alias("drift_allows"))
    g = out.guardian_control.select("table_name", F.col("severity").alias("guardian_severity"))
    return rows.join(d, "table_name").join(g, "table_name").join(listed, "table_name")


# ---------------------------------------------------------------- audit logs
@register("guardian_audit")
def q_guardian_audit(spark, sf_dir):
    issues, decision = quality.guardian_run(entities(spark, sf_dir))
    return quality.guardian_audit(issues, decision, scenarios.T2, BRONZE_NAMES)


@register("guardian_events")
def q_guardian_events(spark, sf_dir):
    issues, decision = quality.guardian_run(entities(spark, sf_dir))
    audit = quality.guardian_audit(issues, decision, scenarios.T2, BRONZE_NAMES)
    return quality.guardian_events(audit, decision, scenarios.PIPELINE_NAME, BRONZE_NAMES)


@register("drift_audit")
def q_drift_audit(spark, sf_dir):
    issues = drift.drift_issues(drift_pairs_of(spark, sf_dir))
    dec = drift.drift_decision(issues, _table_list(spark))
    return drift.drift_audit(issues, dec, scenarios.T2)


@register("drift_control")
def q_drift_control(spark, sf_dir):
    issues = drift.drift_issues(drift_pairs_of(spark, sf_dir))
    dec = drift.drift_decision(issues, _table_list(spark))
    ctrl = drift.drift_control(issues, dec, scenarios.T2, BRONZE_NAMES)
    parsed = control.parse_drift(ctrl).withColumn("drift", F.explode_outer("drifts")).select(
        "table_name", "overall_severity", "updated_at", "drift.issue_type", "drift.column", F.col("drift.severity").alias("drift_severity"),
        "drift.recommended_action")
    return parsed.join(ctrl.select("table_name", "allow_processing", "severity"), "table_name")


# ---------------------------------------------------------------- datasets that follow their drops
from govlake.operators.periods import BATCH, BY_MONTH, PERIOD, PeriodStore  # noqa: E402
from govlake.sources.buckets import BucketedTable  # noqa: E402


@register("kpi_daily_incremental")
def q_kpi_daily_incremental(spark, sf_dir):
    """Orders up to 1997, later ones, then late refunds of 1996: after three drops the daily
    KPIs are those of a full run, and each month tells the drop that computed it last."""
    e = entities(spark, sf_dir)
    early = e["orders"].where(F.year("order_date") <= 1997)
    dates = e["orders"].groupBy("order_id").agg(F.min(F.year("order_date")).alias("year"), F.first("order_date").alias("order_date"))
    late = (F.col("year") == 1996) & (F.month("order_date") == 6) & (F.col("refund_id") % 10 == 3)
    # stored, as each drop reads them several times
    payments = cut_lineage(e["payments"].join(dates.drop("order_date"), "order_id", "left"), "dated-payments")
    refunds = e["refunds"].join(dates, "order_id", "left").withColumn("drop", F.when(late, 2).when(F.col("year") <= 1997, 0).otherwise(1))
    refunds = cut_lineage(refunds, "dated-refunds")
    store = PeriodStore(spark, scratch_dir(spark, "periods"), {n: df.schema for n, df in e.items()}, BASE_POLICY["row_rules"], BY_MONTH)
    some = lambda n: refunds.where(F.col("drop") == n)
    store.add(0, {"orders": early, "customers": e["customers"], "payments": payments.where("year <= 1997"), "refunds": some(0)})
    store.add(1, {"orders": e["orders"].where(F.year("order_date") > 1997), "payments": payments.where("year > 1997"), "refunds": some(1)})
    store.add(2, {"refunds": some(2)})
    last = store.changes().groupBy(PERIOD).agg(F.max(BATCH).alias("computed_in"))
    kpi = store.dataset("kpi").withColumn(PERIOD, store.period_of("order_date"))
    return report(kpi.join(last, PERIOD).drop(PERIOD))


@register("kpi_payment_method_incremental")
def q_kpi_payment_method_incremental(spark, sf_dir):
    """E15 added up over periods after a drop of orders and a later one of payments and refunds."""
    e = entities(spark, sf_dir)
    store = PeriodStore(spark, scratch_dir(spark, "periods"), {n: df.schema for n, df in e.items()}, BASE_POLICY["row_rules"], BY_MONTH)
    late = F.col("order_id") % 50 == 7
    store.add(0, {"orders": e["orders"], "customers": e["customers"], "payments": e["payments"].where(~late), "refunds": e["refunds"].where(~late)})
    store.add(1, {"payments": e["payments"].where(late), "refunds": e["refunds"].where(late)})
    return report(store.method_performance())


@register("bucket_upsert")
def q_bucket_upsert(spark, sf_dir):
    """Orders up to 1997, upserted by those from 1997 on with their status set; every third
    update is older than the row it meets. Buckets follow the month, so 1996 and before stay."""
    orders = entities(spark, sf_dir)["orders"].select(
        F.date_format("order_date", "yyyy-MM").alias("order_month"), "order_id", "order_status", "amount", F.col("order_date").cast("timestamp").alias("updated_at"))
    base = orders.where("order_month < '1998'")
    older = F.when(F.col("order_id") % 3 == 0, F.expr("updated_at - INTERVAL 1 DAY")).otherwise(F.col("updated_at"))
    updates = orders.where("order_month >= '1997'").withColumns({"order_status": F.lit("SHIPPED"), "updated_at": older})
    table = BucketedTable.create(base, scratch_dir(spark, "buckets"), ["order_month", "order_id"], "updated_at", 64, cluster="order_month")
    return report(table.upsert(updates).read())
