"""Policy: laws, metrics, row rules and the policy decision.

A policy decision is a JSON document ``{strategy, row_rules, metric_rules}``
where each rule is a string map. Row rules are SQL conditions per table;
metric rules compare a table metric with a threshold. A metric is an aggregate
expression: those of ``POLICY_METRICS``, or the rule's own ``metric_expression``
over any table. All metrics and row rules of a table are one aggregate.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.config import DEFAULT_METRICS, POLICY_METRICS
from govlake.functions.rules import (
    and_all, condition_column, normalize_expression, reject, validate_expressions, validate_metrics,
)
from govlake.session import checkpoint_dir

RULE_MAP = T.MapType(T.StringType(), T.StringType())
POLICY_SCHEMA = T.StructType(
    [
        T.StructField("strategy", T.StringType()),
        T.StructField("row_rules", T.ArrayType(RULE_MAP)),
        T.StructField("metric_rules", T.ArrayType(RULE_MAP)),
    ]
)

ROW_RULE_KEYS = ("table", "rule_name", "expression", "severity", "on_fail")
METRIC_RULE_KEYS = ("table", "metric", "threshold_pct", "severity", "on_fail")  # metric_expression may be there too


# --------------------------------------------------------------------------- G1
def active_laws(laws: DataFrame) -> DataFrame:
    """Latest active law document: ``policy_json`` of the newest active row."""
    return laws.filter(F.col("is_active")).agg(
        F.max_by("policy_json", "created_at").alias("policy_json"),
        F.max("created_at").alias("created_at"),
    )


def latest_policy(control: DataFrame, pipeline_name: str) -> DataFrame:
    """Newest policy decision row of one pipeline (J4/J6 as ``max_by``)."""
    return control.filter(F.col("pipeline_name") == F.lit(pipeline_name)).agg(
        F.max_by("policy_decision_json", "updated_timestamp").alias("policy_decision_json"),
        F.max("updated_timestamp").alias("updated_timestamp"),
    )


# --------------------------------------------------------------------------- G2
def parse_policy(df: DataFrame, column: str = "policy_decision_json") -> DataFrame:
    """Parse the decision JSON into a ``policy`` struct column."""
    return df.select(F.from_json(F.col(column), POLICY_SCHEMA).alias("policy"))


def policy_rules(df: DataFrame, column: str = "policy_decision_json") -> DataFrame:
    """One row per row rule: table, rule_name, expression, severity, on_fail."""
    parsed = parse_policy(df, column)
    rule = F.explode_outer(F.col("policy.row_rules")).alias("rule")
    return (
        parsed.select(rule)
        .filter(F.col("rule").isNotNull())
        .select(*[F.element_at("rule", F.lit(k)).alias(k) for k in ROW_RULE_KEYS])
    )


def metric_rules(df: DataFrame, column: str = "policy_decision_json") -> DataFrame:
    """One row per metric rule: table, metric, threshold_pct (double), severity, on_fail."""
    parsed = parse_policy(df, column)
    rule = F.explode_outer(F.col("policy.metric_rules")).alias("rule")
    return (
        parsed.select(rule)
        .filter(F.col("rule").isNotNull())
        .select(
            F.element_at("rule", F.lit("table")).alias("table"),
            F.element_at("rule", F.lit("metric")).alias("metric"),
            F.element_at("rule", F.lit("threshold_pct")).try_cast("double").alias("threshold_pct"),
            F.element_at("rule", F.lit("severity")).alias("severity"),
            F.element_at("rule", F.lit("on_fail")).alias("on_fail"),
        )
    )


def read_policy(control_row: DataFrame, column: str = "policy_decision_json") -> dict:
    """Bring the one decision row to the driver as plain lists of dicts.

    The decision is one row by construction (``latest_policy``); a missing or
    malformed decision yields empty rule lists (S5).
    """
    row = parse_policy(control_row, column).first()
    policy = row["policy"] if row is not None else None
    if policy is None:
        return {"strategy": None, "row_rules": [], "metric_rules": []}
    return {
        "strategy": policy["strategy"],
        "row_rules": [dict(r) for r in (policy["row_rules"] or []) if r is not None],
        "metric_rules": [dict(r) for r in (policy["metric_rules"] or []) if r is not None],
    }


# --------------------------------------------------------------------------- G3
def row_condition(rules: Sequence[dict], table: str) -> str:
    """The AND of a table's row rules, normalised (S7) and parenthesised."""
    return and_all(normalize_expression(r.get("expression") or "") for r in rules if r.get("table") == table)


# --------------------------------------------------------------------------- G4
def apply_row_rules(
    df: DataFrame, table: str, rules: Sequence[dict], null_policy: str = "parity"
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (valid, quarantine) by the table's row rules.

    No rules: all rows valid, empty quarantine with the same schema (B12).
    """
    text = row_condition(rules, table)
    if not text:
        return df, df.limit(0)
    validate_expressions(df, [text])
    cond = condition_column(text)
    return df.filter(cond), df.filter(reject(cond, null_policy))


def gold_quarantine(df: DataFrame, table: str, rules: Sequence[dict], null_policy: str = "parity") -> DataFrame:
    """Rows of one silver table that break its policy rules (H2)."""
    return apply_row_rules(df, table, rules, null_policy)[1]


# --------------------------------------------------------------------------- G5
def failed_rules(df: DataFrame, table: str, rules: Sequence[dict], column: str = "failed_rules") -> DataFrame:
    """Add an array of the names of the table's rules each row breaks.

    A rule whose condition is NULL counts as broken (``coalesce(.., false)``),
    otherwise a NULL predicate would report nothing.
    """
    applicable = [r for r in rules if r.get("table") == table and (r.get("expression") or "").strip()]
    validate_expressions(df, [normalize_expression(r["expression"]) for r in applicable])
    flags = [
        F.when(~F.coalesce(F.expr(f"({normalize_expression(r['expression'])})"), F.lit(False)), F.lit(r.get("rule_name")))
        for r in applicable
    ]
    arr = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return df.withColumn(column, arr)


# --------------------------------------------------------------------------- E10
def table_metrics(table: str, metric_rules: Sequence[dict] = ()) -> dict[str, str]:
    """Name -> aggregate expression of a table's metrics: the fixed ones, then those
    that rules bring along (of the same name, a rule's goes before the fixed one).

    Two rules that define one metric differently are refused, and so is a rule
    on a metric that nothing defines: it could never fire.
    """
    rules = [r for r in metric_rules if r.get("table") == table]
    brought: dict[str, str] = {}
    for r in rules:
        text = (r.get("metric_expression") or "").strip()
        if text and brought.setdefault(r["metric"], text) != text:
            raise ValueError(f"metric {r['metric']!r} of {table!r} is defined twice: {brought[r['metric']]!r}, {text!r}")
    metrics = POLICY_METRICS.get(table, DEFAULT_METRICS) | brought
    for r in rules:
        if r.get("metric") not in metrics:
            raise ValueError(f"rule on {table!r} needs a metric_expression for {r.get('metric')!r}")
    return metrics


def _applicable(rules: Sequence[dict], table: str) -> list[dict]:
    return [r for r in rules if r.get("table") == table and (r.get("expression") or "").strip()]


def policy_aggregates(
    tables: dict[str, DataFrame], row_rules: Sequence[dict] = (), metric_rules: Sequence[dict] = ()
) -> DataFrame:
    """All policy figures of the silver tables in one long frame:
    (table, kind, name, expression, value), kind ``metric`` or ``rule``.

    One global aggregate per table computes the metrics and the failing-row
    count of each row rule; one ``inline`` emits both, so one scan per
    table yields every figure (``policy_decision`` checkpoints this small
    frame before splitting it). A row whose rule condition is NULL fails it.
    A metric that a rule defines carries its ``expression``.
    """
    frames = []
    own = {(r.get("table"), r.get("metric")) for r in metric_rules if (r.get("metric_expression") or "").strip()}
    for table, df in tables.items():
        rules = _applicable(row_rules, table)
        validate_expressions(df, [normalize_expression(r["expression"]) for r in rules])
        metrics = table_metrics(table, metric_rules)
        validate_metrics(df, metrics.values())
        aggs = [F.expr(text).cast("double").alias(f"m{i}") for i, text in enumerate(metrics.values())]
        aggs += [
            F.sum(
                F.when(~F.coalesce(F.expr(f"({normalize_expression(r['expression'])})"), F.lit(False)), 1).otherwise(0)
            ).cast("bigint").alias(f"r{i}")
            for i, r in enumerate(rules)
        ]
        figure = lambda kind, name, text, value: F.struct(
            F.lit(kind).alias("kind"), F.lit(name).cast("string").alias("name"), F.lit(text).cast("string").alias("expression"),
            F.col(value).cast("double").alias("value"))
        parts = [figure("metric", n, text if (table, n) in own else None, f"m{i}") for i, (n, text) in enumerate(metrics.items())]
        parts += [figure("rule", r.get("rule_name"), r["expression"], f"r{i}") for i, r in enumerate(rules)]
        frames.append(df.agg(*aggs).select(F.lit(table).alias("table"), F.inline(F.array(*parts))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _metrics_long(figures: DataFrame, with_expression: bool = False) -> DataFrame:
    return figures.filter(F.col("kind") == "metric").select(
        F.col("table").alias("table_name"), F.col("name").alias("metric_name"), F.col("value").alias("metric_value"),
        *(["expression"] if with_expression else []))


def policy_metrics(customers: DataFrame, orders: DataFrame, payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """The policy agent's silver metrics in long format:
    (table_name, metric_name, metric_value double).

    One aggregate per table (partial aggregation, a single small exchange).
    """
    return _metrics_long(policy_aggregates(
        {"customers": customers, "orders": orders, "payments": payments, "refunds": refunds}))


# --------------------------------------------------------------------------- G6
def metric_violations(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric rules whose metric value is over the threshold.

    ``rules``: table, metric, threshold_pct, severity, on_fail. Both sides
    are bounded by the number of tables x metrics, so the join is small.
    """
    m = metrics.select(
        F.col("table_name").alias("table"), F.col("metric_name").alias("metric"), *[c for c in metrics.columns if c not in ("table_name", "metric_name")]
    )
    return (
        rules.join(m, ["table", "metric"], "inner")
        .filter(F.col("metric_value") > F.col("threshold_pct"))
        .select("table", "metric", "threshold_pct", "metric_value", "severity", "on_fail", *[c for c in ("expression",) if c in metrics.columns])
    )


# --------------------------------------------------------------------------- G7
def row_rule_failures(tables: dict[str, DataFrame], rules: Sequence[dict],
                      aggregates: DataFrame | None = None) -> DataFrame:
    """Count failing rows per row rule: (table, rule_name, expression, failing_rows).

    One pass per table with one conditional count per rule; a rule whose
    condition is NULL for a row counts that row as failing (as G5). Without
    rules for the tables there are no rows (S5).
    """
    figures = aggregates if aggregates is not None else policy_aggregates(tables, rules)
    return figures.filter(F.col("kind") == "rule").select(
        "table", F.col("name").alias("rule_name"), "expression", F.col("value").cast("bigint").alias("failing_rows"))


def policy_decision(tables: dict[str, DataFrame], laws: dict) -> DataFrame:
    """Laws + data -> the rules that are violated, one row per rule.

    Row laws are kept when at least one row breaks them, metric laws when
    the metric is over its threshold. Columns: kind, table, name, expression,
    threshold_pct, observed, severity, on_fail. Metrics and rule failures
    come from one aggregate per table.
    """
    spark = next(iter(tables.values())).sparkSession
    row_laws = laws.get("row_rules") or []
    metric_laws = laws.get("metric_rules") or []
    # The figures are a few rows per table (bounded by the rule set): cut
    # them once so the metric and rule branches below do not each rescan
    # the silver tables (exchange reuse across union branches is not
    # guaranteed under AQE).
    checkpoint_dir(spark)
    aggregates = policy_aggregates(tables, row_laws, metric_laws).coalesce(1).checkpoint(eager=True)
    metrics = _metrics_long(aggregates, with_expression=True)
    law_rows = spark.createDataFrame(
        [(r.get("table"), r.get("rule_name"), r.get("severity"), r.get("on_fail")) for r in row_laws],
        "table string, rule_name string, severity string, on_fail string",
    )
    failures = row_rule_failures(tables, row_laws, aggregates)
    rows = (
        failures.join(F.broadcast(law_rows), ["table", "rule_name"], "left")
        .filter(F.col("failing_rows") > 0)
        .select(
            F.lit("row").alias("kind"),
            "table",
            F.col("rule_name").alias("name"),
            "expression",
            F.lit(None).cast("double").alias("threshold_pct"),
            F.col("failing_rows").cast("double").alias("observed"),
            "severity",
            "on_fail",
        )
    )
    mrules = spark.createDataFrame(
        [
            (r.get("table"), r.get("metric"), float(r["threshold_pct"]) if r.get("threshold_pct") is not None else None,
             r.get("severity"), r.get("on_fail"))
            for r in metric_laws
        ],
        "table string, metric string, threshold_pct double, severity string, on_fail string",
    )
    mv = metric_violations(metrics, F.broadcast(mrules)).select(
        F.lit("metric").alias("kind"),
        "table",
        F.col("metric").alias("name"),
        "expression",
        "threshold_pct",
        F.col("metric_value").alias("observed"),
        "severity",
        "on_fail",
    )
    return rows.unionByName(mv)


def policy_decision_json(decision: DataFrame) -> DataFrame:
    """Fold the violated rules into the decision document (one row).

    The rule list is bounded by the number of laws, so one group is safe.
    Rules are sorted by (table, name) so the document is reproducible.
    """
    fields = F.struct("table", "name", "expression", "threshold_pct", "severity", "on_fail")
    agg = decision.agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "row", fields))).alias("rr"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "metric", fields))).alias("mr"),
    )

    def row_rule(x):
        return F.create_map(
            F.lit("table"), x["table"], F.lit("rule_name"), x["name"], F.lit("expression"), x["expression"],
            F.lit("severity"), x["severity"], F.lit("on_fail"), x["on_fail"],
        )

    def metric_rule(x):
        threshold = F.regexp_replace(x["threshold_pct"].cast("string"), r"\.0$", "")
        rule = F.create_map(
            F.lit("table"), x["table"], F.lit("metric"), x["name"], F.lit("metric_expression"), x["expression"],
            F.lit("threshold_pct"), threshold, F.lit("severity"), x["severity"], F.lit("on_fail"), x["on_fail"],
        )
        return F.map_filter(rule, lambda k, v: (k != "metric_expression") | v.isNotNull())

    doc = F.struct(
        F.when(F.size("rr") + F.size("mr") > 0, F.lit("ENFORCE")).otherwise(F.lit("ALLOW")).alias("strategy"),
        F.transform("rr", row_rule).alias("row_rules"),
        F.transform("mr", metric_rule).alias("metric_rules"),
    )
    return agg.select(F.to_json(doc).alias("policy_decision_json"))


def policy_control(document: DataFrame, pipeline_name: str, table_names: Sequence[str], updated_at) -> DataFrame:
    """The policy control row: pipeline, its tables, the decision document and
    the time of the decision."""
    return document.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.array(*[F.lit(t) for t in table_names]).alias("table_name_list"),
        "policy_decision_json",
        F.lit(updated_at).cast("timestamp").alias("updated_timestamp"),
    )
