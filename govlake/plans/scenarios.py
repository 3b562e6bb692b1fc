"""Decision scenarios: the configuration rows the registered queries run with.

These are decisions (one row per table), not data: each query applies them to
the full entity tables. They mirror the scenario table of FIXTURES.md.
"""

from __future__ import annotations

import datetime as _dt
import json

from govlake.operators.control import DRIFT_CONTROL_SCHEMA, GUARDIAN_CONTROL_SCHEMA  # noqa: F401

# Policy row rules that keep positive order amounts and positive refunds.
BASE_POLICY = {
    "strategy": "ENFORCE",
    "row_rules": [
        {"table": "orders", "rule_name": "positive_amount", "expression": "amount > 0",
         "severity": "HIGH", "on_fail": "QUARANTINE"},
        {"table": "refunds", "rule_name": "positive_refund", "expression": "refund_amount > 0",
         "severity": "MEDIUM", "on_fail": "QUARANTINE"},
    ],
    "metric_rules": [],
}

# The full law set: the rule text is kept as written, including the unquoted
# SUCCESS (S7) and an OR rule that needs parentheses.
FULL_POLICY = {
    "strategy": "ENFORCE",
    "row_rules": [
        {"table": "orders", "rule_name": "positive_amount", "expression": "amount > 0",
         "severity": "HIGH", "on_fail": "QUARANTINE"},
        {"table": "orders", "rule_name": "discount_within_limit", "expression": "discount_amount <= amount * 0.06",
         "severity": "MEDIUM", "on_fail": "QUARANTINE"},
        {"table": "payments", "rule_name": "successful_payment", "expression": "payment_status = SUCCESS",
         "severity": "MEDIUM", "on_fail": "QUARANTINE"},
        {"table": "refunds", "rule_name": "refund_worth_paying", "expression": "refund_amount > 2000",
         "severity": "MEDIUM", "on_fail": "QUARANTINE"},
        {"table": "customers", "rule_name": "adult_or_unknown", "expression": "age >= 18 OR age IS NULL",
         "severity": "LOW", "on_fail": "QUARANTINE"},
    ],
    "metric_rules": [
        {"table": "payments", "metric": "failure_rate", "threshold_pct": "10",
         "severity": "HIGH", "on_fail": "ALERT"},
    ],
}

# Metric laws that bring their own expression, also over a table that is no feed.
METRIC_LAWS = {
    "strategy": "ENFORCE",
    "row_rules": FULL_POLICY["row_rules"],
    "metric_rules": [
        *FULL_POLICY["metric_rules"],
        {"table": "orders", "metric": "unpaid_pct", "threshold_pct": "5",
         "metric_expression": "100.0D * count_if(order_status <> 'COMPLETED') / count(1)", "severity": "HIGH", "on_fail": "ALERT"},
        {"table": "order_lines", "metric": "returned_pct", "threshold_pct": "20",
         "metric_expression": "100.0D * count_if(l_returnflag = 'R') / count(1)", "severity": "MEDIUM", "on_fail": "ALERT"},
        {"table": "order_lines", "metric": "largest_quantity", "threshold_pct": "40",
         "metric_expression": "max(l_quantity)", "severity": "LOW", "on_fail": "ALERT"},
        {"table": "order_lines", "metric": "days_covered", "threshold_pct": "1000000",
         "metric_expression": "datediff(max(l_shipdate), min(l_shipdate))", "severity": "LOW", "on_fail": "ALERT"},
    ],
}

PIPELINE_NAME = "governed_sales"
FRESHNESS_CHECK = _dt.datetime(2024, 1, 31, 12, 0, 0)
T1 = _dt.datetime(2024, 1, 1, 0, 0, 0)
T2 = _dt.datetime(2024, 1, 2, 0, 0, 0)

# Guardian decisions (fix_json payloads). Corrections are ordered pairs:
# ``amount`` is corrected after ``discount_amount``.
GUARDIAN_FIX = {
    "bronze_orders": {
        "strategy": "BOTH",
        "silver_filter_condition": "amount > 0 AND discount_amount <= amount",
        "correction_expression": {"discount_amount": "coalesce(discount_amount, 0)", "amount": "abs(amount)"},
    },
    "bronze_customers": {
        "strategy": "QUARANTINE",
        "silver_filter_condition": "age BETWEEN 0 AND 120",
        "correction_expression": {},
    },
    "bronze_payments": {
        "strategy": "CORRECT",
        "silver_filter_condition": "amount > 5000",
        "correction_expression": {"payment_status": "upper(trim(payment_status))"},
    },
    "bronze_refunds": {
        "strategy": "QUARANTINE",
        "silver_filter_condition": "refund_amount > 0",
        "correction_expression": {},
    },
}

# An older, losing decision per table (must never be picked).
GUARDIAN_OLD = {"strategy": "BLOCK", "silver_filter_condition": "1 = 0", "correction_expression": {}}

DRIFT_SEVERITY = {
    "bronze_orders": "LOW",
    "bronze_customers": "MEDIUM",
    "bronze_payments": "LOW",
    "bronze_refunds": "LOW",
}


def guardian_control_rows(overrides: dict | None = None) -> list[tuple]:
    """(table_name, allow_processing, severity, fix_json, updated_at), two per table."""
    fixes = dict(GUARDIAN_FIX)
    fixes.update(overrides or {})
    rows = []
    for table, fix in fixes.items():
        rows.append((table, False, "HIGH", json.dumps(GUARDIAN_OLD), T1))
        rows.append((table, fix["strategy"] != "BLOCK", "MEDIUM", json.dumps(fix), T2))
    return rows


def drift_control_rows(overrides: dict | None = None) -> list[tuple]:
    """(table_name, allow_processing, severity, agent_result_json, updated_at), two per table."""
    sev = dict(DRIFT_SEVERITY)
    sev.update(overrides or {})
    rows = []
    for table, s in sev.items():
        rows.append((table, False, "HIGH", json.dumps({"drifts": [], "overall_severity": "HIGH"}), T1))
        rows.append((table, s != "HIGH", s, json.dumps({"drifts": [], "overall_severity": s}), T2))
    return rows
