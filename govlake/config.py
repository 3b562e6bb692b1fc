"""Fixed values and the dataset registry.

Everything here is configuration: the names of the feeds, their primary keys,
and the category sets and thresholds the drift and signal rules use.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same decisions.
# ---------------------------------------------------------------------------
# Drift rules: success-like and failure-like category values.
POSITIVE_CATEGORIES = ("SUCCESS", "COMPLETED", "APPROVED", "ACTIVE")
NEGATIVE_CATEGORIES = ("FAILED", "PENDING", "UNKNOWN", "CANCELLED", "REJECTED")

# Drift rules: primary key per table (cardinality drift is checked on these only).
PRIMARY_KEYS = {
    "orders": "order_id",
    "payments": "payment_id",
    "refunds": "refund_id",
    "customers": "customer_id",
}

# Drift rules: columns whose averages are compared (numeric drift).
NUMERIC_DRIFT_COLUMNS = {
    "orders": ("amount", "discount_amount"),
    "payments": ("amount",),
    "refunds": ("refund_amount",),
    "customers": ("age",),
}

# Drift rules: status-like columns whose value shares are compared.
CATEGORY_DRIFT_COLUMNS = {
    "orders": ("order_status", "payment_status"),
    "payments": ("payment_status",),
    "refunds": ("refund_status",),
    "customers": ("city",),
}

# Drift thresholds, percent (volume and numeric are relative change,
# null is a change in percentage points).
VOLUME_HIGH, VOLUME_MEDIUM = 50.0, 25.0
NULL_HIGH, NULL_MEDIUM = 40.0, 20.0
CARD_FALL_HIGH, CARD_FALL_MEDIUM = 30.0, 15.0
AVG_FALL_HIGH, AVG_FALL_MEDIUM, AVG_RISE_MEDIUM = 70.0, 40.0, 90.0
POS_FALL_HIGH, NEG_RISE_HIGH = 30.0, 50.0

# Policy: metrics every silver table of that name has, as aggregate expressions.
POLICY_METRICS = {
    "customers": {"total_rows": "count(1)", "invalid_age_count": "sum(CASE WHEN age < 0 OR age > 120 THEN 1 ELSE 0 END)"},
    "orders": {
        "total_rows": "count(1)",
        "invalid_amount": "sum(CASE WHEN amount <= 0 THEN 1 ELSE 0 END)",
        "invalid_discount": "sum(CASE WHEN discount_amount > amount THEN 1 ELSE 0 END)",
    },
    "payments": {
        "total_rows": "count(1)",
        "failure_rate": "try_divide(sum(CASE WHEN payment_status IN ('FAILED', 'PENDING') THEN 1 ELSE 0 END) * 100.0D, count(1))",
    },
    "refunds": {"total_rows": "count(1)", "invalid_refunds": "sum(CASE WHEN refund_amount <= 0 THEN 1 ELSE 0 END)"},
}
# Of a table that is not listed.
DEFAULT_METRICS = {"total_rows": "count(1)"}

# Business signal bands.
PAYMENT_HEALTHY, PAYMENT_WARNING = 97, 95
REFUND_LOW, REFUND_MEDIUM = 3, 8
DISCOUNT_EFFICIENT, DISCOUNT_MODERATE = 10, 20

# Quarantine reasons.
GUARDIAN_BLOCK = "GUARDIAN_BLOCK"
DRIFT_HIGH_SEVERITY = "DRIFT_HIGH_SEVERITY"
GUARDIAN_FILTER_FAILED = "GUARDIAN_FILTER_FAILED"

# Recommended actions.
BLOCK_SILVER = "BLOCK_SILVER"
FLAG_AND_ALERT = "FLAG_AND_ALERT"
INVESTIGATE_SOURCE = "INVESTIGATE_SOURCE"
ALLOW = "ALLOW"

# Default number of recent insight rows given as chat context.
RECENT_INSIGHTS_K = 14

# The fixed "as of" stamp used by registered queries, so results do not
# depend on the wall clock (processed_at, quarantined_at, generated_at).
DEFAULT_AS_OF = _dt.datetime(2024, 1, 3, 0, 0, 0)


@dataclass(frozen=True)
class Feed:
    """One entry of the dataset registry."""

    name: str  # entity name, e.g. "orders"
    bronze: str  # bronze dataset name, e.g. "bronze_orders"
    kind: str  # TRANSACTIONAL or DIMENSION
    primary_key: str
    numeric: tuple = field(default_factory=tuple)
    category: tuple = field(default_factory=tuple)


DATASETS = [
    Feed("orders", "bronze_orders", "TRANSACTIONAL", "order_id",
         NUMERIC_DRIFT_COLUMNS["orders"], CATEGORY_DRIFT_COLUMNS["orders"]),
    Feed("customers", "bronze_customers", "DIMENSION", "customer_id",
         NUMERIC_DRIFT_COLUMNS["customers"], CATEGORY_DRIFT_COLUMNS["customers"]),
    Feed("payments", "bronze_payments", "TRANSACTIONAL", "payment_id",
         NUMERIC_DRIFT_COLUMNS["payments"], CATEGORY_DRIFT_COLUMNS["payments"]),
    Feed("refunds", "bronze_refunds", "TRANSACTIONAL", "refund_id",
         NUMERIC_DRIFT_COLUMNS["refunds"], CATEGORY_DRIFT_COLUMNS["refunds"]),
]

FEEDS_BY_NAME = {f.name: f for f in DATASETS}
