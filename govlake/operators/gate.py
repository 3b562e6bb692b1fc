"""Silver gate: corrections, filter, quarantine and one-pass routing.

The decision is read once, before the plan is built; the plan then holds only
column expressions, so silver and quarantine are narrow transformations of
bronze (no shuffle) and stream as well as they batch (C7).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake import config as C
from govlake.functions.rules import apply_corrections, condition_column, reject, validate_expressions
from govlake.operators.control import Decision

SILVER_EXTRA = ("guardian_strategy", "drift_severity", "processed_at")
QUARANTINE_EXTRA = ("quarantine_reason", "guardian_strategy", "drift_severity", "quarantined_at")


def _check(df: DataFrame, decision: Decision) -> None:
    validate_expressions(df, [decision.filter_condition or ""] + [e for _, e in decision.corrections])


def _corrected(df: DataFrame, decision: Decision) -> DataFrame:
    return apply_corrections(df, decision.corrections) if decision.corrects else df


# --------------------------------------------------------------------------- C4
def to_silver(df: DataFrame, decision: Decision, as_of: _dt.datetime = C.DEFAULT_AS_OF) -> DataFrame:
    """Silver rows: empty when the gate is closed; else corrected (CORRECT /
    BOTH), filtered by the guardian condition and stamped.

    A closed gate keeps the open gate's schema (the reference returned the
    bare bronze schema there), folded by Catalyst to an empty relation.
    """
    _check(df, decision)
    out = _corrected(df, decision).filter(condition_column(decision.filter_condition))
    out = out.select(
        "*",
        F.lit(decision.strategy).cast("string").alias("guardian_strategy"),
        F.lit(decision.drift_severity).cast("string").alias("drift_severity"),
        F.lit(as_of).cast("timestamp").alias("processed_at"),
    )
    return out if decision.open else out.limit(0)


# --------------------------------------------------------------------------- C5
def to_quarantine(
    df: DataFrame,
    decision: Decision,
    as_of: _dt.datetime = C.DEFAULT_AS_OF,
    null_policy: str = "parity",
    quarantine_on: str = "uncorrected",
) -> DataFrame:
    """Quarantined rows with reason, strategy, drift severity and stamp.

    GUARDIAN_BLOCK (all rows) wins over DRIFT_HIGH_SEVERITY (all rows), which
    wins over GUARDIAN_FILTER_FAILED (rows failing the condition). Parity
    tests the *uncorrected* rows (S2) with ``NOT cond`` (S1);
    ``quarantine_on="corrected"`` and ``null_policy="quarantine"`` make
    silver and quarantine an exact split of bronze.
    """
    _check(df, decision)

    def stamp(frame: DataFrame, reason: str, strategy, severity) -> DataFrame:
        return frame.select(
            "*",
            F.lit(reason).alias("quarantine_reason"),
            F.lit(strategy).cast("string").alias("guardian_strategy"),
            F.lit(severity).cast("string").alias("drift_severity"),
            F.lit(as_of).cast("timestamp").alias("quarantined_at"),
        )

    if decision.strategy == "BLOCK":
        return stamp(df, C.GUARDIAN_BLOCK, "BLOCK", decision.drift_severity)
    if decision.drift_severity == "HIGH":
        return stamp(df, C.DRIFT_HIGH_SEVERITY, decision.strategy, "HIGH")
    base = _corrected(df, decision) if quarantine_on == "corrected" else df
    failed = base.filter(reject(condition_column(decision.filter_condition), null_policy))
    return stamp(failed, C.GUARDIAN_FILTER_FAILED, decision.strategy, decision.drift_severity)


# --------------------------------------------------------------------------- C6
def route(
    df: DataFrame,
    decision: Decision,
    as_of: _dt.datetime = C.DEFAULT_AS_OF,
    null_policy: str = "parity",
    quarantine_on: str = "uncorrected",
) -> DataFrame:
    """Silver and quarantine in one scan: each output row carries ``route``
    (``silver`` or the quarantine reason) and the shared stamp columns.

    Equals ``to_silver`` ∪ ``to_quarantine`` row for row, including a row
    that is in both under parity (S2): it is emitted twice, once corrected
    for silver and once as received for quarantine. Write it with
    ``partitionBy("route")`` to get both datasets from one job.
    """
    _check(df, decision)
    data_cols = df.columns
    corrected_cols = [c for c, _ in decision.corrections] if decision.corrects else []
    # Keep the received values of corrected columns for quarantine rows.
    work = df.select("*", *[F.col(c).alias(f"__orig_{c}") for c in corrected_cols])
    cond = condition_column(decision.filter_condition)
    if decision.strategy == "BLOCK":
        work = work.withColumn("__q", F.lit(C.GUARDIAN_BLOCK))
    elif decision.drift_severity == "HIGH":
        work = work.withColumn("__q", F.lit(C.DRIFT_HIGH_SEVERITY))
    elif quarantine_on == "uncorrected":
        work = work.withColumn("__q", F.when(reject(cond, null_policy), F.lit(C.GUARDIAN_FILTER_FAILED)))
    work = _corrected(work, decision)
    if decision.strategy != "BLOCK" and decision.drift_severity != "HIGH" and quarantine_on == "corrected":
        work = work.withColumn("__q", F.when(reject(cond, null_policy), F.lit(C.GUARDIAN_FILTER_FAILED)))
    silver = F.when(cond, F.lit("silver")) if decision.open else F.lit(None).cast("string")
    work = work.withColumn("route", F.explode(F.filter(F.array(silver, F.col("__q")), lambda x: x.isNotNull())))
    is_silver = F.col("route") == "silver"
    out_cols = [
        (F.when(is_silver, F.col(c)).otherwise(F.col(f"__orig_{c}")) if c in corrected_cols else F.col(c)).alias(c)
        for c in data_cols
    ]
    return work.select(
        *out_cols,
        "route",
        F.lit(decision.strategy).cast("string").alias("guardian_strategy"),
        F.lit(decision.drift_severity).cast("string").alias("drift_severity"),
        F.lit(as_of).cast("timestamp").alias("stamped_at"),
    )
