"""Column-level helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, scale: int | None = 2) -> Column:
    """``part / whole * 100``; NULL instead of an error on a zero whole."""
    value = F.try_divide(part, whole) * F.lit(100)
    return F.round(value, scale) if scale is not None else value


def change_pct(current: Column, previous: Column, scale: int | None = 2) -> Column:
    """Percent change versus ``previous``: NULL when previous is NULL or 0.

    Computed in DOUBLE: a DECIMAL quotient is first rounded to 6 places by
    Spark's precision rules, and rounding that again to 2 places can be off
    by one cent of a percent.
    """
    value = F.try_divide((current - previous).cast("double"), previous.cast("double")) * F.lit(100)
    return F.round(value, scale) if scale is not None else value


def success_flag(status: Column) -> Column:
    """1 for a SUCCESS payment, else 0 (NULL status counts 0)."""
    return F.when(status == "SUCCESS", 1).otherwise(0)


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "HIGH", 3).when(severity == "MEDIUM", 2).when(severity == "LOW", 1).otherwise(0)


def rank_severity(rank: Column) -> Column:
    return F.when(rank == 3, "HIGH").when(rank == 2, "MEDIUM").when(rank == 1, "LOW")
