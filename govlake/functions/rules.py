"""Rule text helpers: SQL-text conditions that arrive as data.

Filter conditions, corrections and row rules are SQL expressions stored in
decision rows. They are turned into Columns here, once, on the driver; all
evaluation happens in the executors' generated code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_expression(text: str) -> str:
    """Quote the bare ``SUCCESS`` literal the policy text may carry.

    Parity: ``= SUCCESS`` is rewritten first; as ``!= SUCCESS`` contains
    ``= SUCCESS`` it is already quoted by then.
    """
    return text.replace("= SUCCESS", "= 'SUCCESS'").replace("!= SUCCESS", "!= 'SUCCESS'")


def and_all(conditions: Iterable[str]) -> str:
    """AND several SQL conditions, each parenthesised so that a rule with OR
    keeps its meaning (S6). Empty or blank conditions are skipped; no
    condition at all is ``""``."""
    parts = [c.strip() for c in conditions if c is not None and c.strip()]
    return " AND ".join(f"({p})" for p in parts)


def condition_column(text: str | None) -> Column:
    """A SQL condition as a Column; empty text means TRUE."""
    if text is None or not text.strip():
        return F.lit(True)
    return F.expr(text)


def reject(cond: Column, null_policy: str = "parity") -> Column:
    """Predicate for the failing side of a split.

    ``parity``: ``NOT cond`` (a NULL condition is in neither side, S1).
    ``quarantine``: ``NOT coalesce(cond, false)``, so sides cover all rows.
    """
    if null_policy == "quarantine":
        return ~F.coalesce(cond, F.lit(False))
    if null_policy != "parity":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    return ~cond


#: Functions that rule text may call: value expressions without side effects.
ALLOWED_FUNCTIONS = frozenset(
    "abs bround cast ceil ceiling char_length coalesce concat concat_ws current_date date date_add date_sub datediff day "
    "endswith floor greatest if ifnull initcap isnotnull isnull lcase least left length lower lpad ltrim month nullif nvl "
    "nvl2 pmod power regexp_replace replace right round rpad rtrim sign split_part startswith substr substring to_date "
    "to_timestamp translate trim try_cast try_divide try_to_date ucase upper year".split()
)
#: Aggregate functions that a metric may call as well: their state per task does
#: not grow with the rows (those that collect or sort a group's values are not listed).
ALLOWED_AGGREGATES = frozenset(
    "approx_count_distinct approx_percentile avg bool_and bool_or corr count count_if every kurtosis max max_by mean min min_by "
    "percentile_approx regr_slope skewness some std stddev stddev_pop stddev_samp sum try_avg try_sum var_pop var_samp variance".split()
)
#: Words that may stand before a parenthesis without being a function.
_KEYWORDS = frozenset("and between case decimal else end in is like not numeric or rlike then varchar when".split())
_LITERALS = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*\"""", re.DOTALL)


def refuse_unsafe(text: str, allowed: frozenset[str] = ALLOWED_FUNCTIONS) -> None:
    """Refuse rule text that is more than a value expression: subqueries,
    comments, several statements, and functions outside the allow list (such
    as those that call into the JVM or read files)."""
    bare = _LITERALS.sub("''", text)
    if re.search(r"--|/\*|;|\{|\b(select|from|exists|with|table|values|lateral)\b", bare, re.IGNORECASE):
        raise ValueError(f"rule text must be a plain condition: {text!r}")
    for called in re.findall(r"((?:`[^`]*`|[\w.])+)\s*\(", bare):
        name = called.replace("`", "").lower()
        if name not in allowed and name not in _KEYWORDS:
            raise ValueError(f"rule text may not call {called}: {text!r}")


def validate_expressions(df: DataFrame, texts: Iterable[str]) -> None:
    """Refuse unsafe text and resolve the rest against ``df``'s schema without
    running a job: analysis fails on unknown columns or bad syntax, so a bad
    decision is refused before any data is read.
    """
    texts = [t for t in texts if t is not None and t.strip()]
    for t in texts:
        refuse_unsafe(t)
    if texts:
        df.limit(0).select(*[F.expr(t) for t in texts]).schema  # noqa: B018 - forces analysis only


def validate_metrics(df: DataFrame, texts: Iterable[str]) -> None:
    """Refuse metric text that is unsafe, is not one number per table (a bare
    column, a window, a text), or does not resolve against ``df``; no job is run."""
    for text in texts:
        refuse_unsafe(text, ALLOWED_FUNCTIONS | ALLOWED_AGGREGATES)
        if re.search(r"\b(over|distinct)\b", _LITERALS.sub("''", text), re.IGNORECASE):
            raise ValueError(f"a metric may not use windows or exact distinct counts (approx_count_distinct may be used): {text!r}")
        kind = df.limit(0).agg(F.expr(text).alias("metric")).schema["metric"].dataType
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"a metric must be a number, not {kind.simpleString()}: {text!r}")


def apply_corrections(df: DataFrame, corrections: Iterable[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Replace columns by SQL expressions one at a time.

    Order matters and is kept: a later expression sees the earlier results
    (S3). Pass an ordered sequence of ``(column, expression)`` pairs.
    """
    items = corrections.items() if isinstance(corrections, Mapping) else corrections
    for column, text in items:
        refuse_unsafe(text)
        df = df.withColumn(column, F.expr(text))
    return df
