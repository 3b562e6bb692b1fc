"""Drift rules over the long-format metric history.

The reference put the previous and current metrics into a prompt and had a
language model apply the rules it spelled out. Here the same rules are
column expressions over a table of metric pairs, for all tables at once.

Every rule yields rows of one shape: table_name, issue_type, column,
metric_name, severity, message, recommended_action, current_value,
previous_value, change_pct. ``change_pct`` is the raw DOUBLE the band was
chosen from. A metric that did not change, or that cannot be compared, is no
issue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govlake import config as C
from govlake.functions.columns import rank_severity, severity_rank
from govlake.operators.profile import TOP_VALUES, column_of_value

ISSUE_COLUMNS = (
    "table_name", "issue_type", "column", "metric_name", "severity", "message",
    "recommended_action", "current_value", "previous_value", "change_pct",
)


# --------------------------------------------------------------------------- F2
def drift_pairs(history: DataFrame) -> DataFrame:
    """Current and previous value of each metric per table.

    current: the value at the table's latest ``captured_at``; previous: the
    most recent non-NULL value strictly before it. A value share
    (``<c>::<value>``) is compared with the snapshot just before only, and only
    if it was among that snapshot's largest shares of its column: those are the
    ones that the latest snapshot counted again, so that a value missing there
    is gone and not merely rarer. A single aggregate over (table, metric) gives
    the full outer join of both sides; the times per table are a table-sized
    aggregate joined back by broadcast.
    """
    times = F.sort_array(F.collect_set("captured_at"), asc=False)
    latest = history.groupBy("table_name").agg(times.alias("times")).select(
        "table_name", F.get("times", 0).alias("latest_at"), F.get("times", 1).alias("before_at"))
    h = history.join(F.broadcast(latest), "table_name").withColumn("column_of_value", column_of_value(F.col("metric_name")))
    largest = Window.partitionBy("table_name", "captured_at", "column_of_value").orderBy(F.col("metric_value").desc(), "metric_name")  # one snapshot's report
    h = h.withColumn("rank", F.row_number().over(largest))
    is_cur = F.col("captured_at") == F.col("latest_at")
    is_value = F.col("column_of_value").isNotNull()
    compared = ~is_value | ((F.col("captured_at") == F.col("before_at")) & (F.col("rank") <= TOP_VALUES))
    is_prev = (F.col("captured_at") < F.col("latest_at")) & F.col("metric_value").isNotNull() & compared
    return (
        h.groupBy("table_name", "metric_name")
        .agg(
            F.max(F.when(is_cur, F.col("metric_value"))).alias("current_value"),
            F.max_by(F.when(is_prev, F.col("metric_value")), F.when(is_prev, F.col("captured_at"))).alias(
                "previous_value"
            ),
            F.max(is_cur.cast("int")).alias("_has_cur"),
        )
        .select("table_name", "metric_name", "current_value", "previous_value", (F.col("_has_cur") == 1).alias("in_current"))
    )


def _rel_change(cur: Column, prev: Column) -> Column:
    """(current - previous) / |previous| * 100; NULL for a NULL or 0 previous."""
    return F.try_divide((cur - prev), F.abs(prev)) * F.lit(100.0)


def _action(severity: Column) -> Column:
    """F8: HIGH -> BLOCK_SILVER, MEDIUM -> FLAG_AND_ALERT, LOW -> INVESTIGATE_SOURCE.
    A metric that did not move is no issue and needs no action."""
    return (
        F.when(severity == "HIGH", C.BLOCK_SILVER)
        .when(severity == "MEDIUM", C.FLAG_AND_ALERT)
        .otherwise(C.INVESTIGATE_SOURCE)
    )


def _direction(change: Column) -> Column:
    return F.when(change > 0, "increase").otherwise("decrease")


def _issues(df: DataFrame, issue_type: str, column: Column, severity: Column, change: Column) -> DataFrame:
    out = df.select(
        "table_name",
        F.lit(issue_type).alias("issue_type"),
        column.alias("column"),
        "metric_name",
        severity.alias("severity"),
        "current_value",
        "previous_value",
        change.alias("change_pct"),
    ).filter(F.coalesce(F.col("change_pct"), F.lit(0.0)) != 0)
    return out.select(
        "table_name", "issue_type", "column", "metric_name", "severity",
        F.concat(F.col("issue_type"), F.lit(" on "), F.col("column"), F.lit(": "), F.col("severity"), F.lit(" "),
                 _direction(F.col("change_pct"))).alias("message"),
        _action(F.col("severity")).alias("recommended_action"),
        "current_value", "previous_value", "change_pct",
    )


def _suffix(name: str, suffix: str) -> Column:
    return F.expr(f"substring(metric_name, 1, length(metric_name) - {len(suffix)})")


def _comparable(pairs: DataFrame) -> DataFrame:
    """Metrics present in the latest snapshot and with a previous value."""
    return pairs.filter(F.col("in_current") & F.col("previous_value").isNotNull())


def _config_map(mapping: dict) -> Column:
    """A table -> columns map literal (config, a handful of entries)."""
    entries = []
    for table, cols in mapping.items():
        entries += [F.lit(table), F.array(*[F.lit(c) for c in cols])]
    return F.create_map(*entries)


# --------------------------------------------------------------------------- F3
def drift_volume(pairs: DataFrame) -> DataFrame:
    """Absolute % change of ``row_count``: > 50 HIGH, 25-50 MEDIUM, else LOW.
    No row on a first run (no previous snapshot, S14)."""
    p = _comparable(pairs.filter(F.col("metric_name") == "row_count"))
    change = F.abs(_rel_change(F.col("current_value"), F.col("previous_value")))
    sev = (
        F.when(change > C.VOLUME_HIGH, "HIGH").when(change >= C.VOLUME_MEDIUM, "MEDIUM").otherwise("LOW")
    )
    return _issues(p, "VOLUME_DRIFT", F.lit("row_count"), sev, change)


# --------------------------------------------------------------------------- F4
def drift_null(pairs: DataFrame) -> DataFrame:
    """Rise of a column's null share in percentage points: > 40 HIGH,
    20-40 MEDIUM, else LOW; a fall is good (LOW)."""
    p = _comparable(pairs.filter(F.col("metric_name").endswith("_null_pct")))
    change = F.col("current_value") - F.col("previous_value")
    sev = F.when(change > C.NULL_HIGH, "HIGH").when(change >= C.NULL_MEDIUM, "MEDIUM").otherwise("LOW")
    return _issues(p, "NULL_DRIFT", _suffix("metric_name", "_null_pct"), sev, change)


def _shares(pairs: DataFrame) -> DataFrame:
    """Per table: summed current share of positive and negative status values."""
    cols = _config_map(C.CATEGORY_DRIFT_COLUMNS)
    parts = F.split(F.col("metric_name"), "::", 2)
    cat = pairs.filter(F.col("metric_name").contains("::") & F.col("in_current")).select(
        "table_name", parts[0].alias("col"), parts[1].alias("val"), "current_value"
    )
    cat = cat.filter(F.array_contains(F.coalesce(F.element_at(cols, F.col("table_name")), F.array().cast("array<string>")), F.col("col")))
    return cat.groupBy("table_name").agg(
        F.sum(F.when(F.col("val").isin(*C.POSITIVE_CATEGORIES), F.col("current_value")).otherwise(0.0)).alias("pos_share"),
        F.sum(F.when(F.col("val").isin(*C.NEGATIVE_CATEGORIES), F.col("current_value")).otherwise(0.0)).alias("neg_share"),
    )


# --------------------------------------------------------------------------- F5
def drift_cardinality(pairs: DataFrame) -> DataFrame:
    """Distinct-count change of the table's primary key only. A fall > 30 %
    is HIGH, 15-30 % MEDIUM; a rise is LOW when positive statuses hold at
    least the negative share, MEDIUM when negative ones dominate."""
    pk = F.element_at(_config_map({t: (k,) for t, k in C.PRIMARY_KEYS.items()}), F.col("table_name"))[0]
    p = _comparable(pairs).filter(F.col("metric_name") == F.concat(pk, F.lit("_distinct_cnt")))
    p = p.join(F.broadcast(_shares(pairs)), "table_name", "left")
    change = _rel_change(F.col("current_value"), F.col("previous_value"))
    good = F.coalesce(F.col("pos_share"), F.lit(0.0)) >= F.coalesce(F.col("neg_share"), F.lit(0.0))
    sev = (
        F.when(change < -C.CARD_FALL_HIGH, "HIGH")
        .when(change <= -C.CARD_FALL_MEDIUM, "MEDIUM")
        .when((change > 0) & ~good, "MEDIUM")
        .otherwise("LOW")
    )
    return _issues(p, "CARDINALITY_DRIFT", _suffix("metric_name", "_distinct_cnt"), sev, change)


# --------------------------------------------------------------------------- F6
def drift_numeric(pairs: DataFrame) -> DataFrame:
    """Average change of the table's numeric drift columns: fall > 70 % HIGH,
    40-70 % MEDIUM, rise > 90 % MEDIUM, else LOW."""
    cols = _config_map(C.NUMERIC_DRIFT_COLUMNS)
    column = _suffix("metric_name", "_avg")
    p = _comparable(pairs.filter(F.col("metric_name").endswith("_avg")))
    p = p.filter(F.array_contains(F.coalesce(F.element_at(cols, F.col("table_name")), F.array().cast("array<string>")), column))
    change = _rel_change(F.col("current_value"), F.col("previous_value"))
    sev = (
        F.when(change < -C.AVG_FALL_HIGH, "HIGH")
        .when(change <= -C.AVG_FALL_MEDIUM, "MEDIUM")
        .when(change > C.AVG_RISE_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )
    return _issues(p, "NUMERIC_DRIFT", column, sev, change)


# --------------------------------------------------------------------------- F7
def drift_category(pairs: DataFrame) -> DataFrame:
    """Share change of status values, relative to the previous share.

    Positive value (SUCCESS, ...) falling > 30 % HIGH, 15-30 % MEDIUM;
    negative value (FAILED, ...) rising > 50 % HIGH, 25-50 % MEDIUM; other
    values LOW. A value gone from the latest snapshot has a 0 % share.
    """
    cols = _config_map(C.CATEGORY_DRIFT_COLUMNS)
    parts = F.split(F.col("metric_name"), "::", 2)
    p = pairs.filter(F.col("metric_name").contains("::") & F.col("previous_value").isNotNull())
    p = p.withColumn("current_value", F.coalesce(F.col("current_value"), F.lit(0.0)))
    p = p.filter(
        F.array_contains(F.coalesce(F.element_at(cols, F.col("table_name")), F.array().cast("array<string>")), parts[0])
    )
    val = parts[1]
    change = _rel_change(F.col("current_value"), F.col("previous_value"))
    positive = val.isin(*C.POSITIVE_CATEGORIES)
    negative = val.isin(*C.NEGATIVE_CATEGORIES)
    sev = (
        F.when(positive & (change < -C.POS_FALL_HIGH), "HIGH")
        .when(positive & (change <= -C.POS_FALL_HIGH / 2), "MEDIUM")
        .when(negative & (change > C.NEG_RISE_HIGH), "HIGH")
        .when(negative & (change >= C.NEG_RISE_HIGH / 2), "MEDIUM")
        .otherwise("LOW")
    )
    return _issues(p, "CATEGORY_DRIFT", F.col("metric_name"), sev, change)


# --------------------------------------------------------------------------- F8, F9
def drift_issues(pairs: DataFrame) -> DataFrame:
    """All five rules, one frame."""
    return (
        drift_volume(pairs)
        .unionByName(drift_null(pairs))
        .unionByName(drift_cardinality(pairs))
        .unionByName(drift_numeric(pairs))
        .unionByName(drift_category(pairs))
    )


def drift_decision(issues: DataFrame, tables: DataFrame) -> DataFrame:
    """Per table: overall severity (the highest), processing allowed unless an
    issue asks for BLOCK_SILVER, and issue counts. A table without issues gets
    a LOW, allowed decision (the reference's NO_DRIFT row).

    ``tables`` is the table list (one column ``table_name``).
    """
    per = issues.groupBy("table_name").agg(
        F.max(severity_rank(F.col("severity"))).alias("_rank"),
        F.max((F.col("recommended_action") == C.BLOCK_SILVER).cast("int")).alias("_block"),
        F.count(F.lit(1)).alias("issue_count"),
        F.sum((F.col("severity") == "HIGH").cast("int")).cast("bigint").alias("high_count"),
        F.sum((F.col("severity") == "MEDIUM").cast("int")).cast("bigint").alias("medium_count"),
    )
    return tables.join(per, "table_name", "left").select(
        "table_name",
        F.coalesce(rank_severity(F.col("_rank")), F.lit("LOW")).alias("overall_severity"),
        (F.coalesce(F.col("_block"), F.lit(0)) == 0).alias("allow_processing"),
        F.coalesce(F.col("issue_count"), F.lit(0)).cast("bigint").alias("issue_count"),
        F.coalesce(F.col("high_count"), F.lit(0)).cast("bigint").alias("high_count"),
        F.coalesce(F.col("medium_count"), F.lit(0)).cast("bigint").alias("medium_count"),
    )


def drift_audit(issues: DataFrame, decision: DataFrame, event_time) -> DataFrame:
    """Audit rows: every issue with the table's overall severity, and one
    NO_DRIFT row for a table without issues."""
    with_overall = issues.join(decision.select("table_name", "overall_severity"), "table_name")
    rows = with_overall.select(
        "table_name", "issue_type", "column", "severity", "message", "recommended_action", "overall_severity"
    )
    # fixed values of a table without drift, which must equal the reference's
    none = decision.filter(F.col("issue_count") == 0).select(
        "table_name",
        F.lit("NO_DRIFT").alias("issue_type"),
        F.lit("NONE").alias("column"),
        F.lit("LOW").alias("severity"),
        F.lit("No drift detected").alias("message"),
        F.lit("NONE").alias("recommended_action"),
        F.lit("LOW").alias("overall_severity"),
    )
    return rows.unionByName(none).withColumn("event_time", F.lit(event_time).cast("timestamp"))


def drift_control(issues: DataFrame, decision: DataFrame, updated_at, table_names: dict | None = None) -> DataFrame:
    """Drift control rows: (table_name, allow_processing, severity,
    agent_result_json, updated_at). The drift list of a table holds only metrics
    that moved, of declared columns."""
    items = issues.groupBy("table_name").agg(
        F.array_sort(
            F.collect_list(F.struct("issue_type", "column", "severity", "message", "recommended_action"))
        ).alias("drifts")
    )
    out = decision.join(items, "table_name", "left").select(
        "table_name",
        "allow_processing",
        F.col("overall_severity").alias("severity"),
        F.to_json(
            F.struct(
                F.coalesce(F.col("drifts"), F.array().cast(items.schema["drifts"].dataType)).alias("drifts"),
                F.col("overall_severity").alias("overall_severity"),
            )
        ).alias("agent_result_json"),
        F.lit(updated_at).cast("timestamp").alias("updated_at"),
    )
    if table_names:
        out = out.replace(table_names, subset=["table_name"])
    return out
