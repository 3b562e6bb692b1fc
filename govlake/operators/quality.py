"""Data quality guardian: schema drift, null spikes, enum and range checks,
and the guardian decision that steers the silver gate (E3, E6-E9).

The reference sent schemas and column metrics to a language model and asked
for issues plus a fix (strategy, silver filter, corrections). Here a rule
table says, per check, which condition a valid row meets, whether failing
rows are filtered out and which correction repairs them; the decision is an
aggregate over the data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake import config as C
from govlake.functions.columns import rank_severity, severity_rank
from govlake.functions.rules import validate_expressions
from govlake.session import checkpoint_dir


@dataclass(frozen=True)
class Check:
    """One guardian rule: rows of ``table`` should satisfy ``condition``.

    ``allowed`` (ENUM), ``low`` and ``high`` (RANGE, inclusive) say what the
    rule is about and give the condition; other rules write it as ``text``.
    """

    table: str
    name: str
    kind: str  # NULL, RANGE, ENUM
    column: str
    text: str | None = None
    filter: bool = False  # failing rows are kept out of silver
    correction: str | None = None  # SQL that repairs ``column``
    severity: str = "LOW"
    allowed: tuple = ()
    low: float | None = None
    high: float | None = None

    @property
    def condition(self) -> str:
        if self.text is not None:
            return self.text
        if self.allowed:
            return f"{self.column} IN ({', '.join(repr(v) for v in self.allowed)})"
        if self.low is None and self.high is None:
            return f"{self.column} IS NOT NULL"
        bounds = [f"{self.column} {op} {v}" for op, v in ((">=", self.low), ("<=", self.high)) if v is not None]
        return " AND ".join(bounds)


# The one rule table (our fixed choice): the enum check (E7), the range check
# (E8) and the guardian decision (E9) all read it. Order matters: corrections
# are applied in this order, so ``discount_amount`` is repaired before ``amount``.
DEFAULT_CHECKS = (
    Check("orders", "discount_not_null", "NULL", "discount_amount", correction="coalesce(discount_amount, 0)"),
    Check("orders", "positive_amount", "RANGE", "amount", filter=True, correction="abs(amount)", severity="MEDIUM", low=0.01),
    Check("orders", "discount_not_negative", "RANGE", "discount_amount", "coalesce(discount_amount, 0) >= 0", True,
          severity="MEDIUM", low=0),
    Check("orders", "discount_within_amount", "RANGE", "discount_amount", "discount_amount <= amount", True, severity="MEDIUM"),
    Check("orders", "known_order_status", "ENUM", "order_status", filter=True, severity="MEDIUM",
          allowed=("COMPLETED", "PENDING", "CANCELLED")),
    Check("customers", "valid_age", "RANGE", "age", filter=True, severity="MEDIUM", low=0, high=120),
    Check("payments", "normalised_status", "ENUM", "payment_status", "payment_status = upper(trim(payment_status))",
          correction="upper(trim(payment_status))"),
    Check("payments", "final_status", "ENUM", "payment_status", allowed=("SUCCESS", "FAILED")),
    Check("payments", "online_method", "ENUM", "payment_method", allowed=("CARD", "UPI", "WALLET", "NETBANKING")),
    Check("payments", "positive_amount", "RANGE", "amount", filter=True, severity="MEDIUM", low=0.01),
    Check("refunds", "final_status", "ENUM", "refund_status", allowed=("APPROVED", "REJECTED")),
    Check("refunds", "known_reason", "ENUM", "refund_reason", allowed=("DAMAGED", "LATE")),
    Check("refunds", "positive_refund", "RANGE", "refund_amount", filter=True, severity="MEDIUM", low=0.01),
)


def allowed_values(table: str, checks=DEFAULT_CHECKS) -> dict[str, tuple]:
    """Allowed values of a table's enum-like columns."""
    return {c.column: c.allowed for c in checks if c.table == table and c.allowed}


def valid_ranges(table: str, checks=DEFAULT_CHECKS) -> dict[str, tuple]:
    """Valid ranges (inclusive; None is open) of a table's columns."""
    return {c.column: (c.low, c.high) for c in checks if c.table == table and (c.low is not None or c.high is not None)}


BLOCK_PCT = 50.0  # a check failing on more than this share of rows is HIGH


# --------------------------------------------------------------------------- E3
FIELDS_SCHEMA = "struct<fields:array<struct<name:string,type:string,nullable:boolean>>>"


def schema_snapshot(df: DataFrame, table: str, captured_at) -> DataFrame:
    """One row: (table_name, schema_json, rows, captured_at) of a stored drop."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table_name"), F.lit(df.schema.json()).alias("schema_json"), "rows",
        F.lit(captured_at).cast("timestamp").alias("captured_at"),
    )


def schema_drift(history: DataFrame) -> DataFrame:
    """Column-level diff of each table's last two schemas:
    (table_name, column_name, change, previous_type, current_type, severity).

    Removed or retyped columns are HIGH, nullability changes MEDIUM, added
    columns LOW. A first run (one snapshot) yields nothing. Nested types
    compare as their JSON text.
    """
    w = Window.partitionBy("table_name").orderBy(F.col("captured_at").desc())
    last2 = history.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    both = last2.groupBy("table_name").agg(F.count(F.lit(1)).alias("_n"))
    fields = last2.join(both.filter("_n = 2"), "table_name", "left_semi").select(
        "table_name", "_rn", F.explode(F.from_json("schema_json", FIELDS_SCHEMA)["fields"]).alias("f")
    ).select("table_name", "_rn", F.col("f.name").alias("column_name"), F.col("f.type").alias("type"),
             F.col("f.nullable").alias("nullable"))
    cur = fields.filter("_rn = 1").drop("_rn").withColumnsRenamed({"type": "current_type", "nullable": "cur_null"})
    prev = fields.filter("_rn = 2").drop("_rn").withColumnsRenamed({"type": "previous_type", "nullable": "prev_null"})
    j = cur.join(prev, ["table_name", "column_name"], "full_outer")
    change = (
        F.when(F.col("previous_type").isNull(), "ADDED")
        .when(F.col("current_type").isNull(), "REMOVED")
        .when(F.col("previous_type") != F.col("current_type"), "TYPE_CHANGED")
        .when(F.col("prev_null") != F.col("cur_null"), "NULLABILITY_CHANGED")
    )
    sev = (
        F.when(F.col("change").isin("REMOVED", "TYPE_CHANGED"), "HIGH")
        .when(F.col("change") == "NULLABILITY_CHANGED", "MEDIUM")
        .otherwise("LOW")
    )
    return (
        j.withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select("table_name", "column_name", "change", "previous_type", "current_type", sev.alias("severity"))
    )


# --------------------------------------------------------------------------- E6
def null_spikes(history: DataFrame, medium: float = C.NULL_MEDIUM, high: float = C.NULL_HIGH) -> DataFrame:
    """Rise of each column's null share against its previous capture.

    Input: (table_name, column_name, null_percent, distinct_count,
    captured_at). Output per capture with a previous one: previous and
    current share, the rise in points and a severity (NULL below ``medium``).
    Each (table, column) group holds one row per run, so the window is small.
    """
    w = Window.partitionBy("table_name", "column_name").orderBy("captured_at")
    prev = F.lag("null_percent").over(w)
    rise = F.col("null_percent") - F.col("previous_null_percent")
    return (
        history.withColumn("previous_null_percent", prev)
        .filter(F.col("previous_null_percent").isNotNull())
        .select(
            "table_name", "column_name", "captured_at", "previous_null_percent", "null_percent",
            rise.alias("rise_points"),
            F.when(rise > high, "HIGH").when(rise >= medium, "MEDIUM").alias("spike_severity"),
        )
    )


# --------------------------------------------------------------------------- E7
def enum_violations(df: DataFrame, table: str, allowed: dict[str, tuple]) -> DataFrame:
    """(table_name, column_name, value, violations): rows per value outside the
    allowed set, for all enum columns in one scan (NULL is not a violation)."""
    cols = [c for c in allowed if c in df.columns]
    if not cols:
        raise ValueError(f"no enum column of {table} in the frame")
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                     (~F.col(c).isin(*allowed[c])).alias("bad"))
            for c in cols
        ])
    )
    return (
        df.select(pairs.alias("kv"))
        .filter(F.col("kv.bad"))
        .groupBy(F.col("kv.column_name").alias("column_name"), F.col("kv.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(table).alias("table_name"), "column_name", "value", "violations")
    )


# --------------------------------------------------------------------------- E8
def range_violations(df: DataFrame, table: str, ranges: dict[str, tuple]) -> DataFrame:
    """(table_name, column_name, checked_rows, violations, violation_pct) for
    each ranged column, in one aggregate."""
    cols = [c for c in ranges if c in df.columns]
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = ranges[c]
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < F.lit(lo))
        if hi is not None:
            bad = bad | (F.col(c) > F.lit(hi))
        aggs += [F.count(c).alias(f"__n{i}"), F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias(f"__v{i}")]
    stack = ", ".join(f"'{c}', `__n{i}`, `__v{i}`" for i, c in enumerate(cols))
    return df.agg(*aggs).select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(cols)}, {stack}) AS (column_name, checked_rows, violations)"),
    ).select(
        "table_name", "column_name", "checked_rows", "violations",
        (F.try_divide(F.col("violations").cast("double"), F.col("checked_rows").cast("double")) * F.lit(100.0)).alias(
            "violation_pct"
        ),
    )


# --------------------------------------------------------------------------- E9
def checks_frame(spark, checks=DEFAULT_CHECKS) -> DataFrame:
    return spark.createDataFrame(
        [(c.table, c.name, i, c.kind, c.column, c.condition, c.filter, c.correction, c.severity)
         for i, c in enumerate(checks)],
        "table_name string, check_name string, ordinal int, kind string, column_name string, condition string, "
        "is_filter boolean, correction string, severity string",
    )


def check_failures(tables: dict[str, DataFrame], checks=DEFAULT_CHECKS) -> DataFrame:
    """(table_name, check_name, rows, failing): one aggregate per table.

    A row whose condition is NULL fails the check (it would not pass a
    silver filter either)."""
    frames = []
    for table, df in tables.items():
        mine = [(i, c) for i, c in enumerate(checks) if c.table == table]
        if not mine:
            continue
        validate_expressions(df, [c.condition for _, c in mine])
        aggs = [F.count(F.lit(1)).alias("__rows")] + [
            F.sum(F.when(~F.coalesce(F.expr(f"({c.condition})"), F.lit(False)), 1).otherwise(0)).cast("bigint").alias(f"__f{i}")
            for i, c in mine
        ]
        stack = ", ".join(f"{json.dumps(c.name)}, `__f{i}`" for i, c in mine)
        frames.append(
            df.agg(*aggs).select(
                F.lit(table).alias("table_name"), F.col("__rows").alias("rows"),
                F.expr(f"stack({len(mine)}, {stack}) AS (check_name, failing)"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def guardian_issues(failures: DataFrame, checks: DataFrame, block_pct: float = BLOCK_PCT) -> DataFrame:
    """Failing checks as issues: (table_name, issue_type, severity,
    column_name, message, failing_rows, failing_pct, ...rule columns)."""
    j = failures.filter(F.col("failing") > 0).join(F.broadcast(checks), ["table_name", "check_name"])
    pct = F.try_divide(F.col("failing").cast("double"), F.col("rows").cast("double")) * F.lit(100.0)
    return j.select(
        "table_name",
        F.col("kind").alias("issue_type"),
        F.when(pct > block_pct, F.lit("HIGH")).otherwise(F.col("severity")).alias("severity"),
        "column_name",
        F.concat(F.col("check_name"), F.lit(" failed on "), F.col("failing").cast("string"), F.lit(" of "),
                 F.col("rows").cast("string"), F.lit(" rows")).alias("message"),
        F.col("failing").alias("failing_rows"),
        pct.alias("failing_pct"),
        "check_name", "ordinal", "condition", "is_filter", "correction",
    )


#: What an issue has besides its table: row checks fill all of it, the other detections the first part.
ISSUE_SCHEMA = (
    "table_name string, issue_type string, severity string, column_name string, message string, failing_rows bigint, "
    "failing_pct double, check_name string, ordinal int, condition string, is_filter boolean, correction string"
)


def _as_issues(df: DataFrame, check: str, issue_type: str, severity, message) -> DataFrame:
    fields = T.StructType.fromDDL(ISSUE_SCHEMA).fields
    given = {
        "table_name": F.col("table_name"), "issue_type": F.lit(issue_type), "severity": severity,
        "column_name": F.col("column_name"), "message": message, "check_name": F.lit(check), "is_filter": F.lit(False),
    }
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def schema_issues(drift: DataFrame) -> DataFrame:
    """Schema changes (E3) as issues: a removed or retyped column is HIGH."""
    message = F.concat_ws(" ", F.lit("column"), "column_name", F.lower("change"), F.concat(F.lit("("), F.coalesce("previous_type", F.lit("none")),
                          F.lit(" to "), F.coalesce("current_type", F.lit("none")), F.lit(")")))
    return _as_issues(drift, "schema_drift", "SCHEMA", F.col("severity"), message)


def null_spike_issues(spikes: DataFrame) -> DataFrame:
    """NULL spikes (E6) of the latest capture as issues."""
    last = spikes.groupBy("table_name").agg(F.max("captured_at").alias("captured_at"))
    now = spikes.join(last, ["table_name", "captured_at"]).where("spike_severity IS NOT NULL")
    message = F.concat(F.lit("NULL share of "), "column_name", F.lit(" rose by "), F.round("rise_points", 1).cast("string"), F.lit(" points"))
    return _as_issues(now, "null_spike", "NULL_SPIKE", F.col("spike_severity"), message)


def _chained(parts: Column) -> Column:
    """Corrections in order, one entry per column: a later correction of a
    column is applied to the earlier one's result."""
    def put(done, x):
        before = F.filter(done, lambda e: e["key"] == x["column_name"])
        inner = F.concat(F.lit("("), F.get(before, 0)["value"], F.lit(")"))
        text = F.when(F.size(before) > 0, F.regexp_replace(x["correction"], F.concat(F.lit("\\b"), x["column_name"], F.lit("\\b")), inner)).otherwise(x["correction"])
        rest = F.filter(done, lambda e: e["key"] != x["column_name"])
        return F.concat(rest, F.array(F.struct(x["column_name"].alias("key"), text.alias("value"))))

    return F.aggregate(parts, F.array().cast("array<struct<key:string,value:string>>"), put)


def guardian_decision(issues: DataFrame, tables: DataFrame) -> DataFrame:
    """Per table: strategy, silver filter, ordered corrections, overall
    severity, processing flag and issue count.

    Strategy: BLOCK when an issue is HIGH; BOTH / CORRECT / QUARANTINE by
    whether failing checks bring a filter, a correction or both; a table
    without issues gets QUARANTINE with an empty (TRUE) filter. The issue
    list per table is bounded by the rule table, so collecting it is safe.
    """
    per = issues.groupBy("table_name").agg(
        F.max(severity_rank(F.col("severity"))).alias("_rank"),
        F.array_sort(F.collect_list(F.when(F.col("is_filter"), F.struct("ordinal", "condition")))).alias("_f"),
        F.array_sort(
            F.collect_list(F.when(F.col("correction").isNotNull(), F.struct("ordinal", "column_name", "correction")))
        ).alias("_c"),
        F.count(F.lit(1)).alias("issue_count"),
    )
    j = tables.join(per, "table_name", "left")
    has_f = F.coalesce(F.size("_f"), F.lit(0)) > 0
    has_c = F.coalesce(F.size("_c"), F.lit(0)) > 0
    strategy = (
        F.when(F.col("_rank") == 3, "BLOCK")
        .when(has_f & has_c, "BOTH")
        .when(has_c, "CORRECT")
        .otherwise("QUARANTINE")
    )
    filt = F.coalesce(F.array_join(F.transform("_f", lambda x: F.concat(F.lit("("), x["condition"], F.lit(")"))), " AND "), F.lit(""))
    corrections = F.coalesce(_chained(F.col("_c")), F.array().cast("array<struct<key:string,value:string>>"))
    overall = F.coalesce(rank_severity(F.col("_rank")), F.lit("LOW"))
    return j.select(
        "table_name",
        strategy.alias("strategy"),
        filt.alias("silver_filter_condition"),
        corrections.alias("corrections"),
        overall.alias("overall_severity"),
        (overall != "HIGH").alias("allow_processing"),
        F.coalesce(F.col("issue_count"), F.lit(0)).cast("bigint").alias("issue_count"),
    )


def corrections_text(col: str = "corrections") -> F.Column:
    """Ordered corrections as text: ``col := expr; ...``."""
    return F.array_join(F.transform(col, lambda x: F.concat(x["key"], F.lit(" := "), x["value"])), "; ")


def guardian_control(decision: DataFrame, updated_at, table_names: dict | None = None) -> DataFrame:
    """Control rows: (table_name, allow_processing, severity, fix_json, updated_at)."""
    fix = F.struct(
        F.col("strategy").alias("strategy"),
        F.col("silver_filter_condition").alias("silver_filter_condition"),
        F.map_from_entries("corrections").alias("correction_expression"),
    )
    out = decision.select(
        "table_name", "allow_processing", F.col("overall_severity").alias("severity"),
        F.to_json(fix).alias("fix_json"), F.lit(updated_at).cast("timestamp").alias("updated_at"),
    )
    if table_names:
        out = out.replace(table_names, subset=["table_name"])
    return out


def guardian_run(
    tables: dict[str, DataFrame], checks=DEFAULT_CHECKS, schema_history: DataFrame | None = None, null_history: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """All detections -> issues -> decision for the given tables: row checks
    (enum, range, NULL), and where their histories are given schema drift and
    NULL spikes. A HIGH issue of any of them blocks the table's silver."""
    spark = next(iter(tables.values())).sparkSession
    checkpoint_dir(spark)
    cf = checks_frame(spark, checks)
    # Issues are at most one row per check: cut them once, as the decision,
    # the audit and the events all read them.
    issues = guardian_issues(check_failures(tables, checks), cf)
    if schema_history is not None:
        issues = issues.unionByName(schema_issues(schema_drift(schema_history)))
    if null_history is not None:
        issues = issues.unionByName(null_spike_issues(null_spikes(null_history)))
    issues = issues.coalesce(1).checkpoint(eager=True)
    names = spark.createDataFrame([(t,) for t in tables], "table_name string")
    return issues, guardian_decision(issues, names)


def guardian_audit(issues: DataFrame, decision: DataFrame, event_time, table_names: dict | None = None) -> DataFrame:
    """Audit rows, one per issue, with the table's fix document and overall
    severity; a table without issues gets one NO_ISSUE row (S18)."""
    fix = F.to_json(F.struct(
        F.col("strategy").alias("strategy"),
        F.col("silver_filter_condition").alias("silver_filter_condition"),
        F.map_from_entries("corrections").alias("correction_expression"),
    ))
    dec = decision.select("table_name", fix.alias("recommended_fix_code"), "overall_severity", "issue_count")
    rows = issues.join(dec, "table_name").select(
        "table_name", "issue_type", "severity", "column_name", "message", "recommended_fix_code", "overall_severity",
    )
    none = dec.filter(F.col("issue_count") == 0).select(
        "table_name", F.lit("NO_ISSUE").alias("issue_type"), F.lit("LOW").alias("severity"),
        F.lit("NONE").alias("column_name"), F.lit("No issue detected").alias("message"),
        "recommended_fix_code", "overall_severity",
    )
    out = rows.unionByName(none).withColumn("event_time", F.lit(event_time).cast("timestamp"))
    if table_names:
        out = out.replace(table_names, subset=["table_name"])
    return out


def guardian_events(audit: DataFrame, decision: DataFrame, pipeline_name: str, table_names: dict | None = None) -> DataFrame:
    """Event rows (pipeline, table, issue, action taken, processing allowed,
    fix applied) from the audit and the decision."""
    d = decision.select("table_name", "allow_processing", "strategy")
    if table_names:
        d = d.replace(table_names, subset=["table_name"])
    return audit.join(d, "table_name").select(
        F.lit(pipeline_name).alias("pipeline_name"), "table_name", "issue_type", "severity", "message",
        F.col("recommended_fix_code").alias("action_taken"),
        F.col("allow_processing").alias("processing_allowed"),
        F.col("strategy").isin("CORRECT", "BOTH").alias("fix_applied"),
        "event_time",
    )
