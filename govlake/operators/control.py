"""Control plane: latest decision per table, decision parsing and the gate
(C1-C3), plus the one-row-per-key upsert of control tables (A9).

Control tables are small (a few rows per table and run), but nothing here
assumes it: the latest row per key is an aggregate (``max_by``), not a sort
and collect, and only the one decision row a plan needs reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIX_SCHEMA = T.StructType(
    [
        T.StructField("strategy", T.StringType()),
        T.StructField("silver_filter_condition", T.StringType()),
        T.StructField("correction_expression", T.MapType(T.StringType(), T.StringType())),
    ]
)

DRIFT_ITEM = T.StructType(
    [
        T.StructField("issue_type", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
    ]
)
DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("drifts", T.ArrayType(DRIFT_ITEM)),
        T.StructField("overall_severity", T.StringType()),
    ]
)


#: Control tables, one row per decision.
GUARDIAN_CONTROL_SCHEMA = (
    "table_name string, allow_processing boolean, severity string, fix_json string, updated_at timestamp"
)
DRIFT_CONTROL_SCHEMA = (
    "table_name string, allow_processing boolean, severity string, agent_result_json string, updated_at timestamp"
)


# --------------------------------------------------------------------------- C1
def latest_control(ctrl: DataFrame, key: str = "table_name", ts: str = "updated_at") -> DataFrame:
    """The newest row per key, for all keys at once (one aggregate).

    ``max_by`` over a struct of all columns keeps whole rows without a sort
    or a window; partial aggregation bounds what each key sends.
    """
    cols = [c for c in ctrl.columns]
    latest = ctrl.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_row"))
    return latest.select(*[F.col("_row")[c].alias(c) for c in cols])


# --------------------------------------------------------------------------- A9
def upsert_latest(current: DataFrame, updates: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """MERGE-like upsert: one row per key, the update winning over the
    current row (and the newer of two updates winning), other keys kept.

    Built-in tables refuse MERGE and no row-level table format is assumed, so
    the new version of the table is computed and written whole (A6). It is
    one aggregate per key (``max_by`` on (ts, source)), so a key with very
    many versions is combined map-side instead of sorted in one task. Ties on
    ``ts`` prefer the update; NULL ``ts`` loses; the result is idempotent.
    """
    cols = current.columns
    tagged = current.withColumn("_src", F.lit(0)).unionByName(updates.select(*cols).withColumn("_src", F.lit(1)))
    order = F.struct(F.col(ts).isNotNull().alias("_has_ts"), F.col(ts).alias("_ts"), F.col("_src"))
    best = tagged.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in cols])


# --------------------------------------------------------------------------- C2
def parse_guardian(ctrl: DataFrame) -> DataFrame:
    """fix_json -> strategy, filter text, ordered correction pairs."""
    fix = F.from_json("fix_json", FIX_SCHEMA)
    return ctrl.select(
        "table_name",
        fix["strategy"].alias("strategy"),
        fix["silver_filter_condition"].alias("silver_filter_condition"),
        # map_entries keeps the JSON order, which decides correction order (S3).
        F.map_entries(fix["correction_expression"]).alias("corrections"),
        "updated_at",
    )


def parse_drift(ctrl: DataFrame) -> DataFrame:
    """agent_result_json -> overall severity and the drift items."""
    res = F.from_json("agent_result_json", DRIFT_SCHEMA)
    return ctrl.select(
        "table_name",
        res["overall_severity"].alias("overall_severity"),
        res["drifts"].alias("drifts"),
        "updated_at",
    )


# --------------------------------------------------------------------------- C3
@dataclass(frozen=True)
class Decision:
    """What the silver gate needs for one table, read once per plan."""

    table: str
    strategy: str | None = None
    filter_condition: str | None = None
    corrections: tuple = field(default_factory=tuple)  # ((column, sql), ...) in order
    drift_severity: str | None = None

    @property
    def guardian_open(self) -> bool:
        return self.strategy != "BLOCK"

    @property
    def drift_open(self) -> bool:
        return self.drift_severity != "HIGH"

    @property
    def open(self) -> bool:
        """Silver is built unless guardian says BLOCK or drift says HIGH."""
        return self.guardian_open and self.drift_open

    @property
    def corrects(self) -> bool:
        return self.strategy in ("CORRECT", "BOTH")


def read_decision(guardian_ctrl: DataFrame, drift_ctrl: DataFrame, table: str) -> Decision:
    """Latest guardian and drift decision of one table as a ``Decision``.

    Two one-row reads (A12). A missing row is a neutral decision: gate open,
    filter TRUE, no corrections (S5).
    """
    g = parse_guardian(latest_control(guardian_ctrl.filter(F.col("table_name") == F.lit(table)))).first()
    d = parse_drift(latest_control(drift_ctrl.filter(F.col("table_name") == F.lit(table)))).first()
    corrections = tuple((e["key"], e["value"]) for e in (g["corrections"] or [])) if g else ()
    return Decision(
        table=table,
        strategy=g["strategy"] if g else None,
        filter_condition=g["silver_filter_condition"] if g else None,
        corrections=corrections,
        drift_severity=d["overall_severity"] if d else None,
    )


def read_decisions(guardian_ctrl: DataFrame, drift_ctrl: DataFrame, tables: list[str]) -> dict[str, Decision]:
    """``read_decision`` for several tables with one read per control table:
    the latest row of each wanted table (one row per table) is collected."""
    wanted = list(tables)
    g_rows = {
        r["table_name"]: r
        for r in parse_guardian(latest_control(guardian_ctrl.filter(F.col("table_name").isin(wanted)))).collect()
    }
    d_rows = {
        r["table_name"]: r
        for r in parse_drift(latest_control(drift_ctrl.filter(F.col("table_name").isin(wanted)))).collect()
    }
    out = {}
    for t in wanted:
        g, d = g_rows.get(t), d_rows.get(t)
        out[t] = Decision(
            table=t,
            strategy=g["strategy"] if g else None,
            filter_condition=g["silver_filter_condition"] if g else None,
            corrections=tuple((e["key"], e["value"]) for e in (g["corrections"] or [])) if g else (),
            drift_severity=d["overall_severity"] if d else None,
        )
    return out
