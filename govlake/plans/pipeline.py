"""End-to-end flow: bronze -> guardian and drift decisions -> silver gate ->
policy decision -> gold rules -> fact -> KPIs -> signals -> insights.

A run leaves everything under one shared root:

* ``history/drift``, ``history/quality``, ``history/schema``: a partition per run;
  the drift rules, NULL spikes and schema drift compare with earlier runs. Bronze
  is profiled once a run: the quality history is read off the drift metrics
* ``log/guardian_audit``, ``log/guardian_events``, ``log/drift_audit``,
  ``log/quarantine``, ``log/failed_rules``: what a run found and decided, a
  partition per run; governance questions (O1-O3) are asked of these
* ``control/guardian``, ``control/drift``, ``control/policy``: one row per key,
  upserted; each upsert is a new version folder
* ``runs/<stamp>/routed/<table>``: silver and quarantine, written by one pass
  over bronze, partitioned by ``route``; nothing reads bronze after it
* ``runs/<stamp>/gold_quarantine/<table>``: silver rows that break a policy rule,
  with the rules they break
* ``runs/<stamp>/``: policy decision, fact, six KPI and insight tables

A partition of a run is named by the run's stamp and replaced whole, so a run that
is repeated, or was killed and starts again, leaves each row once.

The only driver reads are the small decision rows that choose each gate's
plan and the law document. Laws come from a law table.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake import config as C
from govlake.operators import control, drift, facts, gate, governance, kpis, policy, profile, quality
from govlake.plans import insights, signals
from govlake.plans.snapshots import compact, union_all
from govlake.sources.sinks import RUN, latest_version, materialise, partition_values, upsert_table, write_run, write_version

SILVER_ROUTE = "silver"


@dataclass
class PipelineResult:
    guardian_control: DataFrame
    drift_control: DataFrame
    policy_control: DataFrame
    silver: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    gold_quarantine: dict[str, DataFrame]
    fact: DataFrame
    kpi_daily: DataFrame
    kpis: dict[str, DataFrame]
    insights: DataFrame


class Store:
    """The datasets of a pipeline under one root."""

    def __init__(self, spark: SparkSession, root: str, as_of: _dt.datetime):
        self.spark, self.root, self.as_of = spark, root.rstrip("/"), as_of
        self.stamp = f"{as_of:%Y%m%dT%H%M%S}"
        self.run = f"{self.root}/runs/{self.stamp}"

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """This run's rows of a history (with their capture time); the history with them."""
        path = f"{self.root}/history/{name}"
        write_run(rows.withColumn("captured_at", F.lit(self.as_of).cast("timestamp")), path, self.stamp)
        return self.history(name)

    def history(self, name: str) -> DataFrame | None:
        """All runs of a history, this one and later ones excepted if it has not written yet."""
        path = f"{self.root}/history/{name}"
        runs = [r for r in partition_values(self.spark, path, RUN) if r <= self.stamp]
        return self.spark.read.parquet(*[f"{path}/{RUN}={r}" for r in runs]) if runs else None

    def before(self, name: str) -> DataFrame | None:
        """The run just before this one in a history."""
        path = f"{self.root}/history/{name}"
        runs = [r for r in partition_values(self.spark, path, RUN) if r < self.stamp]
        return self.spark.read.parquet(f"{path}/{RUN}={runs[-1]}") if runs else None

    def log(self, name: str, rows: DataFrame) -> None:
        """This run's rows of a log."""
        write_run(compact(rows), f"{self.root}/log/{name}", self.stamp)

    def upsert(self, name: str, rows: DataFrame, keys: list[str], ts: str) -> DataFrame:
        """Merge control rows into the current version of a control table."""
        root = f"{self.root}/control/{name}"
        current = latest_version(self.spark, root)
        if current is None:
            return self.spark.read.parquet(write_version(rows, root))
        return upsert_table(current, rows, keys, ts, root)

    def keep(self, name: str, rows: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return materialise(rows, f"{self.run}/{name}", partition_by=partition_by)


def _profile(store: Store, bronze: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One profile of bronze -> drift, quality and schema histories."""
    metrics = union_all([profile.drift_metrics(df, t, previous=store.before("drift")) for t, df in bronze.items()])
    drift_history = store.append("drift", compact(metrics))
    now = drift_history.where(F.col("captured_at") == F.lit(store.as_of))
    quality_history = store.append("quality", compact(profile.profile_of_metrics(now, {t: df.columns for t, df in bronze.items()})))
    schemas = union_all([quality.schema_snapshot(df, t, store.as_of).drop("captured_at") for t, df in bronze.items()])
    return drift_history, quality_history, store.append("schema", compact(schemas))


def _guardian(store: Store, bronze: dict[str, DataFrame], names: dict[str, str], nulls: DataFrame, schemas: DataFrame, pipeline_name: str) -> DataFrame:
    """All detections over bronze and the stored histories -> audit and event logs, control rows."""
    issues, decision = quality.guardian_run(bronze, schema_history=schemas, null_history=nulls)
    decision = store.keep("guardian_decision", compact(decision))
    audit = quality.guardian_audit(issues, decision, store.as_of, names)
    store.log("guardian_audit", audit)
    store.log("guardian_events", quality.guardian_events(audit, decision, pipeline_name, names))
    return store.upsert("guardian", quality.guardian_control(decision, store.as_of, names), ["table_name"], "updated_at")


def _drift(store: Store, history: DataFrame, bronze: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """Rules over pairs of the history's metrics -> audit log, control rows."""
    pairs = store.keep("drift_pairs", compact(drift.drift_pairs(history)))
    issues = drift.drift_issues(pairs)
    tables = store.spark.createDataFrame([(t,) for t in bronze], "table_name string")
    decision = drift.drift_decision(issues, tables)
    store.log("drift_audit", drift.drift_audit(issues, decision, store.as_of).replace(names, subset=["table_name"]))
    return store.upsert("drift", drift.drift_control(issues, decision, store.as_of, names), ["table_name"], "updated_at")


def _route(store: Store, bronze: dict[str, DataFrame], decisions: dict, names: dict[str, str]):
    """Silver and quarantine of every table, from one write each."""
    silver, quarantine = {}, {}
    for t, df in bronze.items():
        routed = store.keep(f"routed/{t}", gate.route(df, decisions[names[t]], store.as_of), ["route"])
        silver[t] = routed.where(F.col("route") == SILVER_ROUTE).drop("route").withColumnRenamed("stamped_at", "processed_at")
        quarantine[t] = routed.where(F.col("route") != SILVER_ROUTE).withColumnsRenamed(
            {"route": "quarantine_reason", "stamped_at": "quarantined_at"})
    store.log("quarantine", governance.quarantine_summary(quarantine_union(quarantine)))
    return silver, quarantine


def _policy(store: Store, silver: dict[str, DataFrame], laws: DataFrame, names: dict[str, str], pipeline_name: str) -> DataFrame:
    """Active laws x silver -> policy control row of this pipeline."""
    document = policy.read_policy(policy.active_laws(laws), "policy_json")
    decision = store.keep("policy_decision", policy.policy_decision(silver, document))
    row = policy.policy_control(policy.policy_decision_json(decision), pipeline_name, [names[t] for t in silver], store.as_of)
    return store.upsert("policy", row, ["pipeline_name"], "updated_timestamp")


def _gold_quarantine(store: Store, silver: dict[str, DataFrame], rules: list[dict]) -> dict[str, DataFrame]:
    """Silver rows that break a rule, with the names of the rules; rows per rule go to the log."""
    out = {}
    for t, df in silver.items():
        marked = policy.failed_rules(df, t, rules)
        out[t] = store.keep(f"gold_quarantine/{t}", marked.where(F.size("failed_rules") > 0))
    counts = [df.select(F.lit(t).alias("table_name"), F.explode("failed_rules").alias("rule_name")) for t, df in out.items()]
    store.log("failed_rules", union_all(counts).groupBy("table_name", "rule_name").agg(F.count(F.lit(1)).alias("failed_rows")))
    return out


DAILY_KPIS = ("daily_order_revenue", "payment_success_rate", "refund_rate", "discount_impact")


def _kpis(store: Store, inputs: list[DataFrame], rules: list[dict]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The day KPI of all figures and the six KPI tables, from one row per order:
    the same totals as over the fact, without reading its payments x refunds rows."""
    contributions = kpis.order_contributions(*inputs, rules)
    daily = store.keep("kpi_daily", kpis.kpi_daily_all_orders(contributions))
    out = {k: store.keep(f"kpi/{k}", compact(kpis.daily_kpi(daily, k))) for k in DAILY_KPIS}
    out["customer_lifetime_value"] = store.keep("kpi/customer_lifetime_value", kpis.kpi_customer_lifetime_value_orders(contributions))
    out["payment_method_performance"] = store.keep("kpi/payment_method_performance", kpis.kpi_payment_method_performance_orders(*inputs, rules))
    return daily, out


def run(
    bronze: dict[str, DataFrame],
    laws: DataFrame,
    root: str,
    as_of: _dt.datetime = C.DEFAULT_AS_OF,
    pipeline_name: str = "governed_sales",
) -> PipelineResult:
    """One run over the bronze feeds (by entity name); see the module text for what it leaves."""
    store = Store(next(iter(bronze.values())).sparkSession, root, as_of)
    names = {t: C.FEEDS_BY_NAME[t].bronze for t in bronze}
    metrics, nulls, schemas = _profile(store, bronze)
    guardian = _guardian(store, bronze, names, nulls, schemas, pipeline_name)
    drifts = _drift(store, metrics, bronze, names)
    decisions = control.read_decisions(guardian, drifts, list(names.values()))
    silver, quarantine = _route(store, bronze, decisions, names)
    laws_in_force = _policy(store, silver, laws, names, pipeline_name)
    rules = policy.read_policy(policy.latest_policy(laws_in_force, pipeline_name))["row_rules"]

    inputs = [silver[t] for t in ("orders", "customers", "payments", "refunds")]
    broken = _gold_quarantine(store, silver, rules)
    fact = store.keep("fact_orders", facts.fact_orders(*inputs, rules, as_of))
    daily, six = _kpis(store, inputs, rules)
    out = store.keep("insights", insights.daily_insights(signals.signals_from_kpi_all(daily), as_of))
    return PipelineResult(guardian, drifts, laws_in_force, silver, quarantine, broken, fact, daily, six, out)


def read_log(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A log over all runs; ``run`` is the stamp of the run that left a row."""
    return spark.read.option("inferSchema", False).parquet(f"{root}/log/{name}")


HISTORIES = ("drift", "quality", "schema")
LOGS = ("guardian_audit", "guardian_events", "drift_audit", "quarantine", "failed_rules")


def carry_over(spark: SparkSession, before: str, root: str) -> None:
    """Begin a root with the histories, logs and control tables of another."""
    for name in [f"history/{h}" for h in HISTORIES] + [f"log/{n}" for n in LOGS]:
        for r in partition_values(spark, f"{before}/{name}", RUN):
            write_run(spark.read.parquet(f"{before}/{name}/{RUN}={r}"), f"{root}/{name}", r)
    for name in ("guardian", "drift", "policy"):
        write_version(latest_version(spark, f"{before}/control/{name}").coalesce(1), f"{root}/control/{name}")


def quarantine_union(quarantine: dict[str, DataFrame]) -> DataFrame:
    """All quarantine outputs with a ``table_name`` column, common columns only."""
    common = ["quarantine_reason", "guardian_strategy", "drift_severity", "quarantined_at"]
    return union_all([q.select(F.lit(t).alias("table_name"), *common) for t, q in quarantine.items()])
