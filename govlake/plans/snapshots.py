"""Two snapshots of each feed, for drift and quality history.

Snapshot 1 is the state of the feeds as of an earlier day (orders placed
before the cut-off, and the payments, refunds and customers of those orders);
snapshot 2 is everything. Both are derived by Spark from the full tables, so
the history grows with the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import DATASETS
from govlake.operators import profile

CUTOFF = "1998-05-01"
TABLE_ORDER = tuple(f.name for f in DATASETS)


def as_of(entities: dict[str, DataFrame], cutoff: str = CUTOFF) -> dict[str, DataFrame]:
    """The feeds as they stood before ``cutoff`` (semi-joins on the early orders)."""
    orders = entities["orders"].filter(F.col("order_date") < F.lit(cutoff).cast("timestamp_ntz"))
    early = orders.select("order_id")
    return {
        "orders": orders,
        "customers": entities["customers"].join(orders.select("customer_id"), "customer_id", "left_semi"),
        "payments": entities["payments"].join(early, "order_id", "left_semi"),
        "refunds": entities["refunds"].join(early, "order_id", "left_semi"),
    }


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def snapshot_metrics(snap: dict[str, DataFrame], captured_at: _dt.datetime, previous: DataFrame | None = None) -> DataFrame:
    """One run of the drift profiler: the metrics of every feed, stamped.

    ``previous`` are the metrics of the run before, whose largest values are counted again."""
    return union_all([profile.stamp(profile.drift_metrics(snap[t], t, previous=previous), captured_at) for t in TABLE_ORDER])


def snapshot_quality(snap: dict[str, DataFrame], captured_at: _dt.datetime) -> DataFrame:
    """One run of the guardian profiler: column metrics of every feed, stamped."""
    return union_all([profile.stamp(profile.column_profile(snap[t], t), captured_at) for t in TABLE_ORDER])


def compact(df: DataFrame) -> DataFrame:
    """Merge the many small partitions a union of per-table metric frames
    has (no shuffle), down to the session's shuffle parallelism: metric
    tables are schema-sized, not data-sized."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, n))
