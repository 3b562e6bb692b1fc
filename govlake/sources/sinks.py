"""Sinks: materialise, append with a capture stamp, write a new table version
(A6-A9).

All writes go through the DataFrame writer, so each task writes its own
files and a lost executor only re-runs its tasks; a job that dies leaves no
``_SUCCESS`` marker and readers of the previous version are unaffected.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.operators.control import upsert_latest
from govlake.session import checkpoint_dir


def materialise(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet (A6/A8) and return the written table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_stamped(df: DataFrame, path: str, as_of: _dt.datetime, ts_col: str = "captured_at") -> DataFrame:
    """Append rows with a capture time (A7). The stamp is a literal so a rerun
    of the same batch writes the same values."""
    return materialise(df.withColumn(ts_col, F.lit(as_of).cast("timestamp")), path, mode="append")


#: Partition column of logs and histories: the stamp of the run that wrote a row.
RUN = "run"


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Append one run's rows to a log (A7), replacing what an earlier attempt of that run left."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run}")


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new version folder under ``root`` and return its path.

    Used for tables rewritten whole (control tables after an upsert): the
    version being read is never overwritten while it is read.
    """
    path = f"{root.rstrip('/')}/v-{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a written dataset is at ``path``, on whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column`` in the complete ``column=value`` folders of a path, by listing; none where nothing is written yet."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = [x.getPath().getName() for x in listed if x.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if path_exists(spark, f"{path}/{column}={v}/_SUCCESS"))


def latest_version_path(spark: SparkSession, root: str) -> str | None:
    """The newest complete version folder under ``root``; names sort by time."""
    if not path_exists(spark, root):
        return None
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    done = [s for s in sorted(x.getPath().toString() for x in listed) if path_exists(spark, f"{s}/_SUCCESS")]
    return done[-1] if done else None


def latest_version(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version of a table that is written whole."""
    path = latest_version_path(spark, root)
    return spark.read.parquet(path) if path else None


def upsert_table(current: DataFrame, updates: DataFrame, keys: list[str], ts: str, root: str) -> DataFrame:
    """MERGE-like upsert (A9) written as a new version; returns the new table."""
    path = write_version(upsert_latest(current, updates, keys, ts), root)
    return current.sparkSession.read.parquet(path)


def scratch_dir(spark, purpose: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/govlake-{purpose}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder as parquet and read it back: the plan
    restarts from files (columnar, prunable) instead of its lineage."""
    return materialise(df, scratch_dir(df.sparkSession, purpose))
