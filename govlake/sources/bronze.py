"""Bronze tables: the four feeds written once as parquet and read back.

In the medallion layout bronze is a stored dataset that several jobs read
(profiles, drift, guardian, silver). Writing it once into the cluster's
shared folder (``spark.checkpoint.dir``) cuts the lineage: later plans scan
columnar files with pruning and pushdown instead of re-deriving the feeds,
and a lost executor only costs the re-read of its files.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from govlake.session import checkpoint_dir
from govlake.sources import tables

#: Raised whenever the mapping of the feeds or a stored profile changes.
BRONZE_VERSION = "2"

_CACHE: dict[tuple, dict[str, DataFrame]] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


SOURCE_TABLES = ("customer", "nation", "orders", "lineitem")


def source_signature(spark: SparkSession, sf_dir: str) -> str:
    """Path plus size and modification time of every input file (a metadata
    listing, as the scan itself does): stored tables derived from changed
    inputs get a new folder instead of being reused stale."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = [os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir, BRONZE_VERSION]
    for name in SOURCE_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(conf)
        files = fs.listFiles(p, True)
        total, latest = 0, 0
        while files.hasNext():
            st = files.next()
            total += st.getLen()
            latest = max(latest, st.getModificationTime())
        parts.append(f"{name}:{total}:{latest}")
    return "|".join(parts)


def bronze_root(spark: SparkSession, sf_dir: str) -> str:
    key = hashlib.sha1(source_signature(spark, sf_dir).encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/govlake-bronze/{key}"


def stored_table(spark: SparkSession, name: str, build, key: str, *settings) -> DataFrame:
    """A derived table written once under the shared folder and read back.

    ``build`` is called only when the table is missing; the folder is keyed
    by the signature of the data directory's files, the version and the
    ``settings`` the table depends on (a cut-off day, a column list), so later
    jobs and later sessions on the same cluster folder reuse it.
    """
    path = stored_path(spark, name, key, *settings)
    if not _exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stored_path(spark: SparkSession, name: str, key: str, *settings) -> str:
    """Where a derived table of a data directory is stored."""
    digest = hashlib.sha1(f"{source_signature(spark, key)}|{name}|{settings!r}".encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/govlake-tables/{name}-{digest}"


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four bronze feeds, written on first use and then read from files."""
    sc = spark.sparkContext
    cache_key = (sc.applicationId, sc.startTime, source_signature(spark, sf_dir))
    if cache_key in _CACHE:
        return dict(_CACHE[cache_key])
    root = bronze_root(spark, sf_dir)
    out = {}
    for name, df in tables.entities(spark, sf_dir).items():
        path = f"{root}/{name}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    _CACHE[cache_key] = out
    return dict(out)
