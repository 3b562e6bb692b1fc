"""Session helpers.

The library itself never creates a session: every operator takes DataFrames.
These helpers are for tests, the bench and the entry point.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "govlake") -> SparkSession:
    """A local session with the settings the tests and the bench use.

    ``spark.checkpoint.dir`` is only given a scratch value here, for local
    runs; on a cluster the session comes with the shared folder already set.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("GOVLAKE_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="govlake-ckpt-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only where it is unset in a local session (as in
    tests) is a scratch folder taken; on a cluster it must be set, as executors
    do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        current = tempfile.mkdtemp(prefix="govlake-ckpt-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
