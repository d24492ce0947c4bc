"""Spark session and lineage helpers.

Every operator in this package is a lazy ``DataFrame -> DataFrame`` function;
the only places that need the session itself are sources, sinks and the
lineage cut below.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans shuffles at run time (coalescing
# small partitions, splitting skewed join partitions, switching a join to
# broadcast when a side turns out small), and timestamps are pinned to UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "corpusflow",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so on a cluster the submitter decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: ``spark.checkpoint.dir``.

    Only a session inside one process (``local[n]``, as in tests) may leave it
    unset and gets a private folder; executors of a cluster could not see one,
    so there an unset folder is an error.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder; it survives the
    loss of executors because the data lives there, not in their memory."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Batches to Python workers of ``rows`` rows and ``size`` bytes at most, so that what
    a worker holds does not grow with the table."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
