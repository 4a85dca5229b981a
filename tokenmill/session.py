"""Session helpers: a local session for tests/bench and the checkpoint folder rule.

On a cluster the checkpoint folder must be the shared one named by
``spark.checkpoint.dir``; we only make our own folder when that is unset and the
master is local (tests, bench, smoke runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tokenmill") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOKENMILL_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting it from ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh private folder; a cluster without a
    shared checkpoint folder is a configuration error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tokenmill-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/...) "
        "so lineage cuts survive executor loss")


BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches handed to Python by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
