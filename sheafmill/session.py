"""Session helpers: a local session for tests, and lineage cuts on shared storage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 100_000


def local_session(cpus: str = "8", memory: str = "12g", partitions: int | None = None) -> SparkSession:
    """A ``local[n]`` session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sheafmill")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus).replace("*", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names it. Only a local master without that setting gets a
    temporary folder; on a cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        configured = tempfile.mkdtemp(prefix="sheafmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so later jobs neither replan nor recompute it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows allow; otherwise Spark shuffles or decides.

    Meant for narrow tables (one row per class, term or threshold). The rows are written to the
    checkpoint folder first, so that counting and joining do not compute them twice.
    """
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input comes in fewer pieces than that, such as one small file.

    An input of many pieces, as any large table is, is left as it comes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
