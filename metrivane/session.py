"""Session helpers: the session for local runs and lineage cuts on shared storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "metrivane", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # small data on one machine: keep every core busy instead of merging to 1 MB partitions
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # staged tables are deleted when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; only a local master may fall back to /tmp."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        folder = tempfile.mkdtemp(prefix="metrivane-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage, so that several readers share one computation.

    Written with a reliable checkpoint: the blocks survive the loss of any executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
