"""Session helpers. Library code never creates a session; tests, bench and the entry do."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


#: settings for a cluster session (the caller builds it). AQE starts from the initial number of shuffle
#: partitions (``PipelineConfig.shuffle_partitions``, see ``initial_partitions``), coalesces to the
#: advisory size and splits skewed join partitions, but never starts more than that number.
CLUSTER_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # the median features are quantile digests (ObjectHashAggregate); keep more accounts per
    # task in the hash map before falling back to a sort of the input (a few KB per account)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def initial_partitions(input_bytes: int, target_bytes: int = 256 << 20, least: int = 800) -> int:
    """Initial shuffle partitions for facts of this size: about ``target_bytes`` each."""
    return max(least, -(-input_bytes // target_bytes))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerscope") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on).

    ``spark.checkpoint.dir`` is set here only because a local test run has no cluster
    folder; on a cluster the session comes with it and this function is not used.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    active = SparkSession.getActiveSession()
    if active is None:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerscope-ckpt-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder for checkpoints and other intermediate data, which every executor must share.

    ``spark.checkpoint.dir`` of the session, else ``fallback`` (such as the run's work dir). A
    session that has neither gets a scratch folder if it runs in one local process; anything else
    is refused, as executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    chosen = sc.getConf().get("spark.checkpoint.dir", None) or fallback
    if not chosen:
        if not _one_process(sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        chosen = tempfile.mkdtemp(prefix="ledgerscope-ckpt-")
    sc.setCheckpointDir(chosen)
    return sc.getCheckpointDir() or chosen


def _one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
