"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Rows of a partition that learners read as a whole.
PARTITION_ROWS = 262_144
_local_dir: str | None = None


def build_session(master: str, shuffle_partitions: int, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(master).appName("innlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call sites per column expression only slow wide frames down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_dir
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="innlake-")
    return _local_dir


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable without replacing a set folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/checkpoints")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/innlake/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt by their key, in key order, to the given number of partitions, or more if they hold too many rows.

    For frames that are read many times by a learner that draws rows by their
    place: the same rows and number of partitions give the same model on any
    cluster. Without a number the rows stay as they are.
    """
    if partitions is None:
        return df
    partitions = max(partitions, -(-df.count() // PARTITION_ROWS))
    return df.repartition(partitions, key).sortWithinPartitions(key)
