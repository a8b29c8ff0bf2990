"""Session helpers: a local test session and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("arcrelief")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # keep CPU-heavy stages on small local data from collapsing into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder, which all executors share."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="arcrelief-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


#: Stage files are as large as their rows in memory, as the planner broadcasts by size on disk, and
#: in row groups of 8 MB, each of which a task of the next step can read alone.
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": 8 << 20}


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint; its size is estimated from the tables it came from."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the files.

    Used where a result is read more than once and must not change between the
    reads (row ids, unsettled searches); it also survives the loss of executors.  The files are
    Parquet, so that what follows is planned for their size, not for an estimate carried on from
    the first table, and is split for all cores, however few tasks wrote them.
    """
    return stage_table(df, "stage")


def stage_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder, read back with the same columns.

    For tables between the steps that are read by parts: what follows reads only the columns and
    partitions it needs, and filters reach the scan.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.options(**PLAIN)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
