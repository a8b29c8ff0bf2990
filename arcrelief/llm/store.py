"""Tables in and tables between: inputs by name and stages in the shared scratch folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Without that setting a local session gets a temporary folder of its own (tests); a
    cluster session is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = "file://" + tempfile.mkdtemp(prefix="arcrelief-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/arcrelief-{app}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the scratch folder and read back.

    What follows reads only the columns it needs, can't be recomputed differently after a
    lost executor, and starts without a partitioning, so that joins on hot keys shuffle both
    sides and stay open to skew splitting.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` whose tasks give freed memory back when they end.

    Workers live on between tasks, and what their allocators keep would add up on an executor.
    """

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(lean, schema)


def give_back() -> None:
    """Free pages of this process go back to the system, where the C library can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all stages of this application, once their results have been stored."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(
            f"{base.rstrip('/')}/arcrelief-{spark.sparkContext.applicationId}"
        )
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_rows(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (doc_id, text and others), thinned evenly by a hash where there are more than ``most``.

    For fitting on a sample: also where one labelled doc_id owns any number of rows, about
    ``most`` of them are used.  Only ids are read to count them.
    """
    n = rows.select("doc_id").count()
    if n <= most:
        return rows
    place = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 30))
    return rows.where(place < int((1 << 30) * most / n))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
