"""Dense row ids without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition here


def with_dense_id(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Adds ids start, start + 1, ... in the order of the given columns.

    Rows are range partitioned and sorted in parallel; an id is the row number within its
    partition plus the rows of the partitions before.  The sorted rows are written to the
    checkpoint folder first, so that counts and rows cannot disagree.  The broadcast side
    has one row per partition.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    block = F.shiftright("_row", _ROW_BITS)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(block.alias("_block"))
        .count()
        .select("_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")
        .withColumn(
            name, F.col("_offset") + F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1) + start
        )
        .drop("_row", "_block", "_offset")
    )
