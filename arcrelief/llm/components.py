"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the component's least node.

    Each round links every neighbour of a node first to the least node around it (large
    star), then does so among smaller neighbours only (small star), until nothing changes.
    Minima are combined before they are shuffled, no neighbours are gathered, and the edges
    of a round are a written table.  No edges give no rows.
    """
    now = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct())
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = staged(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = staged(
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", "m")).distinct(), "edges")
