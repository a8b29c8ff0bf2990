"""Rings and polygons put together again from arcs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g

ENTITY = ["entity_id", "source", "gid", "part", "type"]


def rings(ring_arcs: DataFrame, arcs: DataFrame) -> DataFrame:
    """One open ring line per (entity, ring), in ring order whatever the row order.

    The last vertex of each arc is the first of the next one and is left out.  A group is
    one ring of one source row.
    """
    oriented = ring_arcs.join(arcs.select("arc_id", "points"), "arc_id").selectExpr(
        *ENTITY, "ring", "pos",
        "slice(if(reversed, reverse(points), points), 1, size(points) - 1) AS line",
    )
    return oriented.groupBy(*ENTITY, "ring").agg(
        F.expr("flatten(transform(array_sort(collect_list(struct(pos, line))), s -> s.line)) AS line")
    )


def polygons(ring_arcs: DataFrame, arcs: DataFrame) -> DataFrame:
    """One row per entity with its rings, outer ring first, and the source gid kept."""
    return rings(ring_arcs, arcs).groupBy(*ENTITY).agg(
        F.expr("transform(array_sort(collect_list(struct(ring, line))), r -> r.line) AS rings")
    )


def outer_polygons(ring_arcs: DataFrame, arcs: DataFrame) -> DataFrame:
    """Entities reduced to their outer ring; holes are ignored."""
    return rings(ring_arcs.filter("ring = 0"), arcs).selectExpr(*ENTITY, "array(line) AS rings")


def polygon_vertices(df: DataFrame, keys: list[str], closed: bool = False) -> DataFrame:
    """Vertex table of polygons: keys, ring, pos and the fields of the points."""
    line = g.close_ring("line") if closed else "line"
    return (
        df.selectExpr(*keys, "posexplode_outer(rings) AS (ring, line)")
        .selectExpr(*keys, "ring", f"posexplode_outer({line}) AS (pos, p)")
        .selectExpr(*keys, "ring", "pos", "p.*")
    )
