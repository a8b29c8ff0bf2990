"""Arc tables: encoding, decoding, extents, lines and the stored topology rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from .topology import Topology, Transform, neighbours, signed_ref


def delta_encode(arcs: DataFrame, transform: Transform) -> DataFrame:
    """Absolute coordinates to quantised differences: arc_id, pos, dx, dy; z, if any, stays absolute."""

    def step(axis: str) -> str:
        before = f"if(i = 0, 0L, {transform.encode(axis, f'points[i - 1].{axis}')})"
        return f"{transform.encode(axis, f'p.{axis}')} - {before}"

    has_z = "z" in arcs.schema["points"].dataType.elementType.names
    z = ", 'z', p.z" if has_z else ""
    deltas = f"transform(points, (p, i) -> named_struct('dx', {step('x')}, 'dy', {step('y')}{z}))"
    return arcs.selectExpr("arc_id", f"posexplode_outer({deltas}) AS (pos, d)").selectExpr(
        "arc_id", "pos", "d.*"
    )


def delta_decode(deltas: DataFrame, transform: Transform) -> DataFrame:
    """Running sums of the differences back to coordinates: arc_id, pos, x, y, and z if there is one."""
    z = [c for c in deltas.columns if c == "z"]
    along = Window.partitionBy("arc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = deltas.select(
        "arc_id", "pos", F.sum("dx").over(along).alias("qx"), F.sum("dy").over(along).alias("qy"), *z
    )
    return summed.selectExpr(
        "arc_id", "pos", f"{transform.decode('x', 'qx')} AS x", f"{transform.decode('y', 'qy')} AS y", *z
    )


def arc_bbox(arcs: DataFrame) -> DataFrame:
    """Extent per arc over absolute coordinates."""
    return arcs.selectExpr("arc_id", *g.bbox("points"))


def arc_lines(arcs: DataFrame) -> DataFrame:
    """Line table: end points, number of vertices and length of each arc."""
    length = (
        f"aggregate({g.path_edges('points')}, 0.0D, (acc, e) -> acc"
        " + sqrt(double((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))))"
    )
    return arcs.selectExpr(
        "arc_id", "points[0].x AS x_start", "points[0].y AS y_start",
        "element_at(points, -1).x AS x_end", "element_at(points, -1).y AS y_end",
        "size(points) AS n_points", f"{length} AS length", "points",
    )


def topology_rows(topology: Topology, properties: tuple[str, ...] = ("gid", "type")) -> DataFrame:
    """The stored form of a topology: (kind, id, data) with JSON data.

    Kinds are arc, entity, transform and neighbours; partition the sink by ``kind``.
    """
    t = topology.transform
    has_z = "z" in topology.arcs.schema["points"].dataType.elementType.names
    z = ", p.z" if has_z else ""
    qx, qy = ("p.x - if(i = 0, p.x - p.x, points[i - 1].x)",
              "p.y - if(i = 0, p.y - p.y, points[i - 1].y)") if t else ("p.x", "p.y")
    arcs = topology.arcs.selectExpr(
        "'arc' AS kind", "arc_id AS id",
        f"to_json(transform(points, (p, i) -> array({qx}, {qy}{z}))) AS data",
    )
    return arcs.unionByName(other_rows(topology, topology.ring_arcs, properties))


def other_rows(topology: Topology, ring_arcs: DataFrame, properties: tuple[str, ...]) -> DataFrame:
    """The rows of the kinds entity, neighbours and transform; ``ring_arcs`` may be raised ones."""
    t, named = topology.transform, list(properties)
    refs = (
        ring_arcs.groupBy("entity_id", *named, "ring")
        .agg(F.expr(f"array_sort(collect_list(struct(pos, {signed_ref()} AS ref))) AS refs"))
        .groupBy("entity_id", *named)
        .agg(F.expr("array_sort(collect_list(struct(ring, transform(refs, r -> r.ref) AS refs))) AS rs"))
    )
    fields = ", ".join(f"'{p}', {p}" for p in named)
    entities = refs.selectExpr(
        "'entity' AS kind", "entity_id AS id",
        "to_json(named_struct('type', 'Polygon', 'arcs', transform(rs, r -> r.refs),"
        f" 'properties', named_struct({fields}))) AS data",
    )
    lists = (
        neighbours(ring_arcs, topology.entities)
        .groupBy("entity_id")
        .agg(F.expr("to_json(array_sort(collect_list(neighbour_id))) AS data"))
        .selectExpr("'neighbours' AS kind", "entity_id AS id", "data")
    )
    rows = entities.unionByName(lists)
    if t:
        one = ring_arcs.sparkSession.range(1).selectExpr(
            "'transform' AS kind", "1L AS id",
            f"to_json(named_struct('scale', array({t.kx!r}D, {t.ky!r}D),"
            f" 'translate', array({t.dx!r}D, {t.dy!r}D))) AS data",
        )
        rows = rows.unionByName(one)
    return rows
