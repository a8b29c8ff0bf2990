"""Triangle meshes of polygons and samples of the point cloud."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .delaunay import triangles_within
from .small_delaunay import triangles_of
from .spatial import patches_inside


def polygon_mesh(polygons: DataFrame, key: str) -> DataFrame:
    """Delaunay triangles of each polygon's vertices that lie within the polygon.

    One row per triangle: key, tri, corners (array of points, z carried; of vertices with
    one place the first in order counts).  A triangle is within when its centre is and no side of
    it crosses an edge.  Polygons of few vertices at whole numbers are triangulated together, the others
    one at a time, in time that grows little faster than their vertices, and nothing is shuffled.
    """
    placed = polygons.selectExpr(
        f"{key} AS _key", "array_sort(array_distinct(flatten(rings))) AS vs",
        "transform(rings, ring -> transform(ring, p -> named_struct('x', double(p.x), 'y', double(p.y)))) AS rings",
    ).selectExpr("_key", "vs", "transform(vs, p -> named_struct('x', double(p.x), 'y', double(p.y))) AS places", "rings")

    def triangulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _found(batch.column(2), batch.column(3))],
                ["_key", "vs", "found"])

    kinds = dict(placed.dtypes)
    triangles = placed.mapInArrow(
        triangulate, f"_key {kinds['_key']}, vs {kinds['vs']}, found ARRAY<ARRAY<INT>>")
    return triangles.selectExpr(
        f"_key AS {key}", "posexplode(transform(found, t -> transform(t, v -> vs[v]))) AS (tri, corners)")


def _found(places: pa.ListArray, rings: pa.ListArray) -> pa.ListArray:
    """Triangles of each polygon as place numbers; small polygons are triangulated together."""
    kind = pa.list_(pa.list_(pa.int32()))
    lines = rings.flatten()
    corners, vertices = places.flatten(), lines.flatten()
    if any(a.null_count for a in (places, rings, lines, corners, vertices)):
        return pa.array([_alone(p, r) for p, r in zip(places.to_pylist(), rings.to_pylist())], kind)
    n_places, n_rings, n_vertices = (
        a.value_lengths().to_numpy(zero_copy_only=False).astype(int) for a in (places, rings, lines))
    owner = np.repeat(np.arange(len(places)), n_places)
    ring = np.repeat(np.arange(len(lines)), n_vertices)
    ring_owner = np.repeat(np.arange(len(rings)), n_rings)
    xy = np.stack([
        np.concatenate([a.field(axis).to_numpy(zero_copy_only=False) for a in (corners, vertices)]) for axis in "xy"
    ], axis=1)
    owners = np.concatenate([owner, ring_owner[ring]])
    # rows of one polygon with one place are next to each other, places before ring vertices
    order = np.lexsort((xy[:, 1], xy[:, 0], owners))
    new = np.ones(len(order), bool)
    new[1:] = (owners[order][1:] != owners[order][:-1]) | (xy[order][1:] != xy[order][:-1]).any(axis=1)
    first = np.empty(len(order), int)
    first[order] = order[new][np.cumsum(new) - 1]
    is_point = first[:len(owner)] == np.arange(len(owner))
    own = np.flatnonzero(is_point)
    starts = np.searchsorted(owner[own], np.arange(len(places) + 1))  # of each polygon's points
    number = np.cumsum(is_point) - 1
    at = number[first[len(owner):]] if len(ring) else np.zeros(0, int)
    ends = np.cumsum(n_vertices)
    following = np.arange(len(ring)) + 1
    following[ends[n_vertices > 0] - 1] = (ends - n_vertices)[n_vertices > 0]
    edges = np.stack([at, at[following]], axis=1)
    proper = edges[:, 0] != edges[:, 1]
    edges, edge_owner = edges[proper], ring_owner[ring][proper]
    cuts = np.searchsorted(edge_owner, np.arange(len(places) + 1))
    polygons = [
        (xy[own[a:b]], edges[c:d] - a) for a, b, c, d in zip(starts[:-1], starts[1:], cuts[:-1], cuts[1:])]
    begins = np.searchsorted(owner, np.arange(len(places)))  # of each polygon's places
    parts, counts = [], []
    for i, triangles in enumerate(triangles_of(polygons)):
        if triangles is None:
            triangles = np.array(_alone(places[i].as_py(), rings[i].as_py()), int).reshape(-1, 3)
            parts.append(triangles)
        else:
            parts.append(own[starts[i] + triangles] - begins[i])
        counts.append(len(triangles))
    values = np.concatenate(parts).astype(np.int32).ravel() if parts else np.zeros(0, np.int32)
    inner = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, 3, dtype=np.int32), pa.array(values))
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), inner)


def _alone(places: list[dict], rings: list[list[dict]]) -> list[list[int]]:
    first: dict[tuple[float, float], int] = {}
    for i, p in enumerate(places):
        first.setdefault((p["x"], p["y"]), i)
    number = {place: n for n, place in enumerate(first)}
    own = list(first.values())
    triangles = triangles_within(list(first), [[number[p["x"], p["y"]] for p in ring] for ring in rings])
    return [[own[v] for v in t] for t in triangles]


def collect_mesh(mesh: DataFrame, key: str) -> DataFrame:
    """One collection of triangles per polygon."""
    return mesh.groupBy(key).agg(
        F.expr("transform(array_sort(collect_list(struct(tri, corners))), t -> t.corners) AS geom"),
        F.lit("topo").alias("type"),
    )


def points_in_box(points: DataFrame, patches: DataFrame, bounds: tuple) -> DataFrame:
    """Points of the patches (a stored table) that lie wholly inside a constant box."""
    return points.join(patches_inside(patches, bounds).select("patch_id"), "patch_id", "left_semi")
