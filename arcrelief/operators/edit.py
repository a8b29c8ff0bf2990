"""Topology edits: dissolving by key and simplifying arcs."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..session import materialise
from .spatial import points_in_polygons
from .topology import Topology


def dissolve_boundary(ring_arcs: DataFrame, key: str) -> DataFrame:
    """Arcs with entities of a key value on one side only, whatever number of them.

    ``backward`` tells the walking direction that has the inside on the left.  A NULL key
    is a group of its own.
    """
    return (
        ring_arcs.groupBy(key, "arc_id")
        .agg(
            F.count_if(F.expr("reversed = interior_left")).alias("n_right"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n_right = 0 OR n_right = n")
        .selectExpr(key, "arc_id", "n_right > 0 AS backward")
    )


def uncovered(boundary: DataFrame, topology: Topology, key: str) -> DataFrame:
    """``boundary`` without the arcs that run inside another entity of the same key value.

    Where entities overlap, arcs of one lie inside others: beside them both sides are covered.
    One point of each arc decides, as borders only meet at common vertices.  The test
    is a join on grid cells; entities that use an arc don't count for it.
    """
    middle = boundary.join(topology.arcs.select("arc_id", "points"), "arc_id").selectExpr(
        f"{key} AS _key", "arc_id",
        "(double(points[0].x) + points[1].x) / 2 AS x", "(double(points[0].y) + points[1].y) / 2 AS y",
    )
    entities = topology.entities.selectExpr("entity_id", f"{key} AS _entity_key", "rings")
    users = topology.ring_arcs.select("entity_id", "arc_id").distinct()
    inside = (
        points_in_polygons(middle, entities, ["entity_id", "_entity_key"])
        .filter("_key <=> _entity_key")
        .join(users, ["entity_id", "arc_id"], "left_anti")
        .selectExpr("_key", "arc_id AS _arc").distinct()
    )
    return boundary.join(inside, F.expr(f"{key} <=> _key AND arc_id = _arc"), "left_anti")


def boundary_size(boundary: DataFrame, arcs: DataFrame, by: list[str]) -> DataFrame:
    """Number of arcs, vertices, length and twice the area inside, per group."""
    edges = g.path_edges("points")
    measured = boundary.join(arcs.select("arc_id", "points"), "arc_id").selectExpr(
        *by, "size(points) - 1 AS n",
        f"aggregate({edges}, 0.0D, (acc, e) -> acc + sqrt(double({g.dist2('e.x1', 'e.y1', 'e.x2', 'e.y2')}))) AS l",
        f"if(backward, -1, 1) * aggregate({edges}, points[0].x - points[0].x,"
        " (acc, e) -> acc + e.x1 * e.y2 - e.x2 * e.y1) AS a",
    )
    return measured.groupBy(*by).agg(
        F.expr("count(*) AS n_arcs"), F.expr("sum(n) AS n_vertices"),
        F.expr("sum(l) AS length"), F.expr("sum(a) AS double_area"),
    )


def dissolve(ring_arcs: DataFrame, arcs: DataFrame, key: str) -> DataFrame:
    """Boundary rings per key value of entities that don't overlap: key, ring, pos, arc_id,
    backward."""
    return stitch(dissolve_boundary(ring_arcs, key), arcs, key)


def stitch(boundary: DataFrame, arcs: DataFrame, key: str) -> DataFrame:
    """Boundary arcs (key, arc_id, backward) put together to rings: ring and pos are added.

    Every boundary arc knows its follower at its end point: the first one clockwise, which
    keeps to the same piece of the inside where several meet.  Followers form rings; the
    smallest arc id names a ring.  Pointer doubling finds it, and the distance to it, in
    about log2(longest ring) joins on unique keys, so one key value may own any share of
    the rows.
    """
    state = materialise(_followers(boundary, arcs, key))
    state = state.selectExpr(
        f"{key} AS k", "arc_id", "backward", "follower AS ptr", "arc_id AS ring", "0L AS ahead",
        "1L AS span",
    )
    while True:
        other = state.selectExpr(
            "k AS ok", "arc_id AS oid", "ptr AS optr", "ring AS oring", "ahead AS oahead",
            "span AS ospan",
        )
        # where borders don't close, a chain ends: its arcs keep what they have found so far
        state = materialise(
            state.join(other, F.expr("k <=> ok AND ptr = oid"), "left").selectExpr(
                "k", "arc_id", "backward", "optr AS ptr",
                "least(ring, oring) AS ring",
                "if(coalesce(oring < ring, false), span + oahead, ahead) AS ahead",
                "span + coalesce(ospan, 0L) AS span", "coalesce(oring < ring, false) AS moved",
            )
        )
        if state.filter("moved").isEmpty():
            break
    length = state.groupBy("k", "ring").agg(F.count(F.lit(1)).alias("n"))
    return state.join(
        length.selectExpr("k AS nk", "ring AS nring", "n"), F.expr("k <=> nk AND ring = nring")
    ).selectExpr(f"k AS {key}", "ring", "int((n - ahead) % n) AS pos", "arc_id", "backward")


def dissolve_polygons(topology: Topology, key: str) -> DataFrame:
    """Polygons with holes per key value: key, polygon, is_hole, ring, double_area, line.

    A row for each ring of the union of a key value's entities, which may touch, overlap, be
    nested or be equal; where they overlap, their borders must meet at common vertices.
    ``polygon`` is the ring (the smallest arc id) of the outer border.  Outer rings run
    counter-clockwise, holes clockwise, both with the inside on their left; a hole belongs to the
    smallest outer ring around it.  ``line`` is an open array of points in the topology's coordinates.
    Rings are rows of their own, so a polygon may have any number of holes; ``polygon_rows``
    gathers them.  A hole that no ring surrounds (borders that don't close) has a NULL polygon.
    """
    arcs = materialise(topology.arcs.select("arc_id", "points"))
    boundary = materialise(uncovered(dissolve_boundary(topology.ring_arcs, key), topology, key))
    pieces = stitch(boundary, arcs, key).join(arcs, "arc_id").selectExpr(
        key, "ring", "pos",
        "slice(if(backward, reverse(points), points), 1, size(points) - 1) AS line",
    )
    rings = materialise(
        pieces.groupBy(key, "ring")
        .agg(F.expr("flatten(transform(array_sort(collect_list(struct(pos, line))), s -> s.line)) AS line"))
        .selectExpr(key, "ring", "line", f"{g.double_area('line')} AS double_area")
    )
    outer = rings.filter("double_area > 0")
    holes = rings.filter("double_area <= 0")
    probes = holes.selectExpr(
        f"{key} AS _key", "ring AS hole",
        "(double(line[0].x) + line[1].x) / 2 AS x", "(double(line[0].y) + line[1].y) / 2 AS y",
    )
    around = outer.selectExpr(f"{key} AS _outer_key", "ring AS _outer", "double_area AS _area", "array(line) AS rings")
    nested = (
        points_in_polygons(probes, around, ["_outer_key", "_outer", "_area"])
        .filter("_key <=> _outer_key")
        .groupBy("_key", "hole").agg(F.expr("min(named_struct('a', _area, 'o', _outer)).o AS polygon"))
    )
    placed = holes.join(nested, F.expr(f"{key} <=> _key AND ring = hole"), "left")
    out = [key, "polygon", "is_hole", "ring", "double_area", "line"]
    return (
        outer.selectExpr("*", "ring AS polygon", "false AS is_hole").select(*out)
        .unionByName(placed.selectExpr(*rings.columns, "polygon", "true AS is_hole").select(*out))
    )


def polygon_rows(rings: DataFrame, key: str) -> DataFrame:
    """One row per polygon of ``dissolve_polygons``: key, polygon, rings (outer first), double_area."""
    return rings.filter("polygon IS NOT NULL").groupBy(key, "polygon").agg(
        F.expr("transform(array_sort(collect_list(struct(is_hole, ring, line))), r -> r.line) AS rings"),
        F.expr("sum(double_area) AS double_area"),
    )


def _followers(boundary: DataFrame, arcs: DataFrame, key: str) -> DataFrame:
    directed = boundary.join(arcs.select("arc_id", "points"), "arc_id").selectExpr(
        key, "arc_id", "backward", "if(backward, reverse(points), points) AS p"
    )

    def angle(a: str, b: str) -> str:
        return f"atan2(double({b}.y - {a}.y), double({b}.x - {a}.x))"

    last, before = "element_at(p, -1)", "element_at(p, -2)"
    ends = directed.selectExpr(
        key, "backward",
        "explode_outer(array("
        f"named_struct('x', p[0].x, 'y', p[0].y, 'turn', {angle('p[0]', 'p[1]')},"
        " 'leaves', arc_id, 'arrives', CAST(NULL AS BIGINT)),"
        f"named_struct('x', {last}.x, 'y', {last}.y, 'turn', {angle(last, before)},"
        " 'leaves', CAST(NULL AS BIGINT), 'arrives', arc_id))) AS e",
    ).selectExpr(key, "backward", "e.*")
    node = Window.partitionBy(key, "x", "y").orderBy(F.col("turn").desc())
    after = node.rowsBetween(1, Window.unboundedFollowing)
    whole = node.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(
        F.first("leaves", ignorenulls=True).over(after),
        F.first("leaves", ignorenulls=True).over(whole),
    )
    return (
        ends.withColumn("follower", following)
        .filter("arrives IS NOT NULL")
        .selectExpr(key, "arrives AS arc_id", "backward", "follower")
    )


def vertex_effective_area(arcs: DataFrame) -> DataFrame:
    """Triangle area of each inner arc vertex with its two neighbours."""
    area = (
        "abs((points[i - 1].x - points[i + 1].x) * (p.y - points[i - 1].y)"
        " - (points[i - 1].x - p.x) * (points[i + 1].y - points[i - 1].y)) / 2"
    )
    ends = "i = 0 OR i = size(points) - 1"
    return (
        arcs.selectExpr(
            "arc_id",
            f"posexplode_outer(transform(points, (p, i) -> if({ends}, CAST(NULL AS DOUBLE), {area})))"
            " AS (pos, area)",
        )
        .filter("area IS NOT NULL")
    )


def weigh_arcs(arcs: DataFrame) -> DataFrame:
    """Adds ``weights`` to arcs (arc_id, points): the effective area of each vertex, infinite at the ends.

    Areas are those of repeated removal of the least triangle (Visvalingam and Whyatt).  Points
    pass through the same Arrow batches, nothing is shuffled or joined.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(1)
            sizes = points.value_lengths().to_numpy()
            flat = points.flatten()
            xs, ys = (flat.field(a).to_numpy(zero_copy_only=False).astype(float) for a in "xy")
            weights = _weights_of(xs, ys, sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), points, weights],
                ["arc_id", "points", "weights"])

    kind = arcs.schema["points"].dataType.simpleString()
    return arcs.select("arc_id", "points").mapInArrow(
        weigh, f"arc_id BIGINT, points {kind}, weights ARRAY<DOUBLE>")


def simplify_arcs(arcs: DataFrame, min_area: float) -> DataFrame:
    """Removes arc vertices whose effective area is below ``min_area``; ends stay.

    Arcs are simplified alone, so a small ring may be left with fewer than three vertices;
    ``simplify_topology`` guards rings.
    """
    return weigh_arcs(arcs).selectExpr(
        "arc_id", f"filter(points, (p, i) -> weights[i] >= {float(min_area)!r}D) AS points")


def simplify_topology(topology: Topology, min_area: float) -> Topology:
    """The topology with simplified arcs, no ring of which has fewer than three vertices.

    Where the arcs of a ring would keep less, the ring keeps its heaviest vertices besides
    (by weight, then arc and position), and the arcs keep them for all their rings.  An arc
    brings at most two such vertices to a ring, so nothing grows with an arc's length.
    Points keep all their fields.
    """
    least = f"{float(min_area)!r}D"
    weighed = materialise(weigh_arcs(topology.arcs))
    light = f"filter(transform(weights, (w, i) -> named_struct('w', -w, 'pos', i)), v -> -v.w < {least})"
    kept = weighed.selectExpr(
        "arc_id", f"size(filter(weights, w -> w >= {least})) - 1 AS n_left",
        f"slice(array_sort({light}), 1, 2) AS spare")
    rings = (
        topology.ring_arcs.select("entity_id", "part", "ring", "arc_id").join(kept, "arc_id")
        .groupBy("entity_id", "part", "ring")
        .agg(F.sum("n_left").alias("n_left"),
             F.expr("flatten(collect_set(transform(spare, s ->"
                    " named_struct('w', s.w, 'arc_id', arc_id, 'pos', s.pos)))) AS spare"))
        .filter("n_left < 3")
    )
    guarded = (
        rings.selectExpr("explode(slice(array_sort(spare), 1, int(3 - n_left))) AS s")
        .groupBy("s.arc_id").agg(F.expr("collect_set(s.pos) AS guarded"))
    )
    arcs = weighed.join(guarded, "arc_id", "left").selectExpr(
        "arc_id",
        f"filter(points, (p, i) -> weights[i] >= {least} OR coalesce(array_contains(guarded, i), false)) AS points")
    return replace(topology, arcs=materialise(arcs))


_TOGETHER = 32  # vertices of arcs that are weighed together


def _weights_of(xs: np.ndarray, ys: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """``_weights`` of arcs that follow each other; short arcs of one size are weighed together."""
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    weights = np.full(len(xs), np.inf)
    plain = np.ones(len(xs) + 1, bool)
    plain[:-1] = (np.abs(xs) < 1e100) & (np.abs(ys) < 1e100)  # not so for unknown numbers
    odd = np.concatenate([[0], np.cumsum(~plain[:-1])])
    together = (sizes <= _TOGETHER) & (odd[starts[1:]] == odd[starts[:-1]])
    for n in np.unique(sizes[together & (sizes > 2)]):
        chosen = starts[:-1][together & (sizes == n)]
        at = chosen[:, None] + np.arange(n)
        weights[at] = _weights_together(xs[at], ys[at])
    for i in np.flatnonzero(~together & (sizes > 2)):
        a, b = starts[i], starts[i + 1]
        weights[a:b] = _weights(xs[a:b].tolist(), ys[a:b].tolist())
    return pa.ListArray.from_arrays(starts, pa.array(weights))


def _weights_together(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    m, n = xs.shape
    rows = np.arange(m)
    left, right = (np.tile(np.arange(n) + step, (m, 1)) for step in (-1, 1))
    weight, current = np.full((m, n), np.inf), np.full((m, n), np.inf)

    def area(some: np.ndarray, i: np.ndarray) -> np.ndarray:
        a, c = left[some, i], right[some, i]
        xa, ya = xs[some, a], ys[some, a]
        return np.abs((xa - xs[some, c]) * (ys[some, i] - ya) - (xa - xs[some, i]) * (ys[some, c] - ya)) / 2

    for i in range(1, n - 1):
        current[:, i] = area(rows, np.full(m, i))
    largest = np.zeros(m)
    for _ in range(n - 2):
        i = current.argmin(axis=1)
        largest = weight[rows, i] = np.maximum(largest, current[rows, i])
        current[rows, i] = np.inf
        before, after = left[rows, i], right[rows, i]
        right[rows, before], left[rows, after] = after, before
        for j in (before, after):
            some = np.flatnonzero(current[rows, j] < np.inf)
            current[some, j[some]] = area(some, j[some])
    return weight


def _weights(xs, ys) -> list[float]:
    """Effective area per vertex; the two ends are infinite."""
    n = len(xs)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    weight = [float("inf")] * n

    def area(i: int) -> float:
        a, c = left[i], right[i]
        return abs((xs[a] - xs[c]) * (ys[i] - ys[a]) - (xs[a] - xs[i]) * (ys[c] - ys[a])) / 2

    current = {i: area(i) for i in range(1, n - 1)}
    queue = [(w, i) for i, w in current.items()]
    heapq.heapify(queue)
    largest = 0.0
    while queue:
        w, i = heapq.heappop(queue)
        if current.get(i) != w:
            continue
        del current[i]
        largest = weight[i] = max(largest, w)
        right[left[i]], left[right[i]] = right[i], left[i]
        for j in (left[i], right[i]):
            if j in current:
                current[j] = area(j)
                heapq.heappush(queue, (current[j], j))
    return weight
