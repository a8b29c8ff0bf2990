"""Planar geometry as Spark SQL expressions.

Every function takes and returns SQL text for ``expr``, ``selectExpr`` and ``filter``.
Points are ``struct<x,y>``, rings are open arrays of points (no closing vertex), ring 0 of
a polygon is the outer one, edges are ``struct<x1,y1,x2,y2>``.  With integer coordinates
every predicate is exact.  A box is a prefix: ``box('b_')`` stands for the four columns
``b_xmin, b_ymin, b_xmax, b_ymax``.

Arrays that cannot be empty are exploded with the ``_outer`` forms throughout the package:
the plain forms make the optimizer add a ``size(...) > 0`` filter, which it pushes down with
the whole array expression inlined.
"""

from __future__ import annotations

SIDES = ("xmin", "ymin", "xmax", "ymax")


def box(prefix: str = "") -> dict[str, str]:
    return {k: prefix + k for k in SIDES}


def constant_box(values: tuple) -> dict[str, str]:
    return {k: str(v) for k, v in zip(SIDES, values)}


def rotate(array: str, start: str) -> str:
    """Cyclic rotation so that the element at 0-based ``start`` comes first."""
    return f"concat(slice({array}, {start} + 1, size({array})), slice({array}, 1, {start}))"


def ring_edges(ring: str) -> str:
    following = rotate(ring, "1")
    return (
        f"zip_with({ring}, {following}, (a, b) -> "
        "named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))"
    )


def polygon_edges(rings: str) -> str:
    return f"flatten(transform({rings}, ring -> {ring_edges('ring')}))"


def path_edges(points: str) -> str:
    """Edges of an open path of at least two points."""
    return (
        f"zip_with(slice({points}, 1, size({points}) - 1), slice({points}, 2, size({points}) - 1), "
        "(a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))"
    )


def close_ring(ring: str) -> str:
    return f"concat({ring}, slice({ring}, 1, 1))"


def bbox(points: str, prefix: str = "") -> list[str]:
    """Four select items with the extent of an array of points."""
    return [
        f"array_{agg}(transform({points}, p -> p.{axis})) AS {prefix}{axis}{agg}"
        for agg in ("min", "max") for axis in ("x", "y")
    ]


def edge_bbox(e: str) -> list[str]:
    return [
        f"{fn}({e}.{axis}1, {e}.{axis}2) AS {axis}{agg}"
        for agg, fn in (("min", "least"), ("max", "greatest")) for axis in ("x", "y")
    ]


def cross_to(e: str, px: str, py: str) -> str:
    """Twice the signed area of (edge start, edge end, point); > 0 = point on the left."""
    return (
        f"(({e}.x2 - {e}.x1) * ({py} - {e}.y1) - ({e}.y2 - {e}.y1) * ({px} - {e}.x1))"
    )


def double_area(ring: str) -> str:
    """Twice the signed ring area, counter-clockwise positive."""
    x0, y0 = f"{ring}[0].x", f"{ring}[0].y"
    return (
        f"aggregate({ring_edges(ring)}, {x0} - {x0}, (acc, e) -> acc"
        f" + (e.x1 - {x0}) * (e.y2 - {y0}) - (e.x2 - {x0}) * (e.y1 - {y0}))"
    )


def left_side(e: str, px: str, py: str) -> str:
    """Whether the point lies left of the edge's line, never undecided.

    A point on the line is moved by an infinitesimal (smaller in x than in y), which is
    the same rule as the half-open tests in ``crossings``.
    """
    c = cross_to(e, px, py)
    tie = f"({e}.x2 > {e}.x1 OR ({e}.x2 = {e}.x1 AND {e}.y2 < {e}.y1))"
    return f"({c} > 0 OR ({c} = 0 AND {tie}))"


def crossings(edges: str, px: str, py: str, rx: str, ry: str) -> str:
    """How many edges the path (px,py) -> (rx,py) -> (rx,ry) crosses."""
    corner = left_side("e", rx, py)
    along_x = f"((e.y1 <= {py}) != (e.y2 <= {py}) AND {left_side('e', px, py)} != {corner})"
    along_y = f"((e.x1 <= {rx}) != (e.x2 <= {rx}) AND {corner} != {left_side('e', rx, ry)})"
    return (
        f"aggregate({edges}, 0, (acc, e) -> acc + if({along_x}, 1, 0) + if({along_y}, 1, 0))"
    )


def dist2(ax: str, ay: str, bx: str, by: str) -> str:
    return f"(({ax} - {bx}) * ({ax} - {bx}) + ({ay} - {by}) * ({ay} - {by}))"


def edge_dist2(e: str, px: str, py: str) -> str:
    """Squared distance from a point to a closed edge (double)."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    along = f"(({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy})"
    length2 = f"({dx} * {dx} + {dy} * {dy})"
    c = f"double({cross_to(e, px, py)})"
    return (
        f"CASE WHEN {along} <= 0 THEN double({dist2(px, py, e + '.x1', e + '.y1')})"
        f" WHEN {along} >= {length2} THEN double({dist2(px, py, e + '.x2', e + '.y2')})"
        f" ELSE {c} * {c} / double({length2}) END"
    )


def min_edge_dist2(edges: str, px: str, py: str) -> str:
    return f"array_min(transform({edges}, e -> {edge_dist2('e', px, py)}))"


def on_edge(e: str, px: str, py: str) -> str:
    return (
        f"({cross_to(e, px, py)} = 0"
        f" AND {px} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2)"
        f" AND {py} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2))"
    )


def box_dist2(px: str, py: str, b: dict[str, str]) -> str:
    dx = f"double(greatest({b['xmin']} - {px}, 0, {px} - {b['xmax']}))"
    dy = f"double(greatest({b['ymin']} - {py}, 0, {py} - {b['ymax']}))"
    return f"({dx} * {dx} + {dy} * {dy})"


def box_far2(px: str, py: str, b: dict[str, str]) -> str:
    """Squared distance to the farthest corner of a box."""
    dx = f"double(greatest(abs({px} - {b['xmin']}), abs({px} - {b['xmax']})))"
    dy = f"double(greatest(abs({py} - {b['ymin']}), abs({py} - {b['ymax']})))"
    return f"({dx} * {dx} + {dy} * {dy})"


def boxes_overlap(a: dict[str, str], b: dict[str, str]) -> str:
    return (
        f"({a['xmin']} <= {b['xmax']} AND {b['xmin']} <= {a['xmax']}"
        f" AND {a['ymin']} <= {b['ymax']} AND {b['ymin']} <= {a['ymax']})"
    )


def edge_meets_box(e: str, b: dict[str, str]) -> str:
    """Closed edge against closed box: extents overlap and the corners are not all
    strictly on one side of the edge's line."""
    corners = ", ".join(
        cross_to(e, b[x], b[y]) for x in ("xmin", "xmax") for y in ("ymin", "ymax")
    )
    return (
        f"(least({e}.x1, {e}.x2) <= {b['xmax']} AND greatest({e}.x1, {e}.x2) >= {b['xmin']}"
        f" AND least({e}.y1, {e}.y2) <= {b['ymax']} AND greatest({e}.y1, {e}.y2) >= {b['ymin']}"
        f" AND least({corners}) <= 0 AND greatest({corners}) >= 0)"
    )


def edges_cross(a: str, b: str) -> str:
    """Two edges cross in the inside of both."""

    def apart(e: str, f: str) -> str:
        return (
            f"signum({cross_to(e, f + '.x1', f + '.y1')})"
            f" * signum({cross_to(e, f + '.x2', f + '.y2')}) < 0"
        )

    return f"({apart(a, b)} AND {apart(b, a)})"


def edges_meet(a: str, b: str) -> str:
    """Two closed edges share at least one point."""
    touches = [on_edge(p, f"{q}.x{i}", f"{q}.y{i}") for p, q in ((a, b), (b, a)) for i in (1, 2)]
    return f"({edges_cross(a, b)} OR {' OR '.join(touches)})"
