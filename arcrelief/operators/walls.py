"""Walls between terrain and buildings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..session import materialise
from .nearest import BEST, TO_EDGE, nearest_in_group
from .topology import border_arcs


def shared_walls(
    terrain: DataFrame, buildings: DataFrame, terrain_keys: list[str], building_keys: list[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Stretches where a terrain border and a building border run along each other.

    Edges meet through grid cells, must lie on one line and overlap by more than a point.
    (x1, y1) to (x2, y2) follows the terrain edge; the vertices need not coincide.  With a
    ``tolerance`` the two edges may be that far apart at both ends of the stretch, which must be
    longer than it.  What counts is the stretch, so a long edge that turns away beyond a junction
    still fits a short one.  Without it the test is exact on whole numbers.
    """
    t = f"{float(tolerance)!r}D"

    def edges(df: DataFrame, keys: list[str], name: str, reach: str) -> DataFrame:
        flat = df.selectExpr(*keys, f"explode_outer({g.polygon_edges('rings')}) AS {name}")
        sides = [
            f"{fn}({name}.{axis}1, {name}.{axis}2) {sign} {reach} AS {axis}{agg}"
            for agg, fn, sign in (("min", "least", "-"), ("max", "greatest", "+")) for axis in ("x", "y")
        ]
        return flat.selectExpr("*", *(sides if tolerance else g.edge_bbox(name)))

    pairs = grid.extent_pairs(edges(terrain, terrain_keys, "e", t), edges(buildings, building_keys, "f", "0.0D"))

    def along(x: str, y: str) -> str:
        return f"(({x} - e.x1) * (e.x2 - e.x1) + ({y} - e.y1) * (e.y2 - e.y1))"

    def length(e: str) -> str:
        return f"sqrt(double({g.dist2(f'{e}.x1', f'{e}.y1', f'{e}.x2', f'{e}.y2')}))"

    def off(e: str, x: str, y: str) -> str:
        """Distance from a point to the edge's line, times the edge's length."""
        return f"abs(double({g.cross_to(e, x, y)}))"

    # plain numbers only, and a generator that keeps the filter behind them: the filter would else repeat
    # all of them for each of their uses
    numbers = {
        "d1": along("f.x1", "f.y1"), "d2": along("f.x2", "f.y2"), "d": along("e.x2", "e.y2"),
        "off1": off("e", "f.x1", "f.y1"), "off2": off("e", "f.x2", "f.y2"),
        "off3": off("f", "e.x1", "e.y1"), "off4": off("f", "e.x2", "e.y2"),
        "el": length("e"), "fl": length("f"),
    }
    fields = ", ".join(f"'{name}', {value}" for name, value in numbers.items())
    # an end of the stretch is a vertex of one edge; what counts is how far it is from the other one
    low, high = "least(d1, d2)", "greatest(d1, d2)"
    first = f"if({low} > 0, if(d2 < d1, off2, off1) <= {t} * el, off3 <= {t} * fl)"
    last = f"if({high} < d, if(d2 < d1, off1, off2) <= {t} * el, off4 <= {t} * fl)"
    stretch = f"(if({high} < d, {high}, d) - if({low} > 0, {low}, d - d))"

    def end(v: str, inner: str, swapped: str, straight: str, other: str) -> str:
        return f"if({inner}, if(d2 < d1, f.{v}{swapped}, f.{v}{straight}), e.{v}{other}) AS {v}{other}"

    return (
        pairs.select(*terrain_keys, *building_keys, "e", "f")
        .selectExpr("*", f"inline(array(named_struct({fields})))")
        .filter(f"{stretch} > 0 AND double({stretch}) > {t} * el AND {first} AND {last}")
        .selectExpr(
            *terrain_keys, *building_keys,
            end("x", f"{low} > 0", "2", "1", "1"), end("y", f"{low} > 0", "2", "1", "1"),
            end("x", f"{high} < d", "1", "2", "2"), end("y", f"{high} < d", "1", "2", "2"),
        )
    )


def wall_segments(arcs: DataFrame, ring_arcs: DataFrame, terrain: str, building: str) -> DataFrame:
    """Consecutive vertex pairs of the arcs between terrain and building entities.

    entity_a is the terrain entity, entity_b the building.
    """
    walls = border_arcs(ring_arcs, terrain, building)
    return (
        walls.join(arcs.select("arc_id", "points"), "arc_id")
        .selectExpr(
            "arc_id", "entity_a", "entity_b", f"posexplode_outer({g.path_edges('points')}) AS (pos, e)"
        )
        .selectExpr("arc_id", "entity_a", "entity_b", "pos", "e.*")
    )


def inset_rings(df: DataFrame, keys: list[str], distance: float) -> DataFrame:
    """Rings with every edge moved inward by a small distance and corners mitred.

    One row per ring: keys, ring, line.  The distance must be small against the polygon:
    narrow parts are not collapsed.
    """
    d = f"{float(distance)!r}D"
    length = f"sqrt(double({g.dist2('a.x', 'a.y', 'b.x', 'b.y')}))"
    normals = (
        f"zip_with(line, {g.rotate('line', '1')}, (a, b) ->"
        f" named_struct('x', (a.y - b.y) / {length}, 'y', (b.x - a.x) / {length}))"
    )
    # na, nb: left normals of the edges before and after the vertex
    scale = "(1 + na[i].x * nb[i].x + na[i].y * nb[i].y)"
    moved = ", ".join(
        f"'{v}', p.{v} + shift * if({scale} < 1e-9D, nb[i].{v}, (na[i].{v} + nb[i].{v}) / {scale})"
        for v in "xy"
    )
    return (
        df.selectExpr(*keys, "posexplode_outer(rings) AS (ring, line)")
        # the inside is on the left of a counter-clockwise outer ring or clockwise hole
        .selectExpr(
            "*", f"if(({g.double_area('line')} > 0) = (ring = 0), {d}, -{d}) AS shift",
            f"{normals} AS nb",
        )
        .selectExpr("*", f"{g.rotate('nb', '(size(nb) - 1)')} AS na")
        .selectExpr(*keys, "ring", f"transform(line, (p, i) -> named_struct({moved})) AS line")
    )


def closest_on_boundary(
    walls: DataFrame, footprints: DataFrame, wall_keys: list[str], keys: list[str]
) -> DataFrame:
    """Adds the footprint points closest to both ends of each wall segment.

    ``walls`` has x1, y1, x2, y2 and the keys of its building, ``footprints`` one row per
    ring.  New columns ``near_1`` and ``near_2`` are structs (x, y).  Each end looks for
    the nearest edge of its own building, ties going to the first one.
    """
    # both sides are read several times
    walls = materialise(walls.select(*wall_keys, *keys, "x1", "y1", "x2", "y2"))
    edges = materialise(footprints.selectExpr(
        *keys, "ring", f"posexplode_outer({g.ring_edges('line')}) AS (edge, e)"
    ).selectExpr("*", *g.edge_bbox("e")))
    sizes = edges.groupBy(*keys).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), F.count(F.lit(1)).alias("n"),
    )
    segment = [*wall_keys, *keys, "x1", "y1", "x2", "y2"]
    both = "array(named_struct('x', x1, 'y', y1), named_struct('x', x2, 'y', y2))"
    ends = walls.selectExpr(*segment, f"posexplode_outer({both}) AS (end, p)").selectExpr(
        *segment, "end", "p.x AS x", "p.y AS y"
    )
    found = nearest_in_group(
        ends, edges, sizes, tuple(keys), ("ring", "edge", "e"), TO_EDGE
    ).selectExpr(*segment, "end", "x", "y", f"{BEST}.e AS e")
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    along = (
        f"greatest(0.0D, least(1.0D, ((x - e.x1) * {dx} + (y - e.y1) * {dy})"
        f" / ({dx} * {dx} + {dy} * {dy})))"
    )
    near = f"named_struct('x', e.x1 + {along} * {dx}, 'y', e.y1 + {along} * {dy})"
    return found.groupBy(*segment).agg(
        F.expr(f"min({near}) FILTER (WHERE end = 0) AS near_1"),
        F.expr(f"min({near}) FILTER (WHERE end = 1) AS near_2"),
    )


def wall_quads(closest: DataFrame, wall_keys: list[str]) -> DataFrame:
    """Closed wall polygon per segment: footprint at end and start, start, end, and back."""

    def at(x: str, y: str) -> str:
        return f"named_struct('x', double({x}), 'y', double({y}))"

    far, near = at("near_2.x", "near_2.y"), at("near_1.x", "near_1.y")
    return closest.selectExpr(
        *wall_keys, f"array({far}, {near}, {at('x1', 'y1')}, {at('x2', 'y2')}, {far}) AS wall"
    )
