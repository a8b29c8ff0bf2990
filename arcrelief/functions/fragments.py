"""Polygons cut into fragments that can be tested on their own.

A fragment says for one polygon and one rectangle which edges matter there and whether one
reference point is inside (``base`` 1) or outside (0).  A point of the rectangle is inside
when ``base`` plus the edges crossed on the way to the reference point is odd, so a polygon
of any size is tested against a few local edges, and holes need no special code.

* Small polygons (up to ``SMALL`` edges) are one fragment: all edges, and outside at a
  point left of and below their box.  This is a projection of the polygon row.
* Larger ones get grid cells sized for about ``PER_CELL`` edges.  Edges are shuffled by
  polygon and cell, and the inside flag of the cell corners comes from one window per
  polygon and cell row.  Runs of edges longer than ``RUN`` stay separate rows, so that no
  group outgrows a task; such a cell has ``pieces`` > 1 and callers add up the pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import geometry as g
from . import grid

SMALL = 64
PER_CELL = 16
RUN = 4096


@dataclass(frozen=True)
class Fragments:
    """``rows``: keys, box, level, ref_x, ref_y, base, edges, pieces, cut."""

    rows: DataFrame
    levels: list[int]
    in_pieces: bool

    def on_cells(self) -> DataFrame:
        """Registered in grid cells; a cut fragment is its own (half-open) cell.

        The box comes back with the prefix ``f_``.
        """

        def span(axis: str) -> str:
            lo = grid.index(f"{axis}min", grid.side())
            hi = grid.index(f"{axis}max", grid.side())
            return f"explode_outer(sequence({lo}, if(cut, {lo}, {hi})))"

        celled = self.rows.selectExpr("*", f"{span('x')} AS cx").selectExpr(
            "*", f"{span('y')} AS cy"
        )
        return celled.withColumnsRenamed({k: f"f_{k}" for k in g.SIDES})


def fragments(features: DataFrame, keys: list[str], halo: float = 0.0) -> Fragments:
    """Fragments of all polygons; edges up to ``halo`` outside a cell belong to it too."""
    extent = "greatest(xmax - xmin, ymax - ymin)"
    share = f"if(n_edges <= {SMALL}, 1.0D, sqrt(n_edges / {PER_CELL}))"
    sized = (
        features.selectExpr(*keys, "rings", "flatten(rings) AS _v")
        .selectExpr(*keys, "rings", "size(_v) AS n_edges", *g.bbox("_v"))
        .selectExpr("*", f"{grid.even_level(f'{extent} / {share}')} AS level")
    )
    seen = grid.summary(sized, "collect_set(level) AS levels", "max(n_edges) AS largest")
    largest = seen.largest or 0
    rows = _whole(sized, keys)
    if largest > SMALL:
        rows = rows.unionByName(_cut(sized, keys, halo))
    return Fragments(rows, sorted(seen.levels), largest > RUN)


def _whole(sized: DataFrame, keys: list[str]) -> DataFrame:
    return sized.filter(f"n_edges <= {SMALL}").selectExpr(
        *keys, *[f"double({k}) AS {k}" for k in g.SIDES], "level",
        "double(xmin) - 1 AS ref_x", "double(ymin) - 1 AS ref_y", "0 AS base",
        f"{g.polygon_edges('rings')} AS edges", "1L AS pieces", "false AS cut",
    )


def _touching(lo: str, hi: str) -> str:
    """Cells whose closed interval meets [lo, hi]."""
    return f"explode_outer(sequence(ceil(({lo}) / {grid.side()}) - 1, floor(({hi}) / {grid.side()})))"


def _cut(sized: DataFrame, keys: list[str], halo: float) -> DataFrame:
    s = grid.side()
    rows = (
        sized.filter(f"n_edges > {SMALL}")
        .selectExpr(*keys, "level", f"posexplode_outer({g.polygon_edges('rings')}) AS (i, e)")
        .selectExpr(*keys, "level", "e", f"i div {RUN} AS run", *g.edge_bbox("e"))
        .selectExpr("*", f"{_touching(f'ymin - {halo}', f'ymax + {halo}')} AS cy")
    )
    # the part of the edge inside the row, with a margin for rounding
    margin = f"({s} * 1e-6D + {halo})"

    def cut_at(y: str) -> str:
        return (
            f"e.x1 + (greatest(ymin, least(ymax, {y})) - e.y1)"
            " * ((e.x2 - e.x1) / nullif(e.y2 - e.y1, 0))"
        )

    low, high = cut_at(f"cy * {s} - {margin}"), cut_at(f"(cy + 1) * {s} + {margin}")
    cells = rows.selectExpr("*", f"{low} AS _a", f"{high} AS _b").selectExpr(
        "*",
        _touching(
            f"coalesce(greatest(xmin, least(_a, _b)), xmin) - {margin}",
            f"coalesce(least(xmax, greatest(_a, _b)), xmax) + {margin}",
        ) + " AS cx",
    )
    # an edge crossing the row's lower line counts in the cell where it does
    y0 = f"(cy * {s})"
    crossing = (
        f"((e.y1 <= {y0}) != (e.y2 <= {y0})"
        f" AND {g.left_side('e', f'(cx * {s})', y0)} = (e.y2 > e.y1)"
        f" AND {g.left_side('e', f'((cx + 1) * {s})', y0)} != (e.y2 > e.y1))"
    )
    grouped = cells.groupBy(*keys, "level", "cy", "cx", "run").agg(
        F.expr("collect_list(e) AS edges"), F.expr(f"count_if({crossing}) AS crossed")
    )
    row = Window.partitionBy(*keys, "level", "cy")
    leftward = row.orderBy(F.col("cx").desc())
    flagged = grouped.select(
        "*",
        (
            F.sum("crossed").over(leftward.rangeBetween(Window.unboundedPreceding, 0)) % 2
        ).cast("int").alias("base"),
        F.count(F.lit(1)).over(leftward.rangeBetween(0, 0)).alias("pieces"),
        F.lag("cx").over(row.orderBy("cx", "run")).alias("before"),
    )
    # the cells without edges between two cells of a row are all inside or all outside
    gap = "if(base = 1 AND cx - before > 1, sequence(before + 1, cx - 1), slice(array(cx), 1, 0))"
    spread = flagged.selectExpr(
        *keys, "level", "cy", "edges", "base", "pieces",
        f"posexplode_outer(concat(array(cx), coalesce({gap}, slice(array(cx), 1, 0)))) AS (i, cx)",
    )
    return spread.selectExpr(
        *keys,
        f"cx * {s} AS xmin", f"cy * {s} AS ymin", f"(cx + 1) * {s} AS xmax",
        f"(cy + 1) * {s} AS ymax", "level", f"cx * {s} AS ref_x", f"cy * {s} AS ref_y", "base",
        "if(i = 0, edges, slice(edges, 1, 0)) AS edges",
        "if(i = 0, pieces, 1L) AS pieces", "true AS cut",
    )
