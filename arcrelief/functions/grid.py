"""Grid keys that turn spatial joins into equi joins.

An extent is registered on the level whose cell (side ``2 ** level``) is at least as wide
as the extent, so it covers at most four cells however large it is; no size limit and no
list of oversized extents is needed.  Only even levels are used to keep few of them.

The distinct levels of a frame (at most some dozens of integers) are fetched once, as one
aggregated row, and become literals of the join plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import geometry as g

#: For joins on cells.  Rows are put into several cells first, and estimates don't follow that, so
#: that neither side may be sent whole to the driver and all executors.
SPREAD = ("merge",)


def side(level: str = "level") -> str:
    return f"pow(2.0D, {level})"


def even_level(width: str) -> str:
    """Smallest even level whose cell is at least ``width`` wide (-20 for a point)."""
    return f"int(ceil(log2(if({width} > 0, {width}, 1e-6D)) / 2) * 2)"


def extent_level(b: dict[str, str]) -> str:
    return even_level(f"greatest({b['xmax']} - {b['xmin']}, {b['ymax']} - {b['ymin']})")


def index(v: str, s: str) -> str:
    return f"floor({v} / {s})"


def summary(df: DataFrame, *aggregates: str):
    """One aggregated row of a frame."""
    return df.selectExpr(*aggregates).first()


def levels_of(df: DataFrame, level: str) -> list[int]:
    return sorted(summary(df, f"collect_set({level}) AS levels").levels)


def array_of(levels: list[int]) -> str:
    return f"array({', '.join(map(str, levels))})" if levels else "array_repeat(0, 0)"


def on_levels(df: DataFrame, levels: list[int]) -> DataFrame:
    """Register points (x, y) in their cell of every level that the other side uses."""
    return df.selectExpr("*", f"explode({array_of(levels)}) AS level").selectExpr(
        "*", f"{index('x', side())} AS cx", f"{index('y', side())} AS cy"
    )


def on_cells(df: DataFrame, s: str, b: dict[str, str]) -> DataFrame:
    """Register extents in every cell of side ``s`` that they touch."""

    def span(axis: str) -> str:
        return f"explode_outer(sequence({index(b[axis + 'min'], s)}, {index(b[axis + 'max'], s)}))"

    return df.selectExpr("*", f"{span('x')} AS cx").selectExpr("*", f"{span('y')} AS cy")


def extent_pairs(
    left: DataFrame,
    right: DataFrame,
    left_levels: list[int] | None = None,
    right_levels: list[int] | None = None,
) -> DataFrame:
    """All pairs of rows with overlapping closed extents, each exactly once.

    Both sides have ``xmin, ymin, xmax, ymax``; those of the right side come back as
    ``r_xmin`` and so on, other column names must differ.  A pair meets on the coarser of its
    two levels, in one of two joins: the left side on its own level with what is as fine or
    finer on the right, or the right side on its own level with what is finer on the left.  So two
    small extents never meet on a coarse level.  Of the cells a pair shares only that of the
    lower left corner of the overlap counts.  Levels that the caller knows already need
    not be fetched again.
    """
    right = right.selectExpr(*[f"{c} AS r_{c}" if c in g.SIDES else c for c in right.columns])
    lbox, rbox = g.box(), g.box("r_")
    llevels = levels_of(left, extent_level(lbox)) if left_levels is None else left_levels
    rlevels = levels_of(right, extent_level(rbox)) if right_levels is None else right_levels
    columns = [*left.columns, *right.columns]

    def placed(df: DataFrame, b: dict[str, str], levels: str) -> DataFrame:
        leveled = df.selectExpr("*", f"{extent_level(b)} AS _own").selectExpr("*", f"explode({levels}) AS level")
        return on_cells(leveled.drop("_own").selectExpr("*", f"{side()} AS _side"), "_side", b)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        corner = [
            f"{c} = {index(f'greatest({lbox[k]}, {rbox[k]})', '_side')}"
            for c, k in (("cx", "xmin"), ("cy", "ymin"))
        ]
        joined = a.join(b.drop("_side").hint(*SPREAD), ["level", "cx", "cy"])
        return joined.filter(f"{g.boxes_overlap(lbox, rbox)} AND {' AND '.join(corner)}").select(*columns)

    own = "array(_own)"
    coarser = met(
        placed(left, lbox, own),
        placed(right, rbox, f"concat(array(_own), filter({array_of(llevels)}, v -> v > _own))"))
    if not any(low < high for low in llevels for high in rlevels):
        return coarser
    finer = met(
        placed(left, lbox, f"filter({array_of(rlevels)}, v -> v > _own)"),
        placed(right, rbox, own))
    return coarser.unionByName(finer)
