"""Nearest-target joins (k = 1), exact at any distance.

* Within groups of at most ``DIRECT`` targets (a patch of points, the edges of a building) each
  query meets all targets of its group.  Pairs only live inside the join: the least distance is a
  hash aggregate right behind it, and a second join finds what lies at that distance.
* Elsewhere a query looks into the grid cells within half a cell side around it (``near``).
  A target at most that far away settles it, as nothing closer can exist.
* The unsettled rest walks down a pyramid of ever smaller cells (``far``).  Each pyramid
  row knows the extent of its targets, so per query only cells that can still beat the
  best guaranteed distance are kept, and no query is ever paired with all targets.

Targets have an extent (xmin, ymin, xmax, ymax); the distance may be that to the extent or
to something inside it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..session import materialise

_STEP = 4  # side ratio between pyramid levels
BEST = "best"
DIRECT = 1024
PER_CELL = 32
HOT = 200_000  # queries of one group that a task may be given


@dataclass(frozen=True)
class Distance:
    """Squared distance from (x, y) to a target, as SQL over columns with a prefix."""

    sql: Callable[[str], str]
    columns: tuple[str, ...]


TO_BOX = Distance(lambda p: g.box_dist2("x", "y", {k: p + k for k in g.SIDES}), g.SIDES)
TO_POINT = Distance(
    lambda p: f"double({g.dist2('x', 'y', p + 'xmin', p + 'ymin')})", ("xmin", "ymin")
)
TO_EDGE = Distance(lambda p: g.edge_dist2(p + "e", "x", "y"), ("e",))


def nearest(
    queries: DataFrame,
    targets: DataFrame,
    cell: float,
    order: tuple[str, ...],
    distance: Distance = TO_BOX,
) -> DataFrame:
    """Nearest target of each query, ties broken by the ``order`` columns.

    ``queries`` has x and y; its rows must be distinct.  Returns the query columns and
    ``best``, a struct (d2, *order), NULL when there is no target.
    """
    side = f"{float(cell)!r}D AS _cell"
    found = _by_cells(
        queries.selectExpr("*", side), _merged(targets, (), order, distance).selectExpr("*", side),
        (), order, distance,
    )
    return found.drop("_cell")


def nearest_in_group(
    queries: DataFrame,
    targets: DataFrame,
    sizes: DataFrame,
    group: tuple[str, ...],
    order: tuple[str, ...],
    distance: Distance,
) -> DataFrame:
    """Like ``nearest``, among the targets of the query's own group only.

    ``sizes`` has one row per group: its extent and ``n``, an upper bound of its number of
    targets.  Groups above ``DIRECT`` get cells for about ``PER_CELL`` of their targets.
    """
    keys = list(group)
    if (grid.summary(sizes, "max(n) AS n").n or 0) <= DIRECT:
        return _direct(queries, targets, group, order, distance)
    big = sizes.filter(f"n > {DIRECT}").selectExpr(
        *keys, f"greatest(double(xmax - xmin), double(ymax - ymin), 1e-6D)"
        f" / sqrt(n / {PER_CELL}) AS _cell",
    )
    small = _direct(
        queries.join(big, keys, "left_anti"), targets.join(big, keys, "left_anti"),
        group, order, distance,
    )
    found = _by_cells(
        queries.join(big, keys),
        _merged(targets.join(big, keys, "left_semi"), group, order, distance).join(big, keys),
        group, order, distance,
    )
    return small.unionByName(found.select(*small.columns))


def _merged(targets, group, order, distance) -> DataFrame:
    """Copies of a target become one, the first in order; they combine before the shuffle."""
    same = list(dict.fromkeys([*group, *g.SIDES, *distance.columns]))
    rest = [c for c in order if c not in same]
    if not rest:
        return targets.select(*same).distinct()
    first = targets.groupBy(*same).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*same, "_first.*")


def _entry(order: tuple[str, ...], distance: Distance, prefix: str = "") -> str:
    fields = "".join(f", '{c}', {prefix}{c}" for c in order)
    return f"named_struct('d2', {distance.sql(prefix)}{fields})"


def _direct(queries, targets, group, order, distance) -> DataFrame:
    used = list(dict.fromkeys([*distance.columns, *order]))
    shared, met, keys = _spread(queries, targets.select(*group, F.struct(*used).alias("_t")), list(group))
    d2 = distance.sql("_t.")
    # a distance that is unknown comes before all others
    least = f"if(count_if(_t IS NOT NULL AND {d2} IS NULL) > 0, CAST(NULL AS DOUBLE), min({d2})) AS _least"
    pairs = shared.join(met, keys, "left")
    reached = pairs.groupBy(*shared.columns).agg(F.expr(least))
    own = met.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = " AND ".join([*[f"{k} = _of_{k}" for k in keys], f"{d2} <=> _least"])
    fields = ", ".join(f"'{c}', _t.{c}" for c in order)
    found = (
        reached.join(own, F.expr(same), "left").groupBy(*shared.columns, "_least")
        .agg(F.expr(f"min(if(_t IS NULL, NULL, named_struct({fields}))) AS _first"))
    )
    entry = "".join(f", '{c}', _first.{c}" for c in order)
    return found.selectExpr(
        *queries.columns, f"if(_first IS NULL, NULL, named_struct('d2', _least{entry})) AS {BEST}"
    )


def _spread(queries, targets, keys) -> tuple[DataFrame, DataFrame, list[str]]:
    """Gives groups with very many queries several copies of their targets, up to ``DIRECT`` rows each.

    The aggregate behind the join needs a query's pairs in one place, so AQE cannot split a hot key.
    """
    loads = queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_load"))
    if (grid.summary(loads, "max(_load) AS n").n or 0) <= HOT:
        return queries, targets, keys
    shares = materialise(
        loads.filter(f"_load > {HOT}").selectExpr(*keys, f"ceil(_load / {HOT}) AS _shares")
    )
    row = ", ".join(queries.columns)
    shared = queries.join(shares, keys, "left").selectExpr(
        *queries.columns, f"pmod(xxhash64({row}), coalesce(_shares, 1)) AS _share"
    )
    copied = targets.join(shares, keys, "left").selectExpr(
        *keys, "_t", "explode_outer(sequence(0L, coalesce(_shares, 1) - 1)) AS _share"
    )
    return shared, copied, [*keys, "_share"]


def _by_cells(queries, targets, group, order, distance) -> DataFrame:
    found = materialise(_near(queries, targets, group, order, distance))
    rest = found.filter(f"{BEST} IS NULL").drop(BEST)
    if rest.isEmpty():
        return found
    return found.filter(f"{BEST} IS NOT NULL").unionByName(
        _far(rest, targets, group, order, distance)
    )


def _near(queries, targets, group, order, distance) -> DataFrame:
    level = (
        "int(greatest(0, ceil(log2(greatest(xmax - xmin, ymax - ymin, _cell) / _cell))))"
    )
    levels = grid.levels_of(targets, level)
    s, reach = "(_cell * pow(2.0D, level))", "(_cell / 2)"

    def around(axis: str) -> str:
        return (
            f"explode_outer(sequence({grid.index(f'({axis} - {reach})', s)},"
            f" {grid.index(f'({axis} + {reach})', s)})) AS c{axis}"
        )

    probes = (
        queries.selectExpr("*", f"explode({grid.array_of(levels)}) AS level")
        .selectExpr("*", around("x"))
        .selectExpr("*", around("y"))
    )
    placed = grid.on_cells(targets.selectExpr("*", f"{level} AS level"), s, g.box()).drop("_cell")
    # of the cells a query and a target share, the first one counts
    first = " AND ".join(
        f"c{a} = greatest({grid.index(f'({a} - {reach})', s)}, {grid.index(f'{a}min', s)})"
        for a in "xy"
    )
    hits = (
        probes.join(placed.hint(*grid.SPREAD), [*group, "level", "cx", "cy"])
        .filter(f"{distance.sql('')} <= {reach} * {reach} AND {first}")
        .groupBy(*queries.columns)
        .agg(F.expr(f"min({_entry(order, distance)}) AS {BEST}"))
    )
    return queries.join(hits, queries.columns, "left")


def _far(rest, targets, group, order, distance) -> DataFrame:
    span = grid.summary(
        targets, "double(min(xmin)) AS x0", "double(min(ymin)) AS y0",
        "double(max(xmax)) AS x1", "double(max(ymax)) AS y1", "min(_cell) AS cell",
    )
    best = _entry(order, distance)
    if span.x0 is None:
        types = dict(targets.dtypes)
        fields = "".join(f", {c}: {types[c]}" for c in order)
        return rest.selectExpr("*", f"CAST(NULL AS STRUCT<d2: DOUBLE{fields}>) AS {BEST}")
    height, side = 0, span.cell
    while side < max(span.x1 - span.x0, span.y1 - span.y0):
        height, side = height + 1, side * _STEP
    height += 1  # the far border of the extent is within the last cell

    # a target belongs to the cell of its lower left corner; level 0 is the finest
    leaves = targets.selectExpr(
        "*", f"floor((xmin - {span.x0!r}D) / _cell) AS cx", f"floor((ymin - {span.y0!r}D) / _cell) AS cy"
    ).drop("_cell")
    extent = [F.expr(f"min({a}min) AS {a}min") for a in "xy"]
    extent += [F.expr(f"max({a}max) AS {a}max") for a in "xy"]
    pyramid = [materialise(leaves.groupBy(*group, "cx", "cy").agg(*extent))]
    for _ in range(height):
        coarser = pyramid[-1].withColumns(
            {"cx": F.expr(f"cx div {_STEP}"), "cy": F.expr(f"cy div {_STEP}")}
        )
        pyramid.append(coarser.groupBy(*group, "cx", "cy").agg(*extent))

    # all targets of a group are in cell (0, 0) of the top level
    alive = rest.selectExpr("*", "0L AS px", "0L AS py", "double('inf') AS bound")
    mine = Window.partitionBy(*rest.columns)
    for depth in range(height, -1, -1):
        parent = [f"cx div {_STEP} AS px", f"cy div {_STEP} AS py"]
        cells = pyramid[depth].selectExpr(
            *group, "cx", "cy", *g.SIDES, *(parent if depth < height else ["0L AS px", "0L AS py"])
        )
        alive = (
            alive.join(cells, [*group, "px", "py"])
            .selectExpr(
                *rest.columns, "cx AS px", "cy AS py", "bound",
                f"{g.box_dist2('x', 'y', g.box())} AS low",
                f"{g.box_far2('x', 'y', g.box())} AS high",
            )
            .withColumn("bound", F.least("bound", F.min("high").over(mine)))
            .filter("low <= bound")
            .drop("low", "high")
        )
        if depth % 3 == 0:
            alive = materialise(alive)
    hits = (
        alive.selectExpr(*rest.columns, "px AS cx", "py AS cy")
        .join(leaves, [*group, "cx", "cy"])
        .groupBy(*rest.columns)
        .agg(F.expr(f"min({best}) AS {BEST}"))
    )
    return rest.join(hits, rest.columns, "left")
