"""The k nearest targets of each query, exact, over cells that follow the density.

In a group of a few leaves' targets a query meets them all, as one array, without any search.
Others are sorted into a quadtree from the top: a cell with more than ``leaf`` targets is cut into
``2 ** _STEP`` by ``2 ** _STEP`` smaller ones, again and again, so a dense spot costs a few more
rounds over its own targets and never a full cell.  Queries walk down the tree.  A cell's
extent bounds the distances to all its targets from below and above; the k-th smallest upper
bound, counted in targets, tells which cells can still hold one of the k nearest.  So a query keeps
a few cells in each round, and every leaf it meets gives at most k targets, sorted in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..session import materialise
from .nearest import TO_POINT, Distance

_STEP = 2  # levels of the quadtree in one round
_DEEPEST = 48  # levels; targets nearer to each other than that share a leaf
_DIRECT = 4  # leaves of targets that a group may have without being cut
_SMALL = 10_000  # cells of a round that are broadcast
NEAREST = "nearest"


def nearest_k(
    queries: DataFrame,
    targets: DataFrame,
    k: int,
    order: tuple[str, ...],
    group: tuple[str, ...] = (),
    distance: Distance = TO_POINT,
    leaf: int = 32,
) -> DataFrame:
    """Adds ``nearest``, an array of up to ``k`` structs (d2, *order), nearest first.

    ``queries`` has x, y and the ``group`` columns; its rows must be distinct.  ``targets`` has
    extents (xmin, ymin, xmax, ymax), the ``group`` and ``order`` columns and those of the
    distance.  Equal distances are put in the order of the ``order`` columns; equal targets count
    each.  With a ``group`` only targets of the query's own group are near; NULL groups have none.
    A query without targets gets an empty array.
    """
    keys, limit = list(group), _DIRECT * max(leaf, k)
    used = list(dict.fromkeys([*keys, *g.SIDES, *distance.columns, *order]))
    # targets without a place are near to nothing
    targets = materialise(targets.select(*used).filter("xmin IS NOT NULL AND ymin IS NOT NULL"))
    extent = [f"double({fn}({s})) AS {s}" for s, fn in zip(g.SIDES, ("min", "min", "max", "max"))]
    sizes = targets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *map(F.expr, extent))
    sizes = materialise(sizes) if keys else sizes
    span = grid.summary(
        sizes, "max(n) AS n", "min(xmin) AS x0", "min(ymin) AS y0", "max(xmax) AS x1", "max(ymax) AS y1")
    types = targets.schema
    fields = "".join(f", {c}: {types[c].dataType.simpleString()}" for c in order)
    none = f"CAST(array() AS ARRAY<STRUCT<d2: DOUBLE{fields}>>)"
    if span.x0 is None:
        return queries.selectExpr("*", f"{none} AS {NEAREST}")
    if keys and span.n <= limit:
        return _direct(queries, targets, k, keys, order, distance, none)
    side = max(span.x1 - span.x0, span.y1 - span.y0) or 1.0
    if not keys:
        rows = materialise(_counted(targets, k, keys, order, distance).withColumn("depth", F.lit(0)))
        return _by_tree(queries, rows, k, keys, order, distance, none, (span.x0, span.y0, side), leaf)
    size = "greatest(xmax - xmin, ymax - ymin, 1e-9D)"
    big = materialise(sizes.filter(f"n > {limit}").selectExpr(
        *keys, f"int(least({_DEEPEST}, greatest(0, floor(log2({side!r}D / {size}))))) AS depth"))
    few = _direct(
        queries.join(big, keys, "left_anti"), targets.join(big, keys, "left_anti"), k, keys, order, distance, none)
    rows = materialise(
        _counted(targets.join(big, keys, "left_semi"), k, keys, order, distance).join(big, keys))
    many = _by_tree(
        queries.join(big, keys, "left_semi"), rows, k, keys, order, distance, none, (span.x0, span.y0, side), leaf)
    return few.unionByName(many.select(*few.columns))


def _direct(queries, targets, k, keys, order, distance, none) -> DataFrame:
    """A query meets its group as one array; for groups of a bounded number of targets."""
    kept = [c for c in targets.columns if c not in keys]
    blocks = targets.groupBy(*keys).agg(F.collect_list(F.struct(*kept)).alias("block"))
    entry = "".join(f", '{c}', t.{c}" for c in order)
    # sorted in compiled code, which array_sort isn't
    found = f"slice(sort_array(transform(block, t -> named_struct('d2', {distance.sql('t.')}{entry}))), 1, {k})"
    known = " AND ".join(f"{c} IS NOT NULL" for c in queries.columns)
    return queries.join(blocks, keys, "left").selectExpr(
        *queries.columns, f"if(block IS NOT NULL AND {known}, {found}, {none}) AS {NEAREST}")


def _by_tree(queries, rows, k, keys, order, distance, none, frame, leaf) -> DataFrame:
    nodes, leaves = _tree(rows, keys, frame, max(leaf, 4 * k))
    found = _walk(queries, nodes, keys, k)
    entry = ", ".join(f"'{c}', t.{c}" for c in order)
    # only the first k are repeated for their copies
    heap = (
        f"slice(sort_array(transform(block, t -> named_struct("
        f"'d2', {distance.sql('t.')}, {entry}, 'copies', t.copies))), 1, {k})"
    )
    first = f"slice(sort_array(flatten(collect_list(heap))), 1, {k})"
    near = f"slice(flatten(transform(first, t -> array_repeat(named_struct('d2', t.d2, {entry}), t.copies))), 1, {k})"
    best = (
        found.join(leaves, [*keys, "round", "cx", "cy"])
        .selectExpr(*queries.columns, f"{heap} AS heap")
        .groupBy(*queries.columns)
        .agg(F.expr(f"{first} AS first"))
        .selectExpr(*queries.columns, f"{near} AS {NEAREST}")
    )
    return queries.join(best, queries.columns, "left").selectExpr(
        *queries.columns, f"coalesce({NEAREST}, {none}) AS {NEAREST}"
    )


def _counted(targets, k, keys, order, distance) -> DataFrame:
    """Targets with copies counted; a position keeps its first k in order."""
    where = list(dict.fromkeys([*keys, *g.SIDES, *distance.columns]))
    first = Window.partitionBy(*where).orderBy(*order)
    return targets.groupBy(*targets.columns).agg(F.expr(f"int(least(count(*), {k})) AS copies")).select(
        "*", F.row_number().over(first).alias("_n")).filter(f"_n <= {k}").drop("_n")


def _tree(rows, keys, frame, leaf) -> tuple[list[tuple[DataFrame, int, bool]], DataFrame]:
    """Cells by round (with their number, and whether some are cut further), and the leaves' targets."""
    x0, y0, side = frame
    cell = [*keys, "cx", "cy"]
    extent = [F.expr(f"min({a}min) AS {a}min") for a in "xy"]
    extent += [F.expr(f"max({a}max) AS {a}max") for a in "xy"]
    columns = rows.columns
    nodes, leaves, number = [], None, 0
    while True:
        size = f"({side!r}D / pow(2.0D, depth + {_STEP * number}))"
        active = rows.selectExpr(
            "*", f"floor((xmin - {x0!r}D) / {size}) AS cx", f"floor((ymin - {y0!r}D) / {size}) AS cy")
        cells = materialise(
            active.groupBy(*cell).agg(*extent, F.expr("sum(copies) AS n"), F.expr("min(depth) AS depth"))
            .selectExpr("*", f"n <= {leaf} OR depth + {_STEP * (number + 1)} > {_DEEPEST} AS is_leaf"))
        seen = grid.summary(cells, "count(*) AS n", "coalesce(max(NOT is_leaf), false) AS cut")
        nodes.append((cells.drop("depth"), seen.n, seen.cut))
        flagged = active.join(cells.select(*cell, "is_leaf"), cell)
        ended = flagged.filter("is_leaf").select(*columns, "cx", "cy").withColumn("round", F.lit(number))
        leaves = ended if leaves is None else leaves.unionByName(ended)
        if not seen.cut:
            break
        rows, number = materialise(flagged.filter("NOT is_leaf").select(*columns)), number + 1
    kept = [c for c in columns if c not in (*keys, "depth")]
    blocks = leaves.groupBy(*keys, "round", "cx", "cy").agg(F.collect_list(F.struct(*kept)).alias("block"))
    return nodes, materialise(blocks)


def _walk(queries, nodes, keys, k) -> DataFrame:
    """Leaves that can hold one of the k nearest, per query: the query's columns, round, cx, cy."""
    own = queries.columns
    mine = Window.partitionBy(*own)
    so_far = mine.orderBy("high").rangeBetween(Window.unboundedPreceding, 0)

    def bounds(joined: DataFrame, number: int) -> DataFrame:
        return joined.selectExpr(
            *own, f"{number} AS round", "cx", "cy", "n", "is_leaf",
            f"{g.box_dist2('x', 'y', g.box())} AS low", f"{g.box_far2('x', 'y', g.box())} AS high")

    def kept(alive: DataFrame) -> DataFrame:
        reached = alive.withColumn("reached", F.sum("n").over(so_far))
        bound = F.min(F.when(F.col("reached") >= k, F.col("high"))).over(mine)
        return materialise(
            reached.withColumn("bound", bound).filter("low <= coalesce(bound, double('inf'))")
            .drop("reached", "bound"))

    roots, n, _ = nodes[0]
    roots = F.broadcast(roots) if n <= _SMALL else roots
    alive = kept(bounds(queries.join(roots, keys) if keys else queries.crossJoin(roots), 0))
    for number in range(1, len(nodes)):
        cells, n, _ = nodes[number]
        parent = f"int({2 ** _STEP})"
        children = cells.selectExpr(
            *keys, f"floor(cx / {parent}) AS px", f"floor(cy / {parent}) AS py",
            "cx", "cy", "n", "is_leaf", *g.SIDES)
        children = F.broadcast(children) if n <= _SMALL else children
        inner = alive.filter(f"NOT is_leaf AND round = {number - 1}").selectExpr(*own, "cx AS px", "cy AS py")
        alive = kept(
            alive.filter("is_leaf").unionByName(
                bounds(inner.join(children, [*keys, "px", "py"]), number)))
    return alive.select(*own, "round", "cx", "cy")
