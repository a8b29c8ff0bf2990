"""Nearest vectors by cosine along several shifted Hilbert curves.

1. Equal vectors are one node, which keeps its k + 1 smallest ids: no more of them can be
   among the k nearest of any query.
2. Each curve projects unit vectors on a few random directions, scales them by the mean and
   deviation of a bounded sample, shifts them by a random offset, and numbers the cells of the
   grid in Hilbert order.
3. All nodes are range-partitioned by curve, cell and node, which gives dense ranks, and ranks
   give blocks of a fixed size.
4. A query opens the blocks that the window around its rank touches, on every curve.  Each
   block reranks its queries with the original vectors; the curves' results are merged.

The window is fitted, not given: for a bounded sample of the queries the true nearest are
found among all nodes, and the window is as wide as ``recall`` of them need on their best
curve.  Where vectors lie in clusters or on a surface of few dimensions, that is little,
whatever the table's size.  Vectors that spread evenly over many dimensions have no order that
keeps neighbours together, and the window becomes a share of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import with_dense_id
from .store import staged


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of grid cells (rows of non-negative ints below 2 ** bits)."""
    x = cells.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):  # undo the turns of each level, the coarsest first
        low = (1 << b) - 1
        for axis in x:
            set_ = (axis >> b) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(set_, low, swap)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)  # Gray code over the axes
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            keys = keys << 1 | (axis >> b) & 1
    return keys


@dataclass(frozen=True)
class Curve:
    directions: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    shift: np.ndarray
    bits: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        at = (unit @ self.directions - self.mean) / self.deviation
        # four deviations either way take half of the grid's side, the shift moves them in it
        at = np.clip((at + 4) / 16 + self.shift, 0, 1)
        side = 1 << self.bits
        return hilbert_keys(np.minimum((at * side).astype(np.int64), side - 1), self.bits)


def curves_of(sample: np.ndarray, curves: int, axes: int, seed: int) -> list[Curve]:
    """``sample``: unit vectors; at least one."""
    random = np.random.default_rng(seed)
    size = sample.shape[1]
    axes = min(axes, size)
    out = []
    for _ in range(curves):
        directions = np.linalg.qr(random.normal(size=(size, axes)))[0]
        at = sample @ directions
        deviation = at.std(0)
        out.append(Curve(directions, at.mean(0), np.where(deviation > 0, deviation, 1.0),
                         random.uniform(0, 0.5, axes), 60 // axes if axes > 2 else 30))
    return out


def _matrix(column: pa.Array, kind: str, size: int) -> np.ndarray:
    """Vectors of doubles, from their bytes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(-1, size).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _packed(vectors: DataFrame, column: str, kind: str, size: int) -> DataFrame:
    """vec_id, vec (its bytes) and node (their digest) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            good = np.isfinite(x).all(1) & (x != 0).any(1)
            data = [v.tobytes() for v in np.ascontiguousarray(x[good], kind)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), pa.array(data, pa.binary())],
                ["vec_id", "vec"])

    v = F.col(column)
    return (
        vectors.where(F.col("vec_id").isNotNull() & (F.size(v) == size)
                      & ~F.exists(v, lambda x: x.isNull()))
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                v.cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
        .mapInArrow(run, "vec_id LONG, vec BINARY")
        .withColumn("node", F.unhex(F.md5("vec")))
    )


def _best(scores: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, ties to the smaller ``first``; in no order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(scores, part, 1).min(1)
    tied = np.flatnonzero((scores >= least[:, None] - 1e-12).sum(1) > k)
    for r in tied:  # more than k as good as the last: choose by id
        part[r] = np.lexsort((first, -np.round(scores[r], 12)))[:k]
    return part


def _reranked(k: int, kind: str, size: int):
    """For cogroups of queries (node, vec) and points (node, first, vec) of one block."""

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "node": [], "first": [], "score": []}
        if len(queries) and len(points):
            own = queries["node"].to_pylist()
            nodes, first = points["node"].to_pylist(), points["first"].to_numpy()
            p = _matrix(points["vec"].combine_chunks(), kind, size)
            q = _matrix(queries["vec"].combine_chunks(), kind, size)
            up, uq = _unit(p), _unit(q)
            for at in range(0, len(q), 256):
                part = _best(uq[at:at + 256] @ up.T, first, k)
                for i, chosen in enumerate(part, at):
                    out["query"] += [own[i]] * len(chosen)
                    out["node"] += [nodes[c] for c in chosen]
                    out["first"] += first[chosen].tolist()
                    out["score"] += (up[chosen] * uq[i]).sum(1).tolist()
        return pa.table(out, _FOUND_ARROW)

    return run


_FOUND = "query BINARY, node BINARY, first LONG, score DOUBLE"
_FOUND_ARROW = pa.schema([("query", pa.binary()), ("node", pa.binary()), ("first", pa.int64()),
                          ("score", pa.float64())])


def _truth(nodes: DataFrame, sample: pa.Table, k: int, kind: str, size: int) -> DataFrame:
    """query and node: the k nearest other nodes of each of the sample's, among all nodes."""
    own = sample["node"].to_pylist()
    shared = nodes.sparkSession.sparkContext.broadcast(
        (own, _unit(_matrix(sample["vec"].combine_chunks(), kind, size))))  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = shared.value
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), kind, size))
            nodes = np.array(batch.column(0).to_pylist(), object)
            first = batch.column(2).to_numpy()
            for at in range(0, len(nodes), 8192):
                piece = slice(at, at + 8192)
                scores = queries @ unit[piece].T
                part = _best(scores, first[piece], k + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, row in zip(own, part) for _ in row], pa.binary()),
                    pa.array(nodes[piece][part.ravel()].tolist(), pa.binary()),
                    pa.array(first[piece][part.ravel()]),
                    pa.array(np.take_along_axis(scores, part, 1).ravel())], _FOUND_ARROW.names)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    return (
        nodes.select("node", "vec", "first").mapInArrow(run, _FOUND)
        .where("query <> node").withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k).select("query", "node")
    )


def search(vectors: DataFrame, asked: Column, k: int = 5, column: str = "embedding",
           recall: float = 0.95, curves: int = 4, axes: int = 8, block: int = 8192,
           least_window: int = 512, most_fitted: int = 10_000, most_tried: int = 256,
           seed: int = 7) -> DataFrame:
    """The ``k`` nearest found of each row of ``vectors`` (vec_id, ``column``) with ``asked``.

    Returns query_id, rank (from 1), vec_id and score, the cosine in double precision; nearest
    first, ties to the smaller vec_id.  Rows of the query's own id aren't candidates.  Vectors
    that are null, zero, hold a null or non-finite component or have another length than
    the most common one take no part, nor do null ids; equal rows count once; other columns
    are ignored.  Fewer candidates give fewer rows, none at all no row.

    ``most_fitted`` nodes scale the curves and ``most_tried`` query nodes fit the window, those of
    the smallest digests; every node is on every curve and all queries are searched.
    """
    spark = vectors.sparkSession
    no_rows = spark.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score DOUBLE")
    v = F.col(column)
    common = (
        vectors.where(F.size(v) > 0).groupBy(F.size(v).alias("size")).count()
        .orderBy(F.desc("count"), "size").first()
    )
    if common is None:
        return no_rows
    size = common["size"]
    kind = "<f4" if vectors.schema[column].dataType.elementType.typeName() == "float" else "<f8"

    rows = _packed(vectors, column, kind, size)
    queries = staged(
        _packed(vectors.where(asked), column, kind, size).select(
            F.col("vec_id").alias("query_id"), "node").distinct(), "search-queries")
    by_id = Window.partitionBy("node").orderBy("vec_id")
    nodes = (
        rows.withColumn("at", F.dense_rank().over(by_id)).where(F.col("at") <= k + 1)
        .groupBy("node").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"),
                             F.first("vec").alias("vec"))
        .withColumn("first", F.element_at("ids", 1))
    )
    wanted = queries.select("node", F.lit(True).alias("asked")).distinct()
    nodes = staged(nodes.join(wanted, "node", "left").withColumn(
        "asked", F.coalesce("asked", F.lit(False))), "search-nodes")
    n = nodes.count()
    sample = nodes.select("node", "vec").orderBy("node").limit(most_fitted).toArrow()
    tried = nodes.where("asked").select("node", "vec").orderBy("node").limit(most_tried).toArrow()
    if not len(sample) or not len(tried):
        return no_rows
    lines = curves_of(_unit(_matrix(sample["vec"].combine_chunks(), kind, size)), curves, axes, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), kind, size))
            for number, line in enumerate(lines):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(unit), pa.int32()), pa.array(line.keys(unit)),
                     *batch.columns], ["curve", "key", "node", "vec", "first", "asked"])

    placed = nodes.select("node", "vec", "first", "asked").mapInArrow(
        keyed, "curve INT, key LONG, node BINARY, vec BINARY, first LONG, asked BOOLEAN")
    ranked = staged(
        with_dense_id(placed, ["curve", "key", "node"], "place")
        .withColumn("place", F.col("place") - F.col("curve") * F.lit(n)), "search-places")

    truth = F.broadcast(staged(_truth(nodes, tried, k, kind, size), "search-truth"))
    at = lambda name: ranked.select(
        "curve", F.col("node").alias(name), F.col("place").alias(f"{name}_place"))
    mine = staged(at("query").join(truth, "query"), "search-tried")
    theirs = staged(at("node").join(truth.select("node").distinct(), "node"), "search-truth-places")
    apart = (
        mine.join(theirs, ["curve", "node"]).groupBy("query", "node")
        .agg(F.min(F.abs(F.col("query_place") - F.col("node_place"))).alias("apart"))
        .select("apart").toArrow()["apart"].to_numpy()
    )
    window = max(least_window, int(np.quantile(apart, recall)) if len(apart) else 0)

    start = F.greatest(F.lit(0), F.least(F.col("place") - window, F.lit(n - 1 - 2 * window)))
    last = F.least(start + 2 * window, F.lit(n - 1))
    home = F.floor(F.col("place") / (16 * block))  # bounds the queries that meet in one task
    opened = staged(ranked.where("asked").select(
        "curve", home.alias("home"), "node", "vec",
        F.explode(F.sequence(F.floor(start / block), F.floor(last / block))).alias("block")),
        "search-opened")
    pairs = staged(opened.select("curve", "home", "block").distinct(), "search-pairs")
    points = ranked.select(
        "curve", F.floor(F.col("place") / block).alias("block"), "node", "first", "vec"
    ).join(pairs, ["curve", "block"])
    keys = ["curve", "home", "block"]
    found = staged(
        opened.groupBy(*keys).cogroup(points.groupBy(*keys))
        .applyInArrow(_reranked(k + 1, kind, size), _FOUND), "search-found")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "first", "node")
    chosen = staged(
        found.groupBy("query", "node").agg(F.first("first").alias("first"), F.max("score").alias("score"))
        .withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
        .join(nodes.select("node", "ids"), "node")
        .select("query", "score", F.explode("ids").alias("vec_id")), "search-chosen")
    few = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    chosen = chosen.withColumn("at", F.row_number().over(few)).where(F.col("at") <= k + 1)
    lists = staged(
        chosen.groupBy("query").agg(F.array_sort(F.collect_list(
            F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("found")), "search-lists")
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(lists, queries["node"] == lists["query"])
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "one"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"),
                (-F.col("one.minus")).alias("score"))
    )
