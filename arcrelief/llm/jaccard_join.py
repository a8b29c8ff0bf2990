"""Similar documents by word shingles, with a token-group matrix.

The method, for sets that link when 100 * intersection >= percent * union:

1. A document is the set of its shingles' hashes.  Equal sets are one node.
2. Shingles are ordered, those seen often behind the others, then by hash.  A set of n linked
   to another shares at least need = ceil(percent * n / 100) shingles with it, so among the
   first n - need + overlap of both in this order there are ``overlap`` common ones (or need, if
   that is less): the prefixes suffice to find candidates.
3. Nodes are partitioned into groups of similar ones.  The token-group matrix has a row for each
   prefix shingle and group, the union over the group's members.  The common rows of two groups
   whose sizes may fit are added up, which bounds the overlap of any member of one with the
   other; groups below the overlap that the least of their members needs are never opened.
4. Opened groups meet in one task, first with sketches of 256 bytes, whose difference bounds that
   of the sets; members that may still link meet again with their whole sets, shingled anew from
   the texts.  There each query's overlap with the other group's union comes first; only queries
   that reach their need are compared with members.
5. Links become components by star contraction.

Which shingles are frequent only sets the order, so it may be approximate: it is kept as
a bitmap of fixed size.  So are the shared shingles and the candidate nodes, whose false
positives the exact steps after them remove.  Bitmaps are all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import map_batches, staged

BITS = 25  # of a bitmap: 4 MB
SKETCH = 2048  # places of a sketch: 256 bytes
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    """8-byte hashes of words; forgets all at a size."""

    def __missing__(self, word):
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_digest(word)
        return value


_WORDS = _WordHashes()


def shingles_of(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A-Z lower-cased.

    Words are cut at ASCII white space.  Fewer words than ``size`` are one shingle; no word
    gives none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.frombuffer(b"".join(map(_WORDS.__getitem__, words)), np.uint64)
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        rolled = hashes.copy()
        for i in range(1, size):
            rolled = rolled[:-1] * _BASE + hashes[i:]
        rolled = (rolled ^ (rolled >> np.uint64(29)) ^ np.uint64(size)) * _MIX
        rolled ^= rolled >> np.uint64(32)
    return np.unique(rolled.view(np.int64))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")
                       ).withColumn("text_key", F.xxhash64("text"))


def _counted(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The shingles whose frequency can matter: half more than each set's prefix by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start in range(0, len(texts), 500):
                found = [shingles_of(t, size) for t in texts[start:start + 500]]
                low = [s[:3 * (len(s) - need_of(len(s), percent) + 1) // 2] for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(low))], ["token"])

    return map_batches(rows.select("text"), run, "token LONG")


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """A bit for each of SKETCH places: whether an odd number of the shingles falls there.

    Sketches of two sets differ in no more bits than the sets do in shingles.
    """
    return np.packbits((np.bincount(tokens >> 40 & (SKETCH - 1), minlength=SKETCH) & 1).astype(bool))


def _sketched(rows: DataFrame, size: int, percent: int, often: np.ndarray, overlap: int) -> DataFrame:
    """doc_id, text_key, node (hash of the set), n, grp, sketch and prefix of each document.

    The group: the set's least frequent-shingle hash (its least hash, if none is frequent)
    and its size to within a tenth, so near copies of one text mostly fall together.
    """
    shared = rows.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start in range(0, len(texts), 500):
                found = [shingles_of(t, size) for t in texts[start:start + 500]]
                sizes = np.array([len(s) for s in found])
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in found], np.uint64)
                prefixes, groups = [], np.zeros(len(found), np.int64)
                for i, own in enumerate(found):
                    late = _in_bitmap(bitmap, own)
                    first, last = own[~late], own[late]  # each in order of their hashes
                    length = len(own) - need_of(len(own), percent) + overlap if len(own) else 0
                    prefixes.append(np.concatenate([first, last])[:length])
                    groups[i] = last[0] if len(last) else own[0] if len(own) else 0
                with np.errstate(over="ignore"):
                    band = (np.log(np.maximum(sizes, 1)) / np.log(1.1)).astype(np.int64)
                    groups = groups.view(np.uint64) * _MIX + band.view(np.uint64)
                ends = np.cumsum([0] + [len(x) for x in prefixes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(found)), batch.column(1).slice(start, len(found)),
                     pa.array(nodes.view(np.int64)), pa.array(sizes.astype(np.int32)),
                     pa.array(groups.view(np.int64)),
                     pa.array([sketch_of(s).tobytes() for s in found], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes)))],
                    ["doc_id", "text_key", "node", "n", "grp", "sketch", "prefix"])

    return map_batches(
        rows.select("doc_id", "text_key", "text"), run,
        "doc_id LONG, text_key LONG, node LONG, n INT, grp LONG, sketch BINARY,"
        " prefix ARRAY<LONG>")


def _whole(rows: DataFrame, size: int) -> DataFrame:
    """node and tokens of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start in range(0, len(texts), 500):
                found = [shingles_of(t, size) for t in texts[start:start + 500]]
                nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in found]
                ends = np.cumsum([0] + [len(s) for s in found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(nodes, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    ["node", "tokens"])

    return map_batches(rows.select("text"), run, "node LONG, tokens ARRAY<LONG>")


def _bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bitmap of the low bits of hashes; 2^BITS / 64 rows at most reach the driver."""
    words = (
        rows.select(F.col(column).bitwiseAND((1 << BITS) - 1).alias("_b"))
        .groupBy(F.shiftright("_b", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_b & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap.view(np.uint64)


def _in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    bits = values & ((1 << BITS) - 1)
    return (bitmap[bits >> 6] >> (bits & 63).view(np.uint64)) & np.uint64(1) == 1


def need_of(n, percent: int):
    """The least overlap of a set of n with a set that links with it."""
    return -(-percent * n // 100)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])


def _only(rows: DataFrame, column: str, bitmap: np.ndarray) -> DataFrame:
    """Rows whose value may be in the bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_bitmap(shared.value, batch.column(at).to_numpy())))

    return map_batches(rows, run, rows.schema)


def links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Index pairs of linked sets between two opened groups, or within one.

    Each query's overlap with the union of the other group comes first; a query below its
    need is not compared.  Overlaps of the others are counted in blocks of columns.
    """
    sides = (left, left if right is None else right)
    sizes = [np.array([len(s) for s in side]) for side in sides]
    flats = [np.concatenate(side) for side in sides]
    owners = [np.repeat(np.arange(len(side)), n) for side, n in zip(sides, sizes)]
    if right is None:
        values, inverse, counts = np.unique(flats[0], return_inverse=True, return_counts=True)
        common = counts > 1
        columns = [inverse, inverse]
    else:
        values, inverse = np.unique(np.concatenate(flats), return_inverse=True)
        columns = [inverse[:len(flats[0])], inverse[len(flats[0]):]]
        common = np.zeros(len(values), np.int8)
        for c, bit in zip(columns, (1, 2)):
            common[c] |= bit
        common = common == 3
    number = np.cumsum(common) - 1
    bounded = []
    for side in (0, 1):
        inside = common[columns[side]]
        reach = np.bincount(owners[side][inside], minlength=len(sizes[side]))
        opened = reach >= need_of(sizes[side], percent)
        entries = inside & opened[owners[side]]
        bounded.append((owners[side][entries], number[columns[side][entries]]))
    overlap = np.zeros((len(sizes[0]), len(sizes[1])), np.float32)
    width = int(common.sum())
    for start in range(0, width, 8192):
        blocks = []
        for (owner, column), n in zip(bounded, sizes):
            block = np.zeros((len(n), min(8192, width - start)), np.float32)
            mine = (column >= start) & (column < start + 8192)
            block[owner[mine], column[mine] - start] = 1
            blocks.append(block)
        overlap += blocks[0] @ blocks[1].T
    both = overlap.astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - both
    found = (both > 0) & (100 * both >= percent * union)
    if right is None:
        found = np.triu(found, 1)
    return list(zip(*(x.tolist() for x in np.nonzero(found))))


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs that connect what all of ``pairs`` connect, without the others."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            kept.append((a, b))
    return kept


def _by_pair(members: DataFrame, column: str, schema: str, compare) -> DataFrame:
    """Runs ``compare`` on each opened pair of groups.

    ``members`` has a row for each pair and member: ga, gb, grp, node, n and a column.  A pair's
    rows come together in one sorted partition; ``compare`` gets the nodes, sizes and values
    of its one or two groups and returns rows for ``schema``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, {}
        names = [x.split()[0] for x in schema.split(", ")]

        def rows():
            sides = [held[g] for g in dict.fromkeys(pair) if g in held]
            if len(sides) < len(set(pair)):
                return []
            return compare(pair, [[list(c) for c in zip(*side)] for side in sides])

        def batch_of(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.int64()) for k in range(len(names))], names)

        for batch in batches:
            out = []
            *keys, values = batch.columns
            for ga, gb, grp, node, n, value in zip(*(c.to_pylist() for c in keys), values):
                if (ga, gb) != pair:
                    if pair is not None:
                        out.extend(rows())
                    pair, held = (ga, gb), {}
                held.setdefault(grp, []).append((node, n, value))
            yield batch_of(out)
        if pair is not None:
            yield batch_of(rows())

    together = (
        members.select("ga", "gb", "grp", "node", "n", column)
        .repartition("ga", "gb").sortWithinPartitions("ga", "gb")
    )
    return map_batches(together, run, schema)


def _may_link(members: DataFrame, percent: int) -> DataFrame:
    """ga, gb, grp, node of members that the sketches allow to link with another one.

    Linked sets of a and b shingles differ in (a + b) * (100 - percent) / (100 + percent) at most.
    """

    def compare(pair, sides):
        bits = [np.frombuffer(b"".join(v.as_py() for v in side[2]), np.uint64).reshape(len(side[0]), -1)
                for side in sides]
        sizes = [np.array(side[1], np.int64) for side in sides]
        reached = [np.zeros(len(side[0]), bool) for side in sides]
        last = len(sides) - 1
        for i, row in enumerate(bits[0]):
            differ = np.bitwise_count(bits[last] ^ row).sum(1, dtype=np.int64)
            may = (100 + percent) * differ <= (100 - percent) * (sizes[last] + sizes[0][i])
            if last == 0:
                may[i] = False
            if may.any():
                reached[0][i] = True
                reached[last] |= may
        return [(*pair, pair[k], node) for k, side in enumerate(sides)
                for node, x in zip(side[0], reached[k]) if x]

    return _by_pair(members, "sketch", "ga LONG, gb LONG, grp LONG, node LONG", compare)


def _verified(members: DataFrame, percent: int) -> DataFrame:
    """Edges of each opened pair of groups, as many as connect what its links connect."""

    def compare(pair, sides):
        nodes = [side[0] for side in sides]
        sets = [[v.values.to_numpy() for v in side[2]] for side in sides]
        found = links(sets[0], sets[1] if len(sets) == 2 else None, percent)
        return _forest([(nodes[0][i], nodes[-1][j]) for i, j in found])

    return _by_pair(members, "tokens", "u LONG, v LONG", compare)


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 80, often: int = 20,
                   members: int = 256, member_tokens: int = 500_000, overlap: int = 3) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id.

    Documents link by shingles of ``size`` words when 100 * intersection >= ``percent`` *
    union; component_id is the smallest doc_id reachable by links, itself included.
    Texts that are null or without a word are empty and linked with nothing.  Repeated rows
    and rows of the same doc_id are documents of their own; null doc_ids don't count for
    the smallest; an empty table gives no rows; other columns are ignored.

    ``often``: prefix shingles counted that many times go to the end of the order.  ``overlap``:
    common prefix shingles that open two groups; any number from 1 gives the same links.
    ``members`` and ``member_tokens`` bound a group: larger ones are split, and their parts
    meet pairwise like other groups.  Hashes of shingles and of sets have 64 bits.
    """
    rows = _rows(docs)
    counts = _counted(rows, size, percent).groupBy("token").count()
    frequent = _bitmap(counts.where(F.col("count") >= often), "token")
    sets = staged(_sketched(rows, size, percent, frequent, overlap), "sketches")
    filled = sets.where("n > 0")
    prefixes = filled.select(F.explode("prefix").alias("token"), "node", "n", "grp")
    twice = prefixes.groupBy("token").count().where("count > 1")
    prefixes = staged(_only(prefixes, "token", _bitmap(twice, "token")).distinct(), "prefixes")

    nodes = prefixes.select("node", "n", "grp").distinct()
    parts = nodes.groupBy("grp").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / members, F.sum("n") / member_tokens)).alias("parts"))
    grouped = staged(
        nodes.join(staged(parts, "groups"), "grp").select(
            "node", "n", F.xxhash64("grp", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("grp")),
        "groups")
    matrix = staged(
        prefixes.select("token", "node").join(grouped, "node").groupBy("token", "grp")
        .agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
             (F.min("node") != F.max("node")).alias("several")), "token-groups")
    one, two = matrix.alias("one"), matrix.alias("two")
    fits = F.expr(f"100L * one.hi >= {percent} * two.lo AND 100L * two.hi >= {percent} * one.lo")
    # what the smaller of two linked sets needs at most; the rows of its shingles have no larger lo
    needed = F.expr(f"least({overlap}L, ceil({percent} * least(min(one.lo), min(two.lo)) / 100))")
    common = (
        one.join(two, F.col("one.token") == F.col("two.token"))
        .where(F.col("one.grp") < F.col("two.grp")).where(fits)
        .groupBy(F.col("one.grp").alias("ga"), F.col("two.grp").alias("gb"))
        .agg(F.count(F.lit(1)).alias("rows"), needed.alias("needed"))
    )
    pairs = staged(
        common.where("rows >= needed").select("ga", "gb")
        .union(matrix.where("several").select("grp", F.col("grp").alias("gb")).distinct()),
        "group-pairs")

    opened = pairs.select("ga", "gb", F.explode(F.array_distinct(F.array("ga", "gb"))).alias("grp"))
    sketches = staged(
        _only(filled.select("node", "text_key", "sketch"), "node", _bitmap(grouped, "node"))
        .groupBy("node").agg(F.first(F.struct("text_key", "sketch")).alias("x"))
        .join(grouped, "node").select("node", "n", "grp", "x.*"), "candidates")
    reached = staged(
        _may_link(opened.join(sketches.drop("text_key"), "grp"), percent), "opened")
    needed = sketches.join(reached.select("node").distinct(), "node", "left_semi")
    whole = (
        _whole(_only(rows.select("text_key", "text"), "text_key", _bitmap(needed, "text_key")), size)
        .groupBy("node").agg(F.first("tokens").alias("tokens"))
    )
    whole = staged(needed.select("node", "n").join(whole, "node"), "whole-sets")
    roots = connected_components(_verified(reached.join(whole, "node"), percent))

    # the nodes' least doc_ids give each component's
    firsts = filled.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = staged(firsts.join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), "roots")
    least = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = staged(rooted.select("node", "root").join(least, "root").select(
        "node", "component_id"), "components")
    alone = sets.where("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return filled.select("doc_id", "node", "n").join(named, "node").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").union(alone)
