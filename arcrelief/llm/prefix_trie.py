"""A prefix trie of conversations, rolled up by depth bands.

A node is a distinct sequence of first turns.  Its key is its depth and two 64-bit sums (by
exclusive or) of hashes that hold each turn's depth and digest, so a parent's key is the child's
without its last turn, and sums of blocks of turns can be put together in any order.

Totals over subtrees: nodes explode to their ancestors within a band of ``band`` depths, and no
further.  Band roots, now with the totals of their bands, are themselves a trie whose depths are
``band`` times fewer, and are rolled up in bands of their own, until one band holds all.  Then
completed band-root totals go back down, each to its ancestors in the band above.  A trie
of depth D takes about 2 log(D) / log(band) rounds, and no row explodes to more than ``band``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_positions
from .store import map_batches, staged

NODE = ["depth", "k1", "k2"]
RUN = 4096  # depths whose hashes are summed up in one window
NO_ENDS = hashlib.sha256().hexdigest()


def turns_of(chats: DataFrame) -> DataFrame:
    """conv_id, position (from 0), digest and n_chars of each turn of ``chats`` (conv_id, turn,
    role, text), stored.

    Turns are ordered by turn (nulls first), then role and the text's digest; null roles and
    texts are empty; rows of a null conv_id belong to no conversation and are left out.
    """
    rows = chats.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).select(
        "conv_id", "turn",
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        F.length("text").cast("long").alias("n_chars"), "role",
    )
    placed = with_positions(rows, "conv_id", [F.col("turn").asc_nulls_first(), "role", "digest"])
    return staged(placed.select("conv_id", "position", "digest", "n_chars"), "turns")


def _paths(turns: DataFrame) -> DataFrame:
    """Each turn of ``turns`` (conv_id, depth from 1, digest, n_chars) with its node's key and its
    parent's (p1, p2).  Sums run over ``RUN`` depths at a time, so no task needs a whole conversation."""
    hashed = turns.select(
        "conv_id", "depth", "n_chars", F.floor((F.col("depth") - 1) / RUN).alias("run"),
        F.xxhash64(F.lit(1), "depth", "digest").alias("h1"),
        F.xxhash64(F.lit(2), "digest", "depth").alias("h2"),
    )
    run = Window.partitionBy("conv_id", "run").orderBy("depth")
    ahead = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    later = (
        hashed.groupBy("conv_id", "run").agg(F.bit_xor("h1").alias("r1"), F.bit_xor("h2").alias("r2"))
        .join(hashed.where("run > 0").select("conv_id").distinct(), "conv_id", "left_semi")
        .select("conv_id", "run", F.bit_xor("r1").over(ahead).alias("r1"),
                F.bit_xor("r2").over(ahead).alias("r2"))
    )
    local = hashed.withColumns({"l1": F.bit_xor("h1").over(run), "l2": F.bit_xor("h2").over(run)})
    return (
        local.join(later, ["conv_id", "run"], "left")
        .withColumns({"k1": F.col("l1").bitwiseXOR(F.coalesce("r1", F.lit(0))),
                      "k2": F.col("l2").bitwiseXOR(F.coalesce("r2", F.lit(0)))})
        .select("conv_id", "depth", "n_chars", "k1", "k2",
                F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
                F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"))
    )


SUMS = ["n_leaves", "saved_tokens"]


def _merged(*parts: DataFrame) -> DataFrame:
    """Sums by node, and its smallest member."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in SUMS))


def _given_to(rows: DataFrame, depths: Column, paths: DataFrame) -> DataFrame:
    """``rows`` once for each of the given depths, as sums of the ancestor there."""
    to = rows.select("conv_id", F.explode(depths).alias("depth"), *SUMS)
    found = to.where("depth > 0").join(paths, ["conv_id", "depth"])
    root = to.where("depth = 0").select("*", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    columns = [*NODE, "conv_id", *SUMS]
    return found.select(*columns).unionByName(root.select(*columns))


def rolled_up(nodes: DataFrame, paths: DataFrame, deepest: int, band: int = 16) -> DataFrame:
    """``nodes`` (depth, k1, k2, conv_id and the sums) with their subtrees' sums.

    ``paths`` has the key of each conversation's node at each depth (conv_id, depth, k1, k2); a node is
    found there by its smallest member.
    """
    levels, step, level = [], 1, nodes.select(*NODE, "conv_id", *SUMS)
    while True:
        height = step * band
        top = F.col("depth") - F.col("depth") % height
        above = F.sequence(top, F.col("depth") - step, F.lit(step).cast("long"))
        summed = staged(
            _merged(level, _given_to(level.where(f"depth % {height} > 0"), above, paths)), "band-sums")
        levels.append((step, summed))
        if height > deepest:
            break
        level, step = summed.where(f"depth % {height} = 0"), height
    total = levels.pop()[1]
    while levels:
        step, summed = levels.pop()
        height = step * band
        band_above = F.sequence(F.col("depth") - height, F.col("depth") - step, F.lit(step).cast("long"))
        total = staged(
            _merged(summed, _given_to(total.where("depth > 0"), band_above, paths)), "sums")
    return total


_ENDS = "depth LONG, k1 LONG, k2 LONG, part INT, seq LONG, ids STRING"


def _end_digests(ends: DataFrame, most: int = 1 << 20) -> DataFrame:
    """SHA-256 of the ascending conv_ids in each node of ``ends`` (depth, k1, k2, conv_id).

    Ids are range partitioned and joined to strings of about ``most`` characters where they
    are; only those meet, one after the other, in the task that digests a node.
    """

    def run_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, node, ids, held, out = TaskContext.get().partitionId(), 0, None, [], 0, []

        def row() -> dict:
            return {**dict(zip(NODE, node)), "part": part, "seq": seq, "ids": ",".join(ids)}

        for batch in batches:
            for *key, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or held > most:
                    if node is not None:
                        out.append(row())
                    node, ids, held, seq = key, [], 0, seq + 1
                ids.append(str(conv_id))
                held += len(ids[-1]) + 1
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, _TOGETHER)
                out = []
        if node is not None:
            out.append(row())
        yield pa.RecordBatch.from_pylist(out, _TOGETHER)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append({**dict(zip(NODE, node)), "ends_sha256": sha.hexdigest()})
                node, sha = key, hashlib.sha256(ids.encode())
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, _DIGESTS)
                out = []
        if node is not None:
            out.append({**dict(zip(NODE, node)), "ends_sha256": sha.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, _DIGESTS)

    order = [*NODE, "conv_id"]
    placed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = staged(map_batches(placed, run_together, _ENDS), "ends")
    return map_batches(
        runs.repartition(*NODE).sortWithinPartitions(*NODE, "part", "seq").select(*NODE, "ids"),
        digest, "depth LONG, k1 LONG, k2 LONG, ends_sha256 STRING")


_LONGS = [(name, pa.int64()) for name in NODE]
_TOGETHER = pa.schema([*_LONGS, ("part", pa.int32()), ("seq", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([*_LONGS, ("ends_sha256", pa.string())])


def build_trie(members: DataFrame, turns: DataFrame, band: int = 16) -> DataFrame:
    """The trie of ``members`` (conv_id, n_turns: distinct ids, also of those without turns) with
    ``turns`` (conv_id, depth from 1 without gaps, digest, n_chars).

    A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (over its subtree, code points of the last turn's text times
    members but one) and ends_sha256 (of the members that end there).  No members give no rows.
    """
    paths = staged(_paths(turns), "paths")
    keys = paths.select("conv_id", "depth", "k1", "k2")
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where(
        "n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs",
        zero.alias("n_chars"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = staged(
        paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
            *(F.min(c).alias(c) for c in ("n_chars", "p1", "p2")))
        .unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    counted = staged(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)),
        "counted")
    weights = counted.select(
        *NODE, "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = rolled_up(weights, keys, deepest, band).select(*NODE, *SUMS)
    ends = (
        members.where("n_turns > 0").select("conv_id", F.col("n_turns").alias("depth"))
        .join(keys, ["conv_id", "depth"])
        .unionByName(members.where("n_turns = 0").select(
            "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"))
    return (
        staged(counted.join(totals, NODE).join(_end_digests(ends), NODE, "left"), "trie")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *SUMS,
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )


def shared_prefixes(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt behind the first turns of another one: members and turns.

    ``turns`` is as ``turns_of`` returns it.  Conversation c takes the first h turns of c - c %
    ``every`` (fewer if that has fewer, none if there is none) in place of its own first h, where h
    is crc32(c as text) % ``most``.  A conversation lends at most ``most`` - 1 turns to fewer than
    2 * ``every`` others, so no key grows with the input.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    lent = turns.where(F.col("position") < most - 1).select(
        F.col("conv_id").alias("base"), "position", "digest", "n_chars")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = lent.groupBy("base").agg(F.count(F.lit(1)).alias("n_base"))
    members = staged(
        own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": h})
        .join(sizes, "base", "left")
        .withColumn("n_lent", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
        .select("conv_id", "base", "h", "n_lent",
                (F.col("n_lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")),
        "members")
    prefix = members.where("n_lent > 0").join(lent, "base").where("position < n_lent").select(
        "conv_id", (F.col("position") + 1).alias("depth"), "digest", "n_chars")
    rest = turns.join(members, "conv_id").where("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("n_lent") + 1).alias("depth"), "digest",
        "n_chars")
    return members.select("conv_id", "n_turns"), staged(prefix.unionByName(rest), "rebuilt")
