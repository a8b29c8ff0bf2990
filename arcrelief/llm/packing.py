"""Packing token sequences by first-fit decreasing with a tournament tree of bin capacities.

Documents are dealt into groups by a hash of their id; each group is packed alone.  A
document's whole multiples of the sequence length fill sequences of their own; what is left
of it is placed by first-fit decreasing.  The tree holds the free room of every bin at its
leaves and the larger of two children above, so the first bin with enough room is found by
one walk from the root.  At the end the emptiest bins are taken apart and their pieces cut to
fill the room that others have left, where it is at least ``least_cut``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import give_back, map_batches


class BinTree:
    """Free room of bins; ``place(size)`` is the first bin with that much room left."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        free, node = self.free, 1
        if free[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        found = node - self.leaves
        free[node] -= size
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
        return found


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Indexes of ``sizes`` by bin; larger first, equal ones in their order."""
    tree = BinTree(max(1, len(sizes)), room)
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def pack_group(lengths: list[int], room: int, least_cut: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold each id of each document once."""
    full = [[(d, s, room)] for d, n in enumerate(lengths) for s in range(0, n - room + 1, room)]
    rest = [(d, n - n % room, n % room) for d, n in enumerate(lengths) if n % room]
    bins = [[rest[i] for i in b] for b in first_fit_decreasing([x[2] for x in rest], room)]
    free = [room - sum(x[2] for x in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (-free[i], i))
    give, take = 0, len(order) - 1
    while give < take:
        donor, into = order[give], order[take]
        if free[into] < least_cut:
            take -= 1
            continue
        document, start, length = bins[donor].pop()
        cut = min(length, free[into])
        bins[into].append((document, start, cut))
        free[into] -= cut
        free[donor] += cut
        if cut < length:
            bins[donor].append((document, start + cut, length - cut))
        if not bins[donor]:
            give += 1
    return full + [b for b in bins if b]


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def pack(docs: DataFrame, vocabulary: str = tokens.BYTE_BPE, room: int = 1024, end_id: int = 0,
         docs_per_group: int = 1024, least_cut: int = 16) -> DataFrame:
    """Packs ``docs`` (doc_id, text); one row for each piece, with its ids (4 bytes each).

    Columns: doc_id, start, length, ids, doc_tokens, sequence_id, offset.  Null texts are
    empty and give the end id alone; rows with equal or null ids are packed as documents of
    their own; no rows give none; other columns are ignored.  Groups are random by doc_id and
    place in the input, so neither a hot source nor equal rows gather in one; their number
    follows the rows.
    """
    groups = max(1, -(-docs.count() // docs_per_group))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        end = int(end_id).to_bytes(encoder.width, "little")
        for batch in batches:
            ids = [encoder.encode(x) + end for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()),
                 pa.array([encoder.width] * len(ids), pa.int32())],
                ["group", "doc_id", "ids", "width"])

    def pack_table(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        group, width = table["group"][0].as_py(), table["width"][0].as_py()
        doc_ids, ids = table["doc_id"].to_pylist(), table["ids"].to_pylist()
        lengths = [len(x) // width for x in ids]
        out = {name: [] for name in _PIECES.names}
        for number, sequence in enumerate(pack_group(lengths, room, least_cut)):
            offset = 0
            for document, start, length in sequence:
                piece = np.frombuffer(ids[document], f"<u{width}", length, start * width)
                row = (doc_ids[document], start, length, piece.astype("<u4").tobytes(),
                       lengths[document], number * groups + group, offset)
                for column, value in zip(out.values(), row):
                    column.append(value)
                offset += length
        give_back()
        return pa.Table.from_pydict(out, _PIECES)

    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    encoded = map_batches(rows, encode, "group LONG, doc_id LONG, ids BINARY, width INT")
    return encoded.groupBy("group").applyInArrow(
        pack_table,
        "doc_id LONG, start LONG, length LONG, ids BINARY, doc_tokens LONG, sequence_id LONG,"
        " offset LONG",
    )
