"""Conversation structure repair by bidirectional Dijkstra over an edit lattice.

A node of the lattice is (turns consumed, state): nothing said yet, a system turn said, a user
turn open, an assistant turn just said.  Edges are the edits: keep a turn, give it the role that may
come next, delete it, or insert an empty turn.  Two heaps search from the start and from the ends;
after they have met, all crossings of the same cost are finished, and the least concatenated
audit (the edits' initials) wins.  Two audits of one cost that lead to the same node are never
prefixes of each other, as each letter more costs more; so least halves make the least whole.

A conversation of any length is cut into blocks.  A block's least paths between each two states
are found alone, in whatever task holds it, and a fold over the blocks joins them in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import map_batches, staged

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3  # costs; the last one for a truncated turn
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # states
DONE = (EMPTY, ASSISTANT)
BLOCK = 512  # turns

#: Where the initial of a kept role leads to from each state, and what may come next at all.
_KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER},
         "a": {USER: ASSISTANT}}
_NEXT = (USER, USER, ASSISTANT, USER)
_BEFORE = tuple(tuple(p for p in range(4) if _NEXT[p] == q) for q in range(4))
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_WHITE = "' \\t\\n\\u000b\\f\\r'"

#: A turn is one character: its role's initial (s, u or a, else x), in upper case if truncated,
#: or "d" if it must be deleted.


def _out(symbols: str, at: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges from a node: cost, letter, turns consumed and state after it."""
    yield INSERT, "I", at, _NEXT[state]
    if at < len(symbols):
        yield DELETE, "D", at + 1, state
        symbol = symbols[at]
        if symbol != "d":
            more = CUT_OFF if symbol.isupper() else 0
            kept = _KEPT.get(symbol.lower(), {}).get(state)
            if kept is not None:
                yield KEEP + more, "K", at + 1, kept
            yield REROLE + more, "R", at + 1, _NEXT[state]


def _into(symbols: str, at: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges to a node: cost, letter, turns consumed and state before it."""
    for before in _BEFORE[state]:
        yield INSERT, "I", at, before
    if at:
        yield DELETE, "D", at - 1, state
        symbol = symbols[at - 1]
        if symbol != "d":
            more = CUT_OFF if symbol.isupper() else 0
            for before, after in _KEPT.get(symbol.lower(), {}).items():
                if after == state:
                    yield KEEP + more, "K", at - 1, before
            for before in _BEFORE[state]:
                yield REROLE + more, "R", at - 1, before


class _Side:
    """One of the two searches; nodes of one cost settle in the direction of its edges."""

    def __init__(self, forward: bool, starts: Iterable[tuple[int, int]]):
        self.sign = 1 if forward else -1
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        self.heap = [(0, self.sign * at, state, "") for at, state in starts]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[int, int, int, str]:
        cost, at, state, audit = heapq.heappop(self.heap)
        self.settled[self.sign * at, state] = cost, audit
        return cost, self.sign * at, state, audit

    def enter(self, cost: int, at: int, state: int, audit: str) -> None:
        if (at, state) not in self.settled:
            heapq.heappush(self.heap, (cost, self.sign * at, state, audit))


def cheapest(symbols: str, entry: int, exits: Iterable[int]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest path from ``entry`` to one of ``exits`` over all turns;
    the ASCII-least audit among equal costs.  None where there is no path."""
    n, exits = len(symbols), tuple(exits)
    ahead, back = _Side(True, [(0, entry)]), _Side(False, [(n, q) for q in exits])
    best, crossings = float("inf"), [""]
    if n == 0 and entry in exits:
        return 0, ""

    def cross(cost: int, audit: str) -> None:
        nonlocal best, crossings
        if cost < best:
            best, crossings = cost, []
        if cost == best:
            crossings.append(audit)

    for _ in exits:  # the ends settle first, so the searches can't miss each other
        back.top()
        cost, at, state, audit = back.settle()
        for more, letter, before, was in _into(symbols, at, state):
            back.enter(more, before, was, letter)
    while True:
        left, right = ahead.top(), back.top()
        if left + right > best or left == right == float("inf"):
            break
        if left < right or left == right and len(ahead.settled) <= len(back.settled):
            cost, at, state, audit = ahead.settle()
            for more, letter, i, q in _out(symbols, at, state):
                if (i, q) in back.settled:
                    rest, tail = back.settled[i, q]
                    cross(cost + more + rest, audit + letter + tail)
                ahead.enter(cost + more, i, q, audit + letter)
        else:
            cost, at, state, audit = back.settle()
            for more, letter, i, q in _into(symbols, at, state):
                if (i, q) in ahead.settled:
                    rest, head = ahead.settled[i, q]
                    cross(cost + more + rest, head + letter + audit)
                back.enter(cost + more, i, q, letter + audit)
    return None if best == float("inf") else (best, min(crossings))


def repaired_role(state: int, letter: str, role: str) -> tuple[int, str]:
    """State and role after an edit other than a deletion."""
    if letter == "K":
        return _KEPT[role[:1]][state], role
    return _NEXT[state], _ROLES[_NEXT[state]]


def _turns(chats: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the text's digest; null roles and texts are one space."""
    return chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.md5("text")))


_ORDER = ["conv_id", "turn", "role", "digest"]  # nulls first
_STATS = ("blank", "duplicate", "truncated", "illegal")
_BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()),
    *((name, pa.int64()) for name in _STATS), ("first", pa.string()), ("last", pa.string()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
])
_BLOCK_DDL = (
    "conv_id LONG, part INT, seq INT, whole BOOLEAN, blank LONG, duplicate LONG, truncated LONG,"
    " illegal LONG, first STRING, last STRING, low LONG, high LONG, turns LONG,"
    " costs ARRAY<LONG>, audits ARRAY<STRING>")
_PLANS = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), *((name, pa.int64()) for name in _STATS),
    ("cost", pa.int64()), ("audit", pa.string()),
])


class _Block:
    """Turns of one conversation as they come; what the fold needs to know of them."""

    def __init__(self, conv_id: int | None, seq: int):
        self.conv_id, self.seq, self.symbols = conv_id, seq, []
        self.sums = dict.fromkeys(_STATS, 0)
        self.first = self.last = self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: int, copy: bool) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        symbol = initial if initial in ("s", "u", "a") else "x"
        if fault == 2 or copy:
            self.sums["blank" if fault == 2 else "duplicate"] += 1
            symbol = "d"
        elif fault == 1:
            self.sums["truncated"] += 1
            symbol = symbol.upper()
        self.symbols.append(symbol)

    def row(self, part: int, whole: bool) -> tuple:
        symbols = "".join(self.symbols)
        if whole:
            paths = [cheapest(symbols, EMPTY, DONE)]
        else:
            paths = [cheapest(symbols, a, [b]) for a in range(4) for b in range(4)]
        costs, audits = zip(*(x or (None, None) for x in paths))
        return (self.conv_id, part, self.seq, whole, *self.sums.values(), self.first, self.last,
                self.low, self.high, self.turns, list(costs), list(audits))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the conversations of one sorted partition.

    A conversation that neither begins nor ends the partition is whole, and short ones are
    then searched at once; others may go on in a neighbouring partition.
    """
    part = TaskContext.get().partitionId()
    block, inner, out = None, False, []
    for batch in batches:
        for conv_id, turn, initial, fault, again, n in zip(*(c.to_pylist() for c in batch.columns)):
            if block is None or block.conv_id != conv_id:
                if block is not None:
                    out.append(block.row(part, inner and block.seq == 0))
                    inner = True
                block = _Block(conv_id, 0)
            for copy in range(n):
                if len(block.symbols) >= BLOCK:
                    out.append(block.row(part, False))
                    block = _Block(conv_id, block.seq + 1)
                block.add(turn, initial, fault, again or copy > 0)
            if len(out) >= 1000:
                yield _batch(out, _BLOCKS)
                out = []
    if block is not None:
        out.append(block.row(part, False))
    yield _batch(out, _BLOCKS)


class _Fold:
    """Least paths from the start to each state; audits are chains of pieces with their end last."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.paths = {EMPTY: (0, None)}  # state: cost, (piece, chain before, length of the chain)
        self.sums = dict.fromkeys(_STATS, 0)
        self.last = self.low = self.high = None
        self.turns = 0

    def add(self, row: dict) -> None:
        for name in _STATS:
            self.sums[name] += row[name]
        if self.last is not None and self.last + row["first"] not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.last = row["last"]
        if row["low"] is not None:
            self.turns += row["turns"] - (row["low"] == self.high)
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        if row["whole"]:
            self.paths = {ASSISTANT: (row["costs"][0], (row["audits"][0], None))}
            return
        found: dict = {}
        for a, (cost, chain) in self.paths.items():
            for b in range(4):
                more, piece = row["costs"][4 * a + b], row["audits"][4 * a + b]
                if more is None:
                    continue
                path = cost + more, (piece, chain)
                if b not in found or _less(path, found[b]):
                    found[b] = path
        self.paths = found

    def row(self) -> tuple:
        best = None
        for state in DONE:
            if state in self.paths and (best is None or _less(self.paths[state], best)):
                best = self.paths[state]
        pieces, chain = [], best[1]
        while chain is not None:
            pieces.append(chain[0])
            chain = chain[1]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.sums.values(), best[0], "".join(reversed(pieces)))


def _less(one: tuple, two: tuple) -> bool:
    """Whether a path comes before another of as many pieces: by cost, then by audit."""
    if one[0] != two[0]:
        return one[0] < two[0]
    a, b, heads, others = one[1], two[1], [], []
    while a is not b:  # back to what both share
        heads.append(a[0])
        others.append(b[0])
        a, b = a[1], b[1]
    return "".join(reversed(heads)) < "".join(reversed(others))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold, out = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if fold is None or fold.conv_id != row["conv_id"]:
                if fold is not None:
                    out.append(fold.row())
                fold = _Fold(row["conv_id"])
            fold.add(row)
        if len(out) >= 1000:
            yield _batch(out, _PLANS)
            out = []
    if fold is not None:
        out.append(fold.row())
    yield _batch(out, _PLANS)


def plan_edits(chats: DataFrame) -> DataFrame:
    """The cheapest edits for each conversation of ``chats`` (conv_id, turn, role, text).

    A row for each conv_id: gaps (turn numbers missing between the least and the largest one),
    blank, duplicate and truncated (each row counts for its first fault), illegal (neighbours
    whose roles don't follow each other), cost and audit.  Rows are ordered by turn, nulls
    first, then role and the text's digest.  Null roles and texts are one space, rows of a null
    conv_id are one conversation, roles other than system, user and assistant (told by their
    initials) can't be kept, equal rows are duplicates from the second one on, an empty table gives
    no rows, other columns are ignored.

    Copies are counted before they are shuffled and texts are shuffled as digests.  The order
    is made by a range partitioning, so a hot conversation spreads over many tasks.  Only its
    blocks' paths meet in one task, as a stream; its audit is one value.
    """
    trimmed = F.expr(f"TRIM(TRAILING {_WHITE} FROM text)")
    counted = staged(
        _turns(chats)
        .select(
            "conv_id", "turn", "role", "digest",
            F.when(trimmed == "", 2).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0)
            .otherwise(1).alias("fault"))
        .groupBy("conv_id", "turn", "role", "digest").agg(
            F.min("fault").alias("fault"), F.count(F.lit(1)).alias("n")), "turns")
    # the first turn that holds a role and text; a null turn comes before all others
    first = (
        counted.groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
        .select("conv_id", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", "digest",
                F.lit(None).cast("int").alias("fault"), F.lit(0).cast("long").alias("n"))
    )
    marked = counted.unionByName(first).groupBy("conv_id", "turn", "role", "digest").agg(
        F.min("fault").alias("fault"), F.sum("n").alias("n"),
        (F.min("n") > 0).alias("again"))
    rows = (
        marked.withColumn("initial", F.substring("role", 1, 1))
        .repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
        .select("conv_id", "turn", "initial", "fault", "again", "n")
    )
    blocks = staged(map_batches(rows, _blocks, _BLOCK_DDL), "blocks")
    return map_batches(
        blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"), _folded,
        "conv_id LONG, gaps LONG, blank LONG, duplicate LONG, truncated LONG, illegal LONG,"
        " cost LONG, audit STRING")


_REPAIRED = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()),
    ("text", pa.string()), ("edit", pa.string()),
])


def repaired_turns(chats: DataFrame, plans: DataFrame) -> DataFrame:
    """``chats`` after the edits of ``plans`` (conv_id, audit), as ``plan_edits`` returns them.

    A row for each turn that is left or inserted: conv_id, position (from 0), role, text and
    edit (K, R or I).  The turns of a conversation stay together and in order in one partition,
    behind its audit, and pass through one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, audit, at, state, position, out, held = None, "", 0, EMPTY, 0, [], 0

        def insert() -> None:
            nonlocal at, state, position
            while at < len(audit) and audit[at] == "I":
                state, role = repaired_role(state, "I", "")
                out.append((conv_id, position, role, "", "I"))
                at, position = at + 1, position + 1

        for batch in batches:
            for number, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
                if edits is not None:  # the next conversation's audit
                    conv_id, audit, at, state, position = number, edits, 0, EMPTY, 0
                    insert()
                    continue
                letter, at = audit[at], at + 1
                if letter != "D":
                    state, role = repaired_role(state, letter, role)
                    out.append((conv_id, position, role, text, letter))
                    position += 1
                    held += len(text)
                insert()
                if held > 1 << 20 or len(out) >= 10_000:
                    yield _batch(out, _REPAIRED)
                    out, held = [], 0
        yield _batch(out, _REPAIRED)

    nothing = lambda kind: F.lit(None).cast(kind)
    turns = _turns(chats).withColumn("audit", nothing("string"))
    heads = plans.select(
        "conv_id", nothing("long").alias("turn"), nothing("string").alias("role"),
        nothing("string").alias("text"), nothing("binary").alias("digest"), "audit")
    rows = (
        turns.unionByName(heads).repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER[1:])
        .select("conv_id", "role", "text", "audit")
    )
    return map_batches(rows, run, "conv_id LONG, position LONG, role STRING, text STRING, edit STRING")
