"""Quality rules as a learned decision list over statistics of whole texts.

``text_stats`` computes the statistics, ``learn`` grows and prunes conjunctions of threshold
conditions by sequential covering on labelled rows, and ``DecisionList.column`` emits the list
as one Spark CASE expression, the first rule that holds deciding.  Rules describe rows to
reject; what no rule covers is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bounded_rows, map_batches

WINDOW = 8
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_upper", "n_digits", "n_marks", "n_distinct", "n_pairs_repeated"]

#: What conditions may test, as SQL over the statistics.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "same_neighbour_share": "n_pairs_repeated / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}

BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows found twice or more; ``codes``: a number for each distinct word.

    Windows of a power of two words get numbers from those of half their length, so memory
    follows the text, whatever its length.
    """
    n, size, numbers = len(codes), 1, codes
    while size < window:
        if n < 2 * size + 1:
            return 0
        pairs = numbers[:-size] * np.int64(n) + numbers[size:]
        found, numbers, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(found) == len(pairs):
            return 0
        size *= 2
    starts = np.flatnonzero(counts[numbers] > 1)
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(change)))


def stats_of(text: str) -> tuple[int, ...]:
    """The statistics of one text, in the order of STATS."""
    data = text.encode()
    words = data.split()  # at the same six ASCII characters as _SPACES
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    repeats = same = 0
    if len(number) < n:
        codes = np.array([number[w] for w in words], np.int64)
        same = int(np.count_nonzero(codes[1:] == codes[:-1]))
        repeats = repeated_words(codes)
    without = lambda drop: len(data) - len(data.translate(None, drop))
    return (n, len(text) - sum(map(text.count, _SPACES)), without(_SYMBOLS),
            len(lines) - len(set(lines)), repeats, len(lines), without(_UPPER),
            without(_DIGITS), data.count(b"!"), len(number), same)


def text_stats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` and the STATS of its text, nothing shuffled.

    A null text counts as having no words; an empty table gives no rows; other columns
    of ``docs`` are ignored, unless kept.  Names in STATS can't be kept.
    """
    names = list(keep)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [stats_of(x) for x in batch.column(len(names)).to_pylist()]
            table = np.array(rows, np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], *(pa.array(c) for c in table.T)], names + STATS)

    rows = docs.select(*names, F.coalesce("text", F.lit("")).alias("_text"))
    return map_batches(rows, run, ", ".join(schema + [f"{s} LONG" for s in STATS]))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x >= self.threshold if self.at_least else x < self.threshold

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.at_least else '<'} {self.threshold!r}D"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order, each a conjunction; rows that a rule covers are rejected."""

    rules: tuple[tuple[Condition, ...], ...]

    def column(self) -> Column:
        """Number of the first rule that rejects a row, null if it is kept."""
        number = None
        for i, rule in enumerate(self.rules):
            test = F.expr(" AND ".join(f"({c.sql()})" for c in rule))
            number = F.when(test, F.lit(i)) if number is None else number.when(test, F.lit(i))
        return F.lit(None).cast("int") if number is None else number


def _covered(rule, values, n) -> np.ndarray:
    mask = np.ones(n, bool)
    for condition in rule:
        mask &= condition.holds(values)
    return mask


def _grow(values, bad, rows, most_conditions, most_thresholds) -> list[Condition]:
    """Adds the condition of the largest information gain until no good row is covered."""
    rule, rows = [], rows.copy()
    while len(rule) < most_conditions:
        p, n = np.count_nonzero(bad & rows), np.count_nonzero(~bad & rows)
        if not p or not n:
            break
        now, best, gain = np.log2(p / (p + n)), None, 1e-9
        for name, x in values.items():
            inside = np.sort(x[rows & bad])
            outside = np.sort(x[rows & ~bad])
            both = np.unique(np.concatenate([inside, outside]))
            if len(both) < 2:
                continue
            cuts = (both[1:] + both[:-1]) / 2
            # all places where rows to reject begin or end, thinned to a number of quantiles
            if len(cuts) > most_thresholds:
                cuts = np.unique(np.concatenate([
                    cuts[np.linspace(0, len(cuts) - 1, most_thresholds // 2).astype(int)],
                    np.quantile(inside, np.linspace(0, 1, most_thresholds // 2)),
                ]))
            p_less, n_less = np.searchsorted(inside, cuts), np.searchsorted(outside, cuts)
            for at_least, pc, nc in ((False, p_less, n_less), (True, p - p_less, n - n_less)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(pc > 0, pc * (np.log2(pc / (pc + nc)) - now), 0)
                at = int(np.argmax(gains))
                if gains[at] > gain:
                    best, gain = Condition(name, at_least, float(cuts[at])), gains[at]
        if best is None:
            break
        rule.append(best)
        rows &= best.holds(values)
    return rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 20,
          most_conditions: int = 4, most_thresholds: int = 128, precision: float = 0.9,
          least_rows: int = 5) -> DecisionList:
    """Sequential covering: grow a rule on two thirds of the rows, prune it on the others.

    Pruning cuts the conditions from the end as long as (p - n) / (p + n) doesn't fall on the
    pruning rows.  Learning ends at the first rule with too few rows or too little precision;
    rows of one class only, or none, give an empty list.
    """
    n = len(bad)
    growing = np.arange(n) % 3 != 2
    left, rules = np.ones(n, bool), []

    def worth(rule):
        mask = _covered(rule, values, n) & left & ~growing
        p, q = np.count_nonzero(mask & bad), np.count_nonzero(mask & ~bad)
        return (p - q) / (p + q) if p + q else -1.0

    while len(rules) < most_rules and (left & bad).any():
        rule = _grow(values, bad, left & growing, most_conditions, most_thresholds)
        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        mask = _covered(rule, values, n) & left
        p, q = np.count_nonzero(mask & bad), np.count_nonzero(mask & ~bad)
        if p < least_rows or p < precision * (p + q):
            break
        rules.append(tuple(rule))
        left &= ~mask
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> DecisionList:
    """Learns from ``labels`` (doc_id, quality; 0 is to be rejected) of ``docs``.

    About ``most_labels`` rows are used for fitting, so that what reaches the driver is bounded:
    documents with the labels of the smallest hashes of doc_id, thinned evenly where labelled
    doc_ids repeat.  Labels that are null are left out.
    """
    chosen = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .select(F.col("doc_id"), F.col("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_quality")
        .limit(most_labels)
    )
    rows = bounded_rows(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), most_labels)
    table = (
        text_stats(rows, ("doc_id", "_quality"))
        .select("doc_id", "_quality", *(F.expr(e).alias(k) for k, e in FEATURES.items()))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("_quality", "ascending"), ("words", "ascending")])
    )
    values = {k: table[k].to_numpy().astype(float) for k in FEATURES}
    return learn(values, table["_quality"].to_numpy() == 0)


def judge(docs: DataFrame, rules: DecisionList, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, STATS, base_failed, rule (number of the rejecting rule) and kept."""
    return (
        text_stats(docs, keep)
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("rule", rules.column())
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
