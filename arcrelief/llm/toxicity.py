"""Toxicity by a linear classifier over character n-grams with naive Bayes scaling.

A text's features are the character n-grams that it holds (of its UTF-8 bytes, A-Z lower-cased,
with spaces around the text), hashed into buckets; present or not, so long texts don't
outweigh short ones.  A bucket's value is its naive Bayes log-count ratio between toxic and
other labelled texts, and a logistic regression learns the weights of these values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bounded_rows, map_batches, staged

SIZES = (3, 4, 5, 6)
BITS = 20
_PAD = b" " * max(SIZES)
_BASE, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def gram_buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram size the bucket at each place of the joined texts, and the place of
    each text's first gram.  Between texts there are more spaces than a gram has bytes."""
    data = [t.encode().lower() for t in texts]
    joined = np.frombuffer(_PAD + b"".join(x + _PAD for x in data), np.uint8)
    begins = np.cumsum([0] + [len(x) + len(_PAD) for x in data])[:-1]
    found = []
    with np.errstate(over="ignore"):
        codes = joined.astype(np.uint32) + np.uint32(1)
        rolled = codes
        for n in range(2, max(SIZES) + 1):
            rolled = rolled[:-1] * _BASE
            rolled += codes[n - 1:]
            if n in SIZES:
                mixed = rolled ^ (rolled >> np.uint32(15))
                mixed *= _MIX
                mixed >>= np.uint32(32 - BITS)
                found.append(mixed.view(np.int32))
    return found, begins


def each_present(texts: list[str], last: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets that each text holds, without repeats and without sorting.

    ``last`` is scratch of one place for each bucket: the place where a bucket was put last is
    the one that counts.
    """
    found, begins = gram_buckets(texts)
    ends = [*begins[1:], None]  # a gram belongs to the last text that has begun
    for begin, end in zip(begins, ends):
        own = np.concatenate([x[begin:end] for x in found])
        places = np.arange(len(own), dtype=np.int32)
        last[own] = places
        yield own[last[own] == places]


def present(texts: list[str], number: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs without repeats, in order; ``number``: the feature of each bucket,
    below ``width``, or -1."""
    found, begins = gram_buckets(texts)
    lengths = np.diff([*begins, len(found[0])])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    held = np.zeros(len(texts) * width, bool)
    for buckets in found:
        features = number[buckets]
        places = np.flatnonzero(features >= 0)
        held[owner[places].astype(np.int64) * width + features[places]] = True
    return np.divmod(np.flatnonzero(held), max(width, 1))


def _slices(texts: list[str], most: int = 200_000, most_texts: int = 500) -> Iterator[list[str]]:
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= most or len(run) >= most_texts:
            yield run
            run, held = [], 0
    if run:
        yield run


@dataclass(frozen=True)
class Model:
    """``bias`` and a weight for each bucket; buckets of weight zero don't count."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray

    def number(self) -> np.ndarray:
        return numbered(self.buckets)


def numbered(buckets: np.ndarray) -> np.ndarray:
    """The place in ``buckets`` of each bucket, -1 for those that aren't in it."""
    number = np.full(1 << BITS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))
    return number


def log_count_ratio(toxic, other, n_toxic, n_other, alpha: float = 1.0) -> np.ndarray:
    return np.log((toxic + alpha) / (n_toxic + 2 * alpha)) - np.log(
        (other + alpha) / (n_other + 2 * alpha))


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray,
             ridge: float = 1e-3, rounds: int = 150) -> tuple[float, np.ndarray]:
    """Bias and weights of a ridge logistic regression; entry i puts values[i] at (row, column)."""
    n, m = len(y), int(columns.max(initial=-1)) + 1
    weights, bias = np.zeros(m), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    size = np.bincount(rows, values * values, n).max(initial=0) + 1
    step = 4 / (size + 4 * ridge * n) * n  # of the mean loss's curvature
    ahead, bias_ahead, momentum = weights, bias, 1.0
    for _ in range(rounds):
        margin = np.bincount(rows, values * ahead[columns], n) + bias_ahead
        error = (1 / (1 + np.exp(-margin)) - y) / n
        slope = np.bincount(columns, values * error[rows], m) + ridge * ahead
        new, new_bias = ahead - step * slope, bias_ahead - step * error.sum()
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        pull = (momentum - 1) / later
        ahead, bias_ahead = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias, momentum = new, new_bias, later
    return bias, weights


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000,
        most_features: int = 3_000, least_texts: int = 3) -> Model:
    """Learns from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    About ``most_labels`` rows are used for fitting: documents with the labels of the smallest
    hashes of doc_id, thinned evenly where labelled doc_ids repeat.  The ``most_features`` buckets that differ most between the classes (by their
    chi-squared statistic) get weights.  Null labels are left out.  Labels of one class
    only, or none, give a model that scores every text alike.
    """
    chosen = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .select("doc_id", F.col("toxic").cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_toxic")
        .limit(most_labels)
    )
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id")
    sample = (
        bounded_rows(labelled, most_labels)
        .select("_toxic", "text")
        .repartition(16)  # of bounded size
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), np.int64)
        last = np.zeros(1 << BITS, np.int32)
        seen = np.zeros(2, np.int64)
        for batch in batches:
            toxic, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            at = 0
            for run in _slices(texts):
                kinds = toxic[at:at + len(run)]
                at += len(run)
                seen += (np.count_nonzero(kinds != 1), np.count_nonzero(kinds == 1))
                for kind, buckets in zip(kinds, each_present(run, last)):
                    totals[int(kind == 1)][buckets] += 1
        some = np.flatnonzero(totals.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(totals[0][some]), pa.array(totals[1][some])],
            ["bucket", "other", "toxic"])
        yield pa.RecordBatch.from_arrays(  # the number of texts, as a bucket of its own
            [pa.array(np.array([-1])), pa.array(seen[:1]), pa.array(seen[1:])],
            ["bucket", "other", "toxic"])

    counts = staged(
        map_batches(sample, count, "bucket LONG, other LONG, toxic LONG")
        .groupBy("bucket")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .where(F.expr(f"bucket < 0 OR other + toxic >= {least_texts}")), "gram-counts")
    whole = counts.where("bucket < 0").first()
    nothing = Model(0.0, np.zeros(0, np.int64), np.zeros(0, np.float32))
    if whole is None or not whole["toxic"] or not whole["other"]:
        return nothing
    n1, n0 = float(whole["toxic"]), float(whole["other"])
    with_it, without = F.col("toxic") + F.col("other"), n1 + n0 - F.col("toxic") - F.col("other")
    differ = (F.col("toxic") * n0 - F.col("other") * n1) ** 2 / (with_it * (without + 1))
    best = (
        counts.where("bucket >= 0").orderBy(differ.desc(), "bucket").limit(most_features).toArrow()
    )
    buckets = best["bucket"].to_numpy()
    ratio = log_count_ratio(best["toxic"].to_numpy(), best["other"].to_numpy(), n1, n0)
    number, width = numbered(buckets), len(buckets)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            for run in _slices(texts):
                owner, feature = present(run, number, width)
                ends = np.searchsorted(owner, np.arange(len(run) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [toxic.slice(at, len(run)), lists], ["toxic", "features"])
                at += len(run)

    rows = map_batches(sample, hits, "toxic INT, features ARRAY<INT>").toArrow().combine_chunks()
    lists = rows["features"].combine_chunks()
    owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy())
    column = lists.flatten().to_numpy()
    y = (rows["toxic"].to_numpy() == 1).astype(float)
    bias, weights = logistic(owner, column, ratio[column], y)
    weights = np.pad(weights, (0, len(buckets) - len(weights))) * ratio
    return Model(bias, buckets, weights.astype(np.float32))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` and score, 0 to 1, of its whole text; nothing is shuffled.

    A null text is empty and scores as texts without any known n-gram do.  Repeated rows are
    scored each; other columns are ignored.  "score" can't be kept.
    """
    names = list(keep)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number, weights = model.number(), model.weights.astype(float)
        for batch in batches:
            texts, scores = batch.column(len(names)).to_pylist(), []
            for part in _slices(texts):
                owner, feature = present(part, number, len(weights))
                margin = model.bias + np.bincount(owner, weights[feature], len(part))
                scores.append(1 / (1 + np.exp(-margin)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(np.concatenate(scores or [np.zeros(0)]))],
                [*names, "score"])

    kept = docs.select(*names)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    rows = docs.select(*names, F.coalesce("text", F.lit("")).alias("_text"))
    return map_batches(rows, run, ", ".join([*schema, "score DOUBLE"]))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2
