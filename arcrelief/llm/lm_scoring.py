"""Cross-entropy difference: how much better a target model predicts a text than a background one.

Two bigram models of the same form share one vocabulary, all words of the corpus and the end of a
text.  The background model counts every document, the target model those of the target.  A pair's
probability is its count, with ``prior`` more counts that are spread as single words are:

    P(w | v) = (c(v w) + prior * P(w)) / (c(v) + prior),   P(w) = (c(w) + 1) / (all words + vocabulary)

A document's score is its mean loss per token under the target model less that under the background
model, so low scores are close to the target.

No model is ever in one place.  Texts become chunks of about ``chunk_words`` words; a chunk asks for
the counts of its different words and pairs, by keys that are dealt out over parts by their
leading bits, so a word that is in every document costs one question for each chunk.  Parts add up
what chunks have and answer; each chunk scores its documents with the answers.  Keys are hashes
that have at least 2 ** 15 times as many values as the corpus has words, so about one in thirty
thousand counts holds another word or pair besides its own; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import give_back, map_batches, staged

END = b""  # of a text, and what stands before its first word; no word is empty


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, the low bytes of all of them first."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(len(values), 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    planes = np.frombuffer(data, np.uint8).reshape(8, len(data) // 8)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


class _Ids(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A hash of pairs of 64-bit numbers."""
    x = one * np.uint64(0x9E3779B97F4A7C15) ^ (two + np.uint64(0x632BE59BD9B4E019))
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def word_keys(words: list[bytes], width: int) -> np.ndarray:
    """Hashes of words, ``width`` bits each."""
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64) >> np.uint64(64 - width)


def questions(keys: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int):
    """Keys of each token's word, of the word before and of the pair; a pair's lowest bit is 1.

    ``at`` are the places in ``keys`` of all texts' words one after the other, each text between two
    ends; ``lengths`` counts the places of each text, none for one without words.
    """
    spelled = keys[at]
    token = np.ones(len(at), bool)
    token[(np.cumsum(lengths) - lengths)[lengths > 0]] = False  # the end before a text's first word
    before = np.flatnonzero(token) - 1
    word = spelled[before + 1] << np.uint64(1)
    pair = _mixed(spelled[before], spelled[before + 1]) >> np.uint64(64 - width)
    return word, spelled[before] << np.uint64(1), pair << np.uint64(1) | np.uint64(1)


_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()),
    ("n_target", pa.binary()), ("size", pa.int64()), ("tokens", pa.int64()), ("target_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("at", pa.binary()),
])
_CHUNK_DDL = (
    "chunk LONG, part LONG, keys BINARY, n BINARY, n_target BINARY, size LONG, tokens LONG, target_tokens LONG,"
    " doc_ids ARRAY<LONG>, lengths ARRAY<LONG>, words BINARY, at BINARY")


def _chunks(rows: DataFrame, width: int, part_bits: int, chunk_words: int) -> DataFrame:
    """Chunks of ``rows`` (doc_id, text, target): a row with the documents (part -1) and one for each
    part that the chunk asks, with keys, their counts in the chunk and those in its target texts."""

    def chunk_rows(number: int, ids: _Ids, at: list, doc_ids: list, lengths: list, target: list) -> list[dict]:
        spelled = word_keys(list(ids), width)
        keys, rank = np.unique(spelled, return_inverse=True)
        at = rank[np.array(at, np.int64)]
        lengths = np.array(lengths, np.int64)
        word, _, pair = questions(keys, at, lengths, width)
        tokens = np.maximum(lengths - 1, 0)
        weight = np.repeat(np.array(target, np.float64), tokens)
        asked, where = np.unique(np.concatenate([word, pair]), return_inverse=True)
        n = np.bincount(where, minlength=len(asked)).astype(np.uint64)
        n_target = np.bincount(where, np.concatenate([weight, weight]), len(asked)).astype(np.uint64)
        parts = (asked >> np.uint64(width + 1 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(asked), np.int64)
        blank = dict.fromkeys(_CHUNK.names)
        out = [{**blank, "chunk": number, "part": -1, "size": len(asked), "tokens": int(tokens.sum()),
                "target_tokens": int(weight.sum()), "doc_ids": doc_ids, "lengths": lengths.tolist(),
                "words": packed(_deltas(keys)), "at": packed(at)}]
        starts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
        for start, stop in zip(starts, [*starts[1:], len(parts)]):
            out.append({**blank, "chunk": number, "part": int(parts[start]), "size": int(stop - start),
                        "keys": packed(_deltas(asked[start:stop])), "n": packed(n[start:stop]),
                        "n_target": packed(n_target[start:stop])})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0

        def new():
            ids = _Ids()
            ids[END]
            return ids, [], [], [], []

        ids, at, doc_ids, lengths, target = new()
        for batch in batches:
            for doc_id, text, flag in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                doc_ids.append(doc_id)
                target.append(flag)
                lengths.append(len(words) + 2 if words else 0)
                if words:
                    at.append(0)
                    at.extend(map(ids.__getitem__, words))
                    at.append(0)
                if len(at) >= chunk_words or len(doc_ids) >= chunk_words:
                    yield pa.RecordBatch.from_pylist(
                        chunk_rows(task << 32 | seq, ids, at, doc_ids, lengths, target), _CHUNK)
                    ids, at, doc_ids, lengths, target = new()
                    seq += 1
        if doc_ids:
            yield pa.RecordBatch.from_pylist(
                chunk_rows(task << 32 | seq, ids, at, doc_ids, lengths, target), _CHUNK)

    return staged(map_batches(rows, run, _CHUNK_DDL), "chunks")


_ANSWER = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int64()), ("all", pa.binary()), ("target", pa.binary()),
    ("n_words", pa.int64()),
])


def _answers(chunks: DataFrame) -> DataFrame:
    """For each question of a chunk to a part the counts of its keys in all chunks, in order.

    A part's keys are in one task, at most one of each from a chunk.  ``n_words`` counts the
    different words of a part in one of its rows.
    """

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(x.as_py())) for x in table["keys"]]
        sizes = [len(x) for x in keys]
        known, where = np.unique(np.concatenate(keys), return_inverse=True)
        sums = []
        for name in ("n", "n_target"):
            n = np.concatenate([unpacked(x.as_py()) for x in table[name]])
            sums.append(np.bincount(where, n.astype(np.float64), len(known)).astype(np.uint64)[where])
        out, start = [], 0
        for i, (chunk, size) in enumerate(zip(table["chunk"].to_pylist(), sizes)):
            mine = slice(start, start + size)
            out.append({"chunk": chunk, "part": table["part"][0].as_py(), "all": packed(sums[0][mine]),
                        "target": packed(sums[1][mine]),
                        "n_words": int(np.sum(known & np.uint64(1) == 0)) if i == 0 else 0})
            start += size
        give_back()
        return pa.Table.from_pylist(out, _ANSWER)

    asked = chunks.where("part >= 0").select("chunk", "part", "keys", "n", "n_target")
    return staged(asked.groupBy("part").applyInArrow(
        answer, "chunk LONG, part LONG, all BINARY, target BINARY, n_words LONG"), "answers")


_SCORES = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()),
    ("background_loss", pa.float64()), ("score", pa.float64()),
])


def losses(pair: np.ndarray, before: np.ndarray, word: np.ndarray, total: int, vocabulary: int,
           prior: float) -> np.ndarray:
    """Losses in nats of tokens, from the counts of the pair, the word before and the word."""
    single = (word + 1.0) / (total + vocabulary)
    return -np.log((pair + prior * single) / (before + prior))


def score(docs: DataFrame, target: DataFrame, prior: float = 20.0, chunk_words: int = 1_000_000,
          part_bytes: int = 1 << 24, most_broadcast: int = 2_000_000) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_tokens, target_loss, background_loss
    (means per token, in nats) and score, their difference.

    ``target`` has the target's doc_ids; up to ``most_broadcast`` of them are broadcast, more are
    joined.  A text's tokens are its words and its end.  A null or empty text has no token and null
    losses and score.  Repeated rows count and are scored each, rows of a null doc_id aren't in
    the target; an empty target gives a uniform target model; an empty table gives no rows; other
    columns are ignored.  A part holds the keys of about ``part_bytes`` of text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    ids = target.select(F.col("doc_id").cast("long").alias("doc_id")).where(
        "doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    if ids.count() <= most_broadcast:
        ids = F.broadcast(ids)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    width = min(62, 15 + max(1, size // 2).bit_length())
    part_bits = (size // part_bytes).bit_length()
    flagged = rows.join(ids, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    chunks = _chunks(flagged, width, part_bits, chunk_words)
    answers = _answers(chunks)
    documents = chunks.where("part = -1").select("chunk", "doc_ids", "lengths", "words", "at")
    totals = chunks.where("part = -1").agg(F.sum("tokens"), F.sum("target_tokens")).first()
    n_all, n_target = (x or 0 for x in totals)
    vocabulary = answers.agg(F.sum("n_words")).first()[0] or 0

    def score_chunk(chunk: pa.Table, found: pa.Table) -> pa.Table:
        keys = np.cumsum(unpacked(chunk["words"][0].as_py()))
        at = unpacked(chunk["at"][0].as_py()).astype(np.int64)
        lengths = np.array(chunk["lengths"][0].as_py(), np.int64)
        word, before, pair = questions(keys, at, lengths, width)
        asked = np.unique(np.concatenate([word, pair]))
        order = np.argsort(found["part"].to_numpy())
        places = [np.searchsorted(asked, x) for x in (pair, before, word)]
        tokens = np.maximum(lengths - 1, 0)
        starts = (np.cumsum(tokens) - tokens)[tokens > 0]
        means = []
        for name, total in (("target", n_target), ("all", n_all)):
            answered = [unpacked(found[name][int(i)].as_py()) for i in order]
            counts = np.concatenate([*answered, np.zeros(0, np.uint64)]).astype(np.float64)
            if len(counts) != len(asked):
                raise ValueError("answers don't fit the questions")
            each = losses(*(counts[p] for p in places), total, vocabulary, prior)
            mean = np.zeros(len(tokens))
            if len(each):
                mean[tokens > 0] = np.add.reduceat(each, starts) / tokens[tokens > 0]
            means.append(mean)
        give_back()
        none = tokens == 0
        return pa.Table.from_arrays(
            [pa.array(chunk["doc_ids"][0].as_py(), pa.int64()), pa.array(tokens),
             *(pa.array(x, mask=none) for x in (*means, means[0] - means[1]))], schema=_SCORES)

    return documents.groupBy("chunk").cogroup(answers.drop("n_words").groupBy("chunk")).applyInArrow(
        score_chunk, "doc_id LONG, n_tokens LONG, target_loss DOUBLE, background_loss DOUBLE, score DOUBLE")
