"""Encoding by merges in score order for merge-type SentencePiece vocabularies, and decoding.

A text starts as a row of characters.  An agenda holds the adjacent pairs whose joined string
is in the vocabulary; the pair with the best score, the leftmost among equals, is merged next
and its new neighbours are entered, until the agenda is empty.  Characters outside the
vocabulary become byte pieces.

A merge never joins two characters that no piece of the vocabulary holds side by side.  So a
text is cut at those places, each part is merged alone and its ids are remembered.  Every new
part is also encoded by the sentencepiece library, a batch of parts at a time, and any
difference is an error.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import map_batches

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

SPACE = "▁"  # stands for a space inside pieces
_NORMAL, _BYTE, _MERGES = 1, 6, 2  # types of pieces, and of the model, in the model's format


class MergeVocabulary:
    """Pieces and scores of a model file, and the merge agenda over them."""

    def __init__(self, path: str = PIECE_BPE):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules = model.normalizer_spec
        if (model.trainer_spec.model_type != _MERGES or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or not rules.add_dummy_prefix or not model.trainer_spec.byte_fallback
                or any(p.type > 3 and p.type != _BYTE for p in model.pieces)):
            raise ValueError("not a merge-type model without normalisation and with byte pieces")
        self.end_id = self.library.eos_id()
        self.rank = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces)
                     if p.type == _NORMAL}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.beside = {a + b for piece in self.rank for a, b in zip(piece, piece[1:])}
        if any(x[1] == SPACE and x[0] != SPACE for x in self.beside):
            raise ValueError("pieces must not hold a space after another character")

    def merge(self, part: str) -> list[int]:
        """Ids of one part, by the agenda."""
        rank, symbols = self.rank, list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, str]] = []

        def enter(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            if joined in rank:
                heapq.heappush(agenda, (rank[joined][0], left, joined))

        for i in range(n - 1):
            enter(i, i + 1)
        while agenda:
            _, left, joined = heapq.heappop(agenda)
            right = after[left]
            if not symbols[left] or right < 0 or symbols[left] + symbols[right] != joined:
                continue  # one of them has been merged since
            symbols[left], symbols[right] = joined, ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                enter(left, after[left])
            if before[left] >= 0:
                enter(before[left], left)
        ids = []
        for symbol in filter(None, symbols):
            if symbol in rank:
                ids.append(rank[symbol][1])
            else:
                ids.extend(self.bytes[b] for b in symbol.encode())
        return ids

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut wherever no piece holds the two characters side by side."""
        beside, out, start = self.beside, [], 0
        for i, pair in enumerate(zip(chunk, chunk[1:]), 1):
            if pair[0] + pair[1] not in beside:
                out.append(chunk[start:i])
                start = i
        out.append(chunk[start:])
        return out


class Codec:
    """Whole texts to ids and back; remembers up to ``chunks`` chunks and ``parts`` parts."""

    #: A run of space marks and what follows up to the next.
    _CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")

    def __init__(self, path: str = PIECE_BPE, chunks: int = 500_000, parts: int = 600_000):
        self.vocabulary = MergeVocabulary(path)
        self.most_chunks, self.most_parts = chunks, parts
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Merges the new parts of these chunks and checks them against the library."""
        vocabulary, known = self.vocabulary, self.parts
        cut = [vocabulary.parts(c) for c in chunks]
        new = list({p for parts in cut for p in parts if p not in known})
        # The library puts a space mark in front: a part that begins with one is asked
        # without it, another one after a line end, which is a byte and joins with nothing.
        own = [p[0] == SPACE and len(p) > 1 for p in new]
        asked = [p[1:] if o else "\n" + p for p, o in zip(new, own)]
        for p, o, theirs in zip(new, own, vocabulary.library.encode(asked, num_threads=1)):
            ids, theirs = vocabulary.merge(p), theirs if o else theirs[2:]
            if ids != theirs:
                raise ValueError(f"the library encodes {p!r} as {theirs}, not {ids}")
            known[p] = array("i", ids).tobytes()
        for chunk, parts in zip(chunks, cut):
            self.chunks[chunk] = b"".join([known[p] for p in parts])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        for memory, most in ((self.chunks, self.most_chunks), (self.parts, self.most_parts)):
            if len(memory) > most:
                memory.clear()
        cut = [self._CHUNK.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.chunks
        new = [c for c in set(chain.from_iterable(cut)) if c not in known]
        if new:
            self._learn(new)
        joined = (b"".join(map(known.__getitem__, chunks)) for chunks in cut)
        return [[*memoryview(ids).cast("i"), self.vocabulary.end_id] for ids in joined]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.vocabulary.library.decode(x) for x in ids]


_CODECS: dict[str, Codec] = {}
_ROWS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def codec(path: str) -> Codec:
    """One codec for each Python worker and vocabulary."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def slices(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about that many characters, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_and_decode(docs: DataFrame, vocabulary: str = PIECE_BPE) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its ids, the end id last, and what they decode to.

    Columns: doc_id, ids (array of int), decoded.  A null text is empty and gives the end
    id alone, which decodes to the empty text.  Equal and null doc_ids are rows of their own, no
    rows give none, and other columns are ignored.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in slices(texts):
                ids = own.encode(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(start, end - start), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(own.decode(ids), pa.string())], schema=_ROWS)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, run, "doc_id LONG, ids ARRAY<INT>, decoded STRING")
