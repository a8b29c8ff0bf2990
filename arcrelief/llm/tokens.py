"""Ids of whole texts by the tokenizers library, with a memory of chunks seen before.

The byte-level vocabulary splits text by a fixed pattern before its merges.  A space between
two characters that aren't white space always begins a new piece of that pattern, so a text
can be cut there and each chunk encoded alone, with the same ids.  Chunks repeat, so most
are looked up; only new ones reach the library.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

_SPACE = "\t-\r \x85\xa0"
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: The vocabulary's split pattern, spelled out for code points below 256.
_LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    f"| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_MARKS = frozenset(".,;:!?")  # always pieces apart from a letter before them
_CUT = re.compile(r"(?<=\S)(?= \S)")


class _Loose(Exception):
    """White space stands beside a cut."""


#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves,
#: the others in order from 256.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - _PRINTABLE))}


def _merger(library):
    """Ids of one piece of text: merges by rank where the vocabulary numbers pieces in the order of
    its merges, as tiktoken has them; else by the library's own model."""
    import json

    model = json.loads(library.to_str())["model"]
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    own = {chr(c): b for b, c in _BYTES.items()}
    spelled = {bytes(own.get(c, ord(c) & 255) for c in piece): i for piece, i in vocabulary.items()
               if all(c in own or ord(c) in _PRINTABLE for c in piece)}
    whole = all(bytes([b]) in spelled for b in range(256)) and not model.get("ignore_merges")
    specials = library.get_added_tokens_decoder()
    if whole and merged == sorted(merged) and len(spelled) >= len(vocabulary) - len(specials):
        import tiktoken

        ranks = {piece: i for piece, i in spelled.items() if i not in specials}
        core = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return core.encode_ordinary
    return lambda piece: [
        t.id for t in library.model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))]


_LONGEST = 64  # characters of what is remembered, so that memories are bounded in bytes too


class _Pieces(dict):
    """Ids by piece of the split pattern, merged when missing; forgets all at a size."""

    def __init__(self, merge, code, most):
        self.merge, self.code, self.most = merge, code, most

    def __missing__(self, piece):
        ids = array(self.code, self.merge(piece)).tobytes()
        if len(piece) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class _Chunks(dict):
    """Ids by chunk without its leading space, put together from others when missing."""

    def __init__(self, owner, most):
        self.owner, self.most = owner, most

    def __missing__(self, part):
        last = part[-1:]
        if part.isalpha() and max(part) < "Ā":
            pieces = self.owner.pieces
            ids = array(pieces.code, pieces.merge(" " + part)).tobytes()
        elif last in _MARKS and part[:-1].isalpha() and part[-2] < "Ā":
            ids = self[part[:-1]] + self.owner.pieces[last]
        elif not part or part[0].isspace() or last.isspace():
            raise _Loose
        else:
            ids = self.owner.split(" " + part)
        if len(part) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[part] = ids
        return ids


class Encoder:
    """``encode(text)`` gives the ids as little-endian bytes, ``width`` bytes for each.

    Strings of special tokens in a text are those tokens, as in the library by default.
    Memory is bounded by the two sizes (entries of about 200 bytes).
    """

    def __init__(self, path: str = BYTE_BPE, chunks: int = 250_000, pieces: int = 200_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized or not t.special for t in added.values()):
            raise ValueError("added tokens that aren't plain special ones")
        self.specials = {t.content: i for i, t in added.items()}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or "(?!)")
        if "ByteLevel" not in type(self.library.pre_tokenizer).__name__:
            raise ValueError("not a byte-level vocabulary")
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.pieces = _Pieces(_merger(self.library), self.code, pieces)
        self.chunks = _Chunks(self, chunks)

    def split(self, chunk: str) -> bytes:
        """Ids of a chunk by its pieces; where the pattern isn't spelled out, by the library."""
        if not chunk.isascii() and max(chunk) >= "Ā":
            return array(self.code, self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
        return b"".join([
            self.chunks[x[1:]] if x[0] == " " and x[1:].isalpha() else self.pieces[x]
            for x in _LATIN.findall(chunk)])

    def encode(self, text: str) -> bytes:
        if not self.special.search(text):
            return self.plain(text)
        out, start = [], 0
        for m in self.special.finditer(text):
            out.append(self.plain(text[start:m.start()]))
            out.append(array(self.code, [self.specials[m[0]]]).tobytes())
            start = m.end()
        out.append(self.plain(text[start:]))
        return b"".join(out)

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if rest and (not first or first[-1].isspace()):
                raise _Loose
            head = (self.split(first),) if first else ()
            return b"".join(chain(head, map(self.chunks.__getitem__, rest)))
        except _Loose:
            return b"".join(map(self.split, _CUT.split(text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
