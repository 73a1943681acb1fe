"""Byte-level BPE through a sentencepiece model that is serialised straight from a vocabulary of ranks.

Each byte stands for one printable character, so a token of any bytes is a piece of text. A piece's score is its negative
rank, its id the rank itself, and the model leaves its input as it is, hence merging the best-scored neighbours is
merging those of least rank. A text is parted by the vocabulary's pattern and every part is encoded for itself. Decoding
goes back from ids over pieces to bytes.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cuts whose ids a task keeps, twice that at most, and the characters that such a one has at most.
CUTS = 300_000
KEPT_CHARS = 64
# Characters of a text that are looked at together, and bytes of texts whose results leave a task together.
WINDOW = 1 << 20
GROUP = 4 << 20
# Fixed values of the model's format: kinds of pieces and of models.
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
# The unknown piece, which comes after all ranks; a space stands for no byte.
_NO_PIECE = " "
# A code point that has no character in any version so far.
_UNASSIGNED = "\u0378"
_BOUNDARY = re.compile(r"\S \S")
_RUN_OF_SPACE = re.compile(r"\s | \s|^ | $")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it shows, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


_CHARACTERS = byte_characters()
_BYTES = {c: b for b, c in enumerate(_CHARACTERS)}


def to_characters(text: str | bytes) -> str:
    """The characters that stand for the bytes, of a text for those of its UTF-8."""
    if isinstance(text, str) and text.isascii() and text.isprintable():
        return text.replace(" ", _CHARACTERS[ord(" ")])
    return "".join(map(_CHARACTERS.__getitem__, text.encode() if isinstance(text, str) else text))


def to_bytes(piece: str) -> bytes:
    return bytes(map(_BYTES.__getitem__, piece))


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines with a token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _piece(text: str, score: float, kind: int) -> bytes:
    return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: a piece for each token in the order of ranks, then the unknown piece.

    Ranks must run from 0 without a gap and hold every single byte, so that no text is unknown.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or sum(len(t) == 1 for t in tokens) != 256:
        raise ValueError("the ranks have gaps or lack a byte")
    if len(tokens) >= 1 << 24:
        raise ValueError("a rank beyond 2**24 is not exact as a score")
    pieces = [_piece(to_characters(t), -float(k), _NORMAL) for k, t in enumerate(tokens)]
    trainer = _number(3, _BPE) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    # Identity: no character map, no space in front, nothing removed, spaces not replaced.
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _piece(_NO_PIECE, 0.0, _UNKNOWN) + _block(2, trainer) + _block(3, normalizer)


def _odd_characters() -> set[str]:
    """The letters and digits that only one of the two pattern engines knows, since their tables differ in age.

    Asked of tiktoken's own engine with a vocabulary of single bytes.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    odd: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        single = {bytes([b]): b for b in range(256)}
        engine = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks=single, special_tokens={})
        odd ^= set(regex.findall(kind, every)).symmetric_difference(engine.decode(engine.encode_ordinary(every)))
    return odd


class Codec:
    """Ids of whole texts and back.

    A single space between two other characters begins a part in any case, so a text is first cut there, and the ids of
    short cuts are remembered: of those met lately, and of those before as long as they are met again.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        # A part that is a token is that token, also where merges alone would not lead to it.
        self._whole = {to_characters(t): struct.pack("<I", k) for t, k in ranks.items()}
        self._find = regex.compile(pattern)
        # Whether a space and letters are one part, as by all public patterns of this kind.
        self._plain = self._find.findall(" ab cd") == [" ab", " cd"]
        self._odd: set[str] | None = None
        self._tokens = [to_bytes(self._model.id_to_piece(k)) for k in range(len(ranks))]
        self._cuts: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _parted(self, text: str, odd: set[str]) -> list[str]:
        if not odd or odd.isdisjoint(text):
            return self._find.findall(text)
        # An unassigned character in its place is none of the kinds, as the odd one is for tiktoken.
        plain = "".join(_UNASSIGNED if c in odd else c for c in text)
        return [text[m.start() : m.end()] for m in self._find.finditer(plain)]

    def _odd_in(self, texts: list[str]) -> set[str]:
        characters = set().union(*texts)
        if max(characters, default="") < _UNASSIGNED:
            return set()
        if self._odd is None:
            self._odd = _odd_characters()
        return self._odd & characters

    def _spell(self, firsts: list[str], cuts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of whole beginnings, and of cuts with their space in front."""
        odd = self._odd_in(firsts + cuts)
        # A space and letters are one part.
        single = [c for c in cuts if c.isalpha()] if self._plain and not odd else []
        mixed = [c for c in cuts if not c.isalpha()] if self._plain and not odd else cuts
        parted = [self._parted(c, odd) for c in firsts] + [self._parted(" " + c, odd) for c in mixed]
        parts = list({" " + c for c in single}.union(*parted))
        found = dict(zip(parts, self._merged([to_characters(p) for p in parts])))
        spelled = [b"".join(map(found.__getitem__, p)) for p in parted]
        by_cut = dict(zip(mixed, spelled[len(firsts) :]))
        return spelled[: len(firsts)], [by_cut.get(c) or found[" " + c] for c in cuts]

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each part, given in the characters of its bytes."""
        others = [p for p in pieces if p not in self._whole]
        merged = iter(self._model.encode(others, num_threads=1)) if others else iter(())
        return [self._whole.get(p) or array("I", next(merged)).tobytes() for p in pieces]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts as little-endian unsigned 32-bit integers; none for NULL."""
        windows = [(k, *_cut(w)) for k, t in enumerate(texts) for w in _windows(t or "")]
        others = set().union(*(cuts for _, _, cuts in windows))
        new = others.difference(self._cuts)
        if len(self._cuts) + len(new) > CUTS:
            self._before, self._cuts, new = self._cuts, {}, others
        again = {c for c in new if c in self._before}
        self._cuts.update((c, self._before[c]) for c in again)
        listed = list(new - again)
        firsts, spelled = self._spell([first for _, first, _ in windows], listed)
        self._cuts.update((c, ids) for c, ids in zip(listed, spelled) if len(c) <= KEPT_CHARS)
        long = {c: ids for c, ids in zip(listed, spelled) if len(c) > KEPT_CHARS}
        out: list[list[bytes]] = [[] for _ in texts]
        for (k, _, cuts), first in zip(windows, firsts):
            out[k].append(first)
            out[k] += [self._cuts.get(c) or long[c] for c in cuts] if long else map(self._cuts.__getitem__, cuts)
        return list(map(b"".join, out))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _windows(text: str) -> Iterator[str]:
    """The text in stretches of about ``WINDOW`` characters, cut where a part begins in any case."""
    at = 0
    while len(text) - at > WINDOW and (cut := _BOUNDARY.search(text, at + WINDOW)):
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


def _cut(text: str) -> tuple[str, list[str]]:
    """The text cut before each single space between two other characters: its beginning, and the cuts without that space."""
    words = text.split(" ")
    if not _RUN_OF_SPACE.search(text):
        return words[0], words[1:]
    cuts = [[words[0]]]
    for word in words[1:]:
        if not cuts[-1][-1] or not word or cuts[-1][-1][-1].isspace() or word[0].isspace():
            cuts[-1].append(word)
        else:
            cuts.append([word])
    joined = list(map(" ".join, cuts))
    return joined[0], joined[1:]


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` for each row of ``docs``.

    ``ids`` are those of the whole text, little-endian unsigned 32-bit integers one after another, and ``decoded`` the
    bytes that they stand for. NULL and empty texts have neither ids nor bytes; texts may have any length; repeated rows
    have a row each; a NULL ``doc_id`` stays NULL; an empty table gives no row; other columns are not looked at. Bytes
    that are no UTF-8 count as U+FFFD. ``ranks`` is the path of a vocabulary on every machine, ``pattern`` parts a text.
    """
    path = ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    parted_by = pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, parted_by)
        for batch in batches:
            sizes = np.diff(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).cumsum() // GROUP)
            edges = [0, *(np.flatnonzero(sizes) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges[:-1], edges[1:]):
                some = batch.slice(start, end - start)
                ids = own.encode([None if t is None else t.decode("utf-8", "replace") for t in some.column("text").to_pylist()])
                columns = [some.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")
