"""Packing documents into training sequences of balanced cost.

A task packs the documents it reads, group by group: a document's full sequences stand alone, and what remains of each
document goes, longest first, to the open sequence of least cost that still has room. The cost of a sequence is linear
in its tokens plus quadratic in each document's, as attention is. Where no sequence has room for a whole remainder, it
is cut over those with the most. What doesn't fill a sequence moves on to the task's next group, and its last is cut
into sequences whose lengths are powers of two. So nothing is shuffled and no task holds more than one group.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LENGTH = 4096
END_ID = 2
# Sequences that are packed together; a task holds the ids of about so many.
GROUP = 512
# Words and parts of words whose ids a task keeps; beyond it the memory starts anew with the next text.
WORDS = 600_000
LINEAR = 1.0
QUADRATIC = 1.0 / 1024
COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Memory(dict):
    """The ids of words, found when a word is first asked for."""

    def __init__(self, find: Callable[[bytes], bytes]) -> None:
        self._find = find

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self._find(word)
        return ids


class Encoder:
    """A tokenizer's ids of whole texts, with the ids of each word kept.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words in a row; words are
    parted at ASCII white space only, all of which it drops. A new word below U+0250 is lower-cased, parted as the
    tokenizer's own pattern does and given to its merges directly, which skips the alignments it otherwise keeps; a part
    is kept like a word. Any other word goes through the whole tokenizer. Both ways give the same ids.
    """

    def __init__(self, path: str, end_id: int) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        normalizer, parting = (json.loads(s.__getstate__()) for s in (self._tokenizer.normalizer, self._tokenizer.pre_tokenizer))
        steps = [s["type"] for s in normalizer["normalizers"]] + [s["type"] for s in parting["pretokenizers"]]
        self._direct = steps == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
        special = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._odd = re.compile("|".join(["[^!-\u024f]", "\u0130", *special])).search
        self._parts = re.compile(_below_u0250(parting["pretokenizers"][0]["pattern"]["Regex"])).findall if self._direct else None
        self._end = np.array([end_id], "<u4").tobytes()
        self._ids = _Memory(self._word)

    def _part(self, part: str) -> bytes:
        key = part.encode()
        ids = self._ids.get(key)
        if ids is None:
            ids = self._ids[key] = self._merged(part)
        return ids

    def _merged(self, part: str) -> bytes:
        return array("I", [t.id for t in self._merge(part if part.isascii() else _bytes_as_letters(part))]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self._direct and word.isalpha():
            # Letters of ASCII are one part.
            lower = text.lower()
            return self._merged(text) if lower == text else self._part(lower)
        if not self._direct or self._odd(text):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._part, self._parts(text.lower())))

    def encode(self, text: str | bytes | None) -> np.ndarray:
        """A text's ids and the end id; NULL is an empty text."""
        if len(self._ids) > WORDS:
            self._ids.clear()
        data = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
        return np.frombuffer(b"".join(map(self._ids.__getitem__, data.split())) + self._end, "<u4")


def _below_u0250(pattern: str) -> str:
    """The same pattern for ``re``, with the letters and numbers below U+0250 named one by one."""
    for kind in ("L", "N"):
        found = re.escape("".join(c for c in map(chr, range(0x250)) if regex.match(rf"\p{{{kind}}}", c)))
        pattern = pattern.replace(rf"\p{{{kind}}}", found)
    return pattern


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


def _bytes_as_letters(part: str) -> str:
    return "".join(map(_BYTE_LETTERS.__getitem__, part.encode()))


@lru_cache(1)
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end_id)


class _Piece:
    __slots__ = ("doc_id", "row", "start", "ids", "total")

    def __init__(self, doc_id: int | None, row: int, start: int, ids: np.ndarray, total: int) -> None:
        self.doc_id, self.row, self.start, self.ids, self.total = doc_id, row, start, ids, total

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        first = _Piece(self.doc_id, self.row, self.start, self.ids[:n], self.total)
        return first, _Piece(self.doc_id, self.row, self.start + n, self.ids[n:], self.total)

    def order(self) -> tuple[int, int, int]:
        return -len(self.ids), self.row, self.start


def balanced(pieces: list[_Piece], n: int, length: int) -> list[list[_Piece]]:
    """``n`` sequences with all ``pieces``, which must fit: longest first to the cheapest sequence with room, cut if none has."""
    sequences: list[list[_Piece]] = [[] for _ in range(n)]
    room, cost = np.full(n, length), np.zeros(n)

    def put(piece: _Piece, k: int) -> None:
        size = len(piece.ids)
        sequences[k].append(piece)
        room[k] -= size
        cost[k] += LINEAR * size + QUADRATIC * size * size

    for piece in sorted(pieces, key=_Piece.order):
        fits = np.where(room >= len(piece.ids), cost, np.inf)
        k = int(fits.argmin())
        while fits[k] == np.inf:
            k = int(room.argmax())
            if room[k] >= len(piece.ids):
                break
            first, piece = piece.cut(int(room[k]))
            put(first, k)
            k = int(room.argmax())
            fits = np.where(room >= len(piece.ids), cost, np.inf)
        put(piece, k)
    return sequences


class _Packer:
    """Sequences of one task; pieces wait until a group of sequences is full."""

    def __init__(self, length: int, group: int, first_id: int) -> None:
        self.length, self.limit, self.next_id = length, group * length, first_id
        self.waiting: list[_Piece] = []
        self.tokens = self.added = 0
        self.rows: list[tuple] = []

    def _close(self, sequence: list[_Piece]) -> None:
        offset = 0
        for p in sequence:
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids), p.total, self.next_id, offset))
            offset += len(p.ids)
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        piece = _Piece(doc_id, self.added, 0, ids, len(ids))
        self.added += 1
        while len(piece.ids) >= self.length:
            whole, piece = piece.cut(self.length)
            self._close([whole])
        if len(piece.ids):
            self.waiting.append(piece)
            self.tokens += len(piece.ids)
        if self.tokens >= self.limit:
            self._flush()

    def _flush(self) -> None:
        """Packs what fills whole sequences; the shortest pieces wait on."""
        n = self.tokens // self.length
        rest, over = [], self.tokens - n * self.length
        pieces = sorted(self.waiting, key=_Piece.order)
        while over:
            piece = pieces.pop()
            if len(piece.ids) > over:
                kept, piece = piece.cut(len(piece.ids) - over)
                pieces.append(kept)
            rest.append(piece)
            over -= len(piece.ids)
        for sequence in balanced(pieces, n, self.length) if n else []:
            self._close(sequence)
        self.waiting, self.tokens = rest, sum(len(p.ids) for p in rest)

    def end(self) -> None:
        self._flush()
        queue = sorted(self.waiting, key=_Piece.order, reverse=True)
        for k in reversed(range(self.tokens.bit_length())):
            need = self.tokens & (1 << k)
            sequence = []
            while need:
                piece = queue.pop()
                if len(piece.ids) > need:
                    piece, left = piece.cut(need)
                    queue.append(left)
                sequence.append(piece)
                need -= len(piece.ids)
            if sequence:
                self._close(sequence)
        self.waiting, self.tokens = [], 0

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    group: int = GROUP,
) -> DataFrame:
    """A row for each piece of each document: ``doc_id`` and ``COLUMNS``.

    NULL and empty texts have the end id alone. A document may have any number of tokens. Repeated rows are packed each
    for itself and a NULL ``doc_id`` stays NULL; an empty table gives no row; columns other than ``doc_id`` and ``text``
    are not looked at. ``sequence_id`` is the task's number and a counter, so a repeated task gives the same ids.
    ``tokenizer`` is the path of a tokenizer file that drops white space.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length, group, TaskContext.get().partitionId() << 40)
        names = ["doc_id", *[c.split()[0] for c in COLUMNS.split(", ")]]

        def rows() -> pa.RecordBatch:
            columns = zip(*packer.taken()) if packer.rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            own = encoder(path, end_id)
            # One text at a time, so no second copy of the batch is held.
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                packer.add(doc_id.as_py(), own.encode(text.as_py()))
            yield rows()
        packer.end()
        yield rows()

    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    return docs.select(*columns).mapInArrow(run, f"doc_id long, {COLUMNS}")
