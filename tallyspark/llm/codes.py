"""Compressing vectors to a code per part, with the nearest entries of a codebook found through memoised grid cells.

A vector is cut into parts, and each part is replaced by the nearest entry of its position's codebook. Space is cut into
coarse cells. The first part that falls into a cell settles which entries can be nearest anywhere in it: an entry is
dominated if it is farther from the whole cell, at its nearest point, than some other entry is at its farthest. The
entries that are not dominated are remembered under the hash of the cell, and a part is compared with those of its cell
only, exactly in whole numbers.

Codebooks are fitted in rounds. A task sums the parts of each entry that it sees, and Spark adds the tasks' sums, so
what the driver holds are the codebooks alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.vectors import LONG, lengths, matrix, usable
from tallyspark.operators.joins import apart
from tallyspark.sources.staging import staged

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# Cells along the widest side of a codebook, and cells of a codebook that a task remembers at most.
CELLS = 8
MEMORY = 100_000
_MULTIPLIERS = np.random.default_rng(42).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
SUMS = "part int, entry int, place int, n long, total decimal(38,0)"


class Grid:
    """Nearest entries of one codebook, with the candidates of each cell remembered."""

    def __init__(self, entries: np.ndarray, cells: int = CELLS, memory: int = MEMORY) -> None:
        self.entries, self._memory = entries, memory
        sides = [int(max(c)) - int(min(c)) for c in entries.T]
        self.width = max(1, max(sides, default=0) // cells)
        self._reach = max((abs(int(x)) for x in entries.ravel()), default=0)
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[int, int] = {}
        self._corners = np.zeros((0, self.entries.shape[1]), np.int64)
        self._counts = np.zeros(0, np.int64)
        self._listed = np.zeros(0, np.int64)

    def candidates(self, corners: np.ndarray) -> np.ndarray:
        """For each cell, given by its least corner, which entries no other one dominates across the whole cell."""
        low, high = corners[:, None, :], corners[:, None, :] + (self.width - 1)
        gap = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        far = np.maximum(np.abs(low - self.entries), np.abs(high - self.entries))
        return (gap * gap).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1)[:, None]

    def _learn(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The slot of each cell; new ones are settled first. A slot may belong to another cell of the same hash."""
        new = [k for k, h in enumerate(hashes.tolist()) if h not in self._slots]
        if new and len(self._slots) + len(new) > self._memory:
            self._forget()
            new = range(len(hashes))
        for at in range(0, len(new), 1024):
            some = np.array(new[at : at + 1024])
            open_ = self.candidates(cells[some] * self.width)
            for h in hashes[some].tolist():
                self._slots[h] = len(self._slots)
            self._corners = np.concatenate([self._corners, cells[some]])
            self._counts = np.concatenate([self._counts, open_.sum(axis=1)])
            self._listed = np.concatenate([self._listed, np.nonzero(open_)[1]])
        return np.array([self._slots[h] for h in hashes.tolist()], np.int64)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point the number of its nearest entry, the lower of equally near ones, and the squared distance."""
        n, (k, length) = len(points), self.entries.shape
        reach = max(self._reach, abs(int(points.max(initial=0))), abs(int(points.min(initial=0))))
        if max(1, length) * k * (2 * reach + self.width) ** 2 > LONG:
            return self._unbounded(points)
        if not n or not length:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        cells = points // self.width
        hashed = (cells.astype(np.uint64) * _MULTIPLIERS[np.arange(length) % len(_MULTIPLIERS)]).sum(axis=1, dtype=np.uint64)
        hashes, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        slots = self._learn(hashes, cells[first])[which]
        starts = np.cumsum(self._counts) - self._counts
        best, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
        own = (self._corners[slots] == cells).all(axis=1)
        for rows in (np.flatnonzero(own), np.flatnonzero(~own)):
            for at in range(0, len(rows), 4096):
                some = rows[at : at + 4096]
                # Where two cells share a hash, the one that isn't remembered has every entry.
                many = self._counts[slots[some]] if own[some[0]] else np.full(len(some), k)
                ends = np.cumsum(many)
                place = np.arange(ends[-1]) - np.repeat(ends - many, many)
                entry = self._listed[place + np.repeat(starts[slots[some]], many)] if own[some[0]] else place
                off = points[np.repeat(some, many)] - self.entries[entry]
                least = np.minimum.reduceat((off * off).sum(axis=1) * k + entry, ends - many)
                best[some], distance[some] = least % k, least // k
        return best, distance

    def _unbounded(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``nearest`` for numbers whose squares don't fit in a long; a distance beyond a long stops there."""
        entries = [list(map(int, e)) for e in self.entries]
        found = [min((sum((int(x) - y) ** 2 for x, y in zip(p, e)), k) for k, e in enumerate(entries)) for p in points]
        return np.array([k for _, k in found], np.int64), np.array([min(d, LONG) for d, _ in found], np.int64)


@dataclass
class Codebooks:
    """The codebooks of vectors of one length: for each part position its entries and where the part lies."""

    length: int
    entries: list[np.ndarray]

    def edges(self) -> list[tuple[int, int]]:
        return part_edges(self.length, len(self.entries))

    def text(self) -> str:
        """All entries' components in decimal by part, entry and place, with commas between."""
        return ",".join(str(int(x)) for part in self.entries for x in part.ravel())

    def assign(self, vectors: np.ndarray, grids: list[Grid]) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, a column for each part."""
        found = [g.nearest(vectors[:, a:b]) for g, (a, b) in zip(grids, self.edges())]
        return np.stack([k for k, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def part_edges(length: int, parts: int) -> list[tuple[int, int]]:
    """Where each of the parts lies, as equal as the length allows."""
    cuts = [k * length // parts for k in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and the scaled, floored components ``v`` of all usable rows, stored."""
    floors = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    kept = rows.filter(usable(F.col("embedding")))
    return staged(kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", floors.alias("v")), "whole_vectors")


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``SUMS``: how many parts each entry is nearest to and the sums of their components, from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(e) for e in books.entries]
        n = [np.zeros(len(e), np.int64) for e in books.entries]
        totals = [np.zeros(e.shape, object) for e in books.entries]
        for batch in batches:
            whole = matrix(batch.column("v"), books.length)
            nearest, _ = books.assign(whole, grids)
            for p, (a, b) in enumerate(books.edges()):
                n[p] += np.bincount(nearest[:, p], minlength=len(n[p]))
                part = whole[:, a:b]
                small = abs(int(part.max(initial=0))) + abs(int(part.min(initial=0))) < 1 << 30
                added = np.zeros(totals[p].shape, np.int64 if small else object)
                np.add.at(added, nearest[:, p], part if small else part.astype(object))
                totals[p] += added
        rows = [
            (p, e, i, int(n[p][e]), Decimal(int(totals[p][e, i])))
            for p in range(len(n))
            for e in np.flatnonzero(n[p]).tolist()
            for i in range(totals[p].shape[1])
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "n", "total"])

    return vectors.select("v").mapInArrow(run, SUMS)


def fit(vectors: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for the rows ``vec_id, v`` of one length.

    They start as the parts of the ``entries`` smallest ids' vectors. A round assigns every part to its nearest entry and
    replaces each entry by its parts' mean, floored; an entry without parts stays.
    """
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    first = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), length)
    books = Codebooks(length, [first[:, a:b].copy() for a, b in part_edges(length, parts)])
    for _ in range(rounds):
        added = _sums(vectors, books).groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        new = [e.copy() for e in books.entries]
        # At most as many rows as the codebooks have components.
        for r in added.collect():
            new[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(length, new)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of vectors of the codebooks' length.

    ``code`` has two hexadecimal digits for each part's entry, in order, and ``error`` is the sum of the parts' squared
    distances.
    """
    kind = dict(vectors.dtypes)["label"]
    if max(map(len, books.entries), default=0) > 256:
        raise ValueError("an entry's number has two hexadecimal digits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(e) for e in books.entries]
        for batch in batches:
            nearest, distance = books.assign(matrix(batch.column("v"), books.length), grids)
            digits, wide = nearest.astype(np.uint8).tobytes().hex(), 2 * nearest.shape[1]
            codes = [digits[k : k + wide] for k in range(0, len(digits), wide)]
            sums = [min(LONG, sum(d)) for d in distance.tolist()]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over rows of equal label, NULL being one; no sum exceeds a long."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    keyed = apart(coded.select(F.col("label").alias("of_label"), "error"), "of_label")
    sums = keyed.groupBy("of_label", "_apart").agg(total.alias("label_error")).drop("_apart")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, dict[int, Codebooks]]:
    """``vec_id``, ``label``, ``length``, ``code``, ``error`` and ``label_error`` of each usable row, and the codebooks by length.

    Rows whose vector is NULL or has a NULL or non-finite component take no part. A component is floored after scaling
    and stops at a long's bounds. Vectors of each length have codebooks of their own, of at most ``LENGTHS`` lengths; a
    length that the parts don't divide is cut as evenly as can be, and parts of length zero are all alike. With fewer
    vectors than ``entries`` there are fewer entries. Of equal ids the least vector comes first among the seeds, and a
    NULL id last; repeated rows each count and each have a row. An empty table gives no row and no codebook. Other
    columns are not looked at.
    """
    vectors = whole_vectors(rows, scale)
    books, coded = {}, []
    for length in lengths(vectors, "v"):
        own = vectors.filter(F.size("v") == length)
        books[length] = fit(own, length, parts, entries, rounds)
        coded.append(encode(own, books[length]).withColumn("length", F.lit(length)))
    if not coded:
        kind = dict(vectors.dtypes)["label"]
        schema = f"vec_id long, label {kind}, code string, error long, length int, label_error long"
        return rows.sparkSession.createDataFrame([], schema), books
    together = coded[0]
    for more in coded[1:]:
        together = together.unionByName(more)
    return label_errors(staged(together, "vector_codes")), books
