"""Whitening of vectors by a covariance weighed by multiplicity.

Equal vectors are one row with a count. The fit weighs each of them by one, or by its count; a task centres the vectors
that it reads by the exact mean, multiplies them with their weights, and Spark adds the tasks' products. The driver sees
sums and products of as many numbers as a vector has, or their square, and finds the eigenvectors. Each distinct vector
is then whitened once, and all rows get theirs back by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.vectors import LONG, arrays, exact, lengths, matrix, usable
from tallyspark.sources.staging import staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# An eigenvalue below this part of their sum counts as zero.
FLAT = 1e-13
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def distinct_vectors(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, DataFrame]:
    """All usable rows as ``vec_id, x``, and each distinct ``x`` once with its ``copies``; both stored.

    A task counts what it reads before anything is shuffled, so a vector with very many copies is one row from each task.
    """
    most = F.lit(LONG - shift)
    whole = F.transform("embedding", lambda c: F.least(F.floor(c.cast("double") * scale), most) + shift)
    kept = rows.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))
    kept = staged(kept, "whiten_rows")
    return kept, staged(kept.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "whiten_distinct")


def _whole_sums(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    """The sum of all weights, and of the weighed vectors, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            x, w = matrix(batch.column("x"), length), batch.column("weight").to_numpy()
            bound = int(np.abs(x.astype(float)).max(initial=0)) * int(w.sum()) * 2
            total += (exact(x, bound) * w[:, None]).sum(axis=0)
            n += int(w.sum())
        sums = pa.array(map(Decimal, [n, *map(int, total)]), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(length + 1), pa.int32()), sums], names=["place", "total"])

    parts = vectors.mapInArrow(run, "place int, total decimal(38,0)")
    found = {r["place"]: int(r["total"]) for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return found[0], [found[k + 1] for k in range(length)]


def _products(vectors: DataFrame, column: str, length: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weighed sum of the products of all centred vectors with themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((length, length))
        for batch in batches:
            y = centred(matrix(batch.column(column), length))
            product += (y * batch.column("weight").to_numpy()[:, None]).T @ y
        place = pa.array(range(length * length), pa.int32())
        yield pa.RecordBatch.from_arrays([place, pa.array(product.ravel())], names=["place", "product"])

    parts = vectors.select(column, "weight").mapInArrow(run, "place int, product double")
    product = np.zeros(length * length)
    for r in parts.groupBy("place").agg(F.sum("product").alias("product")).collect():
        product[r["place"]] = r["product"]
    return product.reshape(length, length)


def _fit(vectors: DataFrame, length: int, components: int) -> DataFrame:
    """``x``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error`` of distinct vectors of one length."""
    n, sums = _whole_sums(vectors, length)

    def offsets(x: np.ndarray) -> np.ndarray:
        """``n * x`` less the sums, exactly."""
        bound = 2 * max(n * int(np.abs(x.astype(float)).max(initial=0)), max(map(abs, sums), default=0)) + 2
        total = np.array(sums, np.int64 if bound <= LONG else object)
        return n * exact(x, bound) - total

    def centred(x: np.ndarray) -> np.ndarray:
        return offsets(x).astype(float) / n

    covariance = _products(vectors, "x", length, centred) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    real = values > FLAT * trace
    root = np.sqrt(np.where(real, values, 1.0))

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), length)
            off = offsets(x)
            most = int(np.abs(off.astype(float)).max(initial=0)) + 1
            square = (exact(off, 2 * max(1, length) * most * most) ** 2).sum(axis=1)
            deviation = pa.array([min(LONG, int(d)) for d in square], pa.int64())
            done = (off.astype(float) / n) @ axes / root
            columns = [batch.column("x"), batch.column("weight"), deviation, arrays(done)]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "weight", "deviation", "whitened"])

    done = staged(vectors.mapInArrow(whiten, "x array<long>, weight long, deviation long, whitened array<double>"), "whitened")
    count = len(values)
    means = done.agg(*[(F.sum(F.get("whitened", k) * F.col("weight")) / n).alias(str(k)) for k in range(count)]).first()
    mean = np.array(list(means), float)
    spread = _products(done, "whitened", count, lambda w: w - mean)[np.ix_(real, real)] / n
    error = float(np.abs(spread - np.eye(len(spread))).max(initial=0.0))
    shown = F.transform("whitened", lambda w, k: F.when(F.get(F.lit(real.tolist()), k), w))
    explained = [float(v / trace) if trace else None for v in np.maximum(values, 0.0)]
    return done.select(
        "x",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        shown.alias("whitened"),
        F.array(*[F.lit(e).cast("double") for e in explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whiten(
    rows: DataFrame, components: int = COMPONENTS, by_count: bool = False, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """``RESULT`` for each usable row and each of its first ``components`` components.

    Rows whose vector is NULL or has a NULL or non-finite component take no part. ``x`` is the floor of each scaled
    component plus ``shift`` and stops at a long's bounds. The fit counts each distinct ``x`` once, or as often as it
    occurs with ``by_count``; ``n`` is the sum of its weights. ``deviation`` is exact and stops at the greatest long.
    A component without spread, as where there are fewer distinct vectors than components, has a NULL ``whitened``,
    explains nothing, and is left out of ``identity_error``; without any spread ``explained`` is NULL. Vectors of each
    length are whitened for themselves, of at most ``LENGTHS`` lengths; vectors without components have no row. A NULL
    id stays; repeated rows each have their rows; an empty table gives no row; other columns are not looked at.
    """
    kept, distinct = distinct_vectors(rows, scale, shift)
    weight = F.col("copies") if by_count else F.lit(1).cast("long")
    whitened = None
    for length in filter(None, lengths(distinct, "x")):
        own = distinct.filter(F.size("x") == length).select("x", weight.alias("weight"))
        found = _fit(own, length, components)
        whitened = found if whitened is None else whitened.unionByName(found)
    if whitened is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    zipped = F.arrays_zip("whitened", "explained")
    each = kept.join(whitened, "x").select("vec_id", "n", "deviation", "identity_error", F.posexplode(zipped).alias("k", "c"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
