"""Exact search for the highest inner products by segment statistics, coarse to fine.

A vector is cut into segments, and each segment has a mean and a deviation. By Cauchy and Schwarz the inner product of
two segments is at most ``length * (mean * mean + deviation * deviation)``, which bounds the distance from below, so the
statistics alone bound a score. A query starts from the candidates with the best coarse bounds; whatever can't reach its
fifth best score so far is dropped, then finer segments drop more, and only the survivors are computed in full.

Queries and candidates meet as blocks of packed vectors, so neither side has to fit anywhere whole. Each block of queries
meets one block of candidates first, and the scores it reaches there are floors for all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.sources.staging import staged

TOP = 5
SCALE = 256
EVERY = 50
QUERY_BLOCK = 1024
ROW_BLOCK = 8192
# Numbers of segments, coarse to fine.
LEVELS = (4, 16)
# Part of a block above which what the bounds leave of it is computed as one product.
DENSE = 0.02
# Blocks of queries that meet a block of rows in one task.
QUERY_GROUP = 16
# Queries of a block that are compared at once.
_STRIDE = 128
_EXACT = float(1 << 53)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, times the root of its length, so that their inner product is the bound."""
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    columns = []
    for a, b in zip(edges[:-1], edges[1:]):
        part = vectors[:, a:b]
        columns += [part.mean(axis=1) * np.sqrt(b - a), part.std(axis=1) * np.sqrt(b - a)]
    return np.stack(columns, axis=1)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products row by row, beyond doubles too; what exceeds a long stops at its bounds."""
    limit = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if limit < _EXACT:
        return np.einsum("ij,ij->i", queries, rows).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(q, r)) for q, r in zip(queries, rows)]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, v)) for v in whole], np.int64)


def search(
    query_ids: np.ndarray,
    queries: np.ndarray,
    row_ids: np.ndarray,
    rows: np.ndarray,
    top: int = TOP,
    floors: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row number and score of the ``top`` rows of each query; a row with the query's id is left out.

    ``floors`` are scores that each query is known to reach ``top`` times elsewhere; rows below are left out. Where the
    bounds leave more than ``DENSE`` of a block, what is left of it is computed as one product of matrices, which is exact
    while sums stay below 2**53.
    """
    if not len(rows) or not len(queries):
        return (np.zeros(0, np.int64),) * 3
    levels = [(statistics(queries, n), statistics(rows, n)) for n in LEVELS] if queries.shape[1] else []
    limit = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    known = np.full(len(queries), -np.inf) if floors is None else floors
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    norms = np.linalg.norm(rows, axis=1)
    for at in range(0, len(queries), _STRIDE):
        ids, some = query_ids[at : at + _STRIDE], queries[at : at + _STRIDE]
        own = ids[:, None] == row_ids[None, :]
        floor, length = known[at : at + _STRIDE], np.linalg.norm(some, axis=1)
        # Rounding of the bounds, well below any true gap between integer scores of this size.
        slack = lambda cols: 1e-9 * (length[:, None] * norms[None, cols]) + 1e-6  # noqa: E731, B023
        alive = ~own
        for level, (left, right) in enumerate(levels):
            cols = np.flatnonzero(alive.any(axis=0))
            bound = left[at : at + _STRIDE] @ right[cols].T + slack(cols)
            if not level and len(cols) == len(rows):
                floor = np.maximum(floor, _first_floor(some, rows, np.where(own, -np.inf, bound), own, top))
            alive[:, cols] &= bound >= floor[:, None]
        if limit < _EXACT and alive.mean() > DENSE:
            cols = np.flatnonzero(alive.any(axis=0))
            product = np.where(alive[:, cols], some @ rows[cols].T, -np.inf)
            if len(cols) > top:
                product[product < np.partition(product, -top, axis=1)[:, -top][:, None]] = -np.inf
            q, r = np.nonzero(product > -np.inf)
            score, r = product[q, r].astype(np.int64), cols[r]
        else:
            q, r = np.nonzero(alive)
            starts = range(0, len(q), 1 << 17)
            parts = [_products(some[q[s : s + (1 << 17)]], rows[r[s : s + (1 << 17)]]) for s in starts]
            score = np.concatenate(parts or [np.zeros(0, np.int64)])
        order = np.lexsort((row_ids[r], -score.astype(object) if len(score) and score.min() == -(1 << 63) else -score, q))
        q, r, score = q[order], r[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        out.append((q[place < top] + at, r[place < top], score[place < top]))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _first_floor(queries: np.ndarray, rows: np.ndarray, bound: np.ndarray, own: np.ndarray, top: int) -> np.ndarray:
    """For each query the ``top``-th best score among the rows with its best bounds, which its result can't fall below."""
    first = np.argpartition(-bound, min(2 * top, bound.shape[1] - 1), axis=1)[:, : 2 * top]
    q = np.repeat(np.arange(len(queries)), first.shape[1])
    scores = _products(queries[q], rows[first.ravel()]).reshape(first.shape).astype(float)
    scores[np.take_along_axis(own, first, axis=1)] = -np.inf
    scores.sort(axis=1)
    return scores[:, -top] if scores.shape[1] >= top else np.full(len(queries), -np.inf)


def _vector(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def top_rows(
    rows: DataFrame,
    queries: Column | None = None,
    top: int = TOP,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``top`` highest scores among ``vec_id, embedding`` rows.

    ``queries`` says which rows are queries, by default those whose id is divisible by 50. A score is the inner product of
    the scaled, floored components. Ties go to the smaller id. Rows with the query's id are not its candidates. Rows
    without an id, with a NULL vector or with a NULL or non-finite component take no part, and vectors are compared with
    those of their own length only. Of several query rows with one id the one with the least vector asks; repeated
    candidate rows each count. An empty table gives no row; other columns are not looked at.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    asks = F.col("vec_id") % EVERY == 0 if queries is None else queries
    good = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    good = good.select(
        F.col("vec_id").cast("long").alias("id"),
        _vector(F.col("embedding"), scale).alias("v"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("at"),
    )
    good = staged(good.withColumn("dim", F.size("v")), "vectors")
    asking = good.filter("asks").groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.dim", "q.v")
    counts = good.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    n_rows, n_queries = -(-counts[0] // row_block), -(-counts[1] // query_block)
    if not n_queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def packed(frame: DataFrame, salt: Column, blocks: int, name: str) -> DataFrame:
        """One row for each block: its ids and its vectors one after another; stored."""
        block = F.pmod(F.xxhash64("id", salt), F.lit(blocks)).cast("int")
        listed = frame.groupBy("dim", block.alias(name)).agg(F.collect_list(F.struct("id", "v")).alias("all"))
        flat = listed.select("dim", name, F.col("all.id").alias(f"{name}_ids"), F.flatten("all.v").alias(f"{name}_flat"))
        return staged(flat, f"blocks_{name}")

    left = packed(asking, F.lit(0), n_queries, "q")
    right = packed(good, F.col("at"), n_rows, "r")

    def block(pair: object, side: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.asarray(getattr(pair, f"{side}_ids"), np.int64)
        return ids, np.asarray(getattr(pair, f"{side}_flat"), float).reshape(len(ids), pair.dim)

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The score that each query of a block reaches ``top`` times in one block of rows."""
        for batch in batches:
            for pair in batch.itertuples():
                (q_ids, q_rows), (r_ids, r_rows) = block(pair, "q"), block(pair, "r")
                q, _, score = search(q_ids, q_rows, r_ids, r_rows, top)
                floors = np.full(len(q_ids), -np.inf)
                full = np.bincount(q, minlength=len(q_ids)) == top
                np.minimum.at(least := np.full(len(q_ids), np.inf), q, score.astype(float))
                floors[full] = least[full]
                yield pd.DataFrame({"dim": [pair.dim], "q": [pair.q], "floors": [floors.tolist()]})

    # One block of rows first gives each query a floor, which all other blocks then have to reach.
    tried = left.withColumn("r", F.pmod("q", F.lit(n_rows)).cast("int")).join(right, ["dim", "r"])
    floors = staged(tried.mapInPandas(reached, "dim int, q int, floors array<double>"), "floors")
    # Each block of queries goes to each block of rows: as many pairs as blocks times blocks, not rows times rows. A task
    # has one block of rows and a group of blocks of queries.
    group = F.floor(F.col("q") / QUERY_GROUP).cast("int")
    asked = left.join(floors, ["dim", "q"], "left").withColumn("group", group)
    asked = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    groups = F.explode(F.sequence(F.lit(0), F.lit((n_queries - 1) // QUERY_GROUP)))
    pairs = asked.join(right.withColumn("group", groups), ["dim", "r", "group"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples():
                (q_ids, q_rows), (r_ids, r_rows) = block(pair, "q"), block(pair, "r")
                known = None if pair.floors is None else np.asarray(pair.floors, float)
                q, r, score = search(q_ids, q_rows, r_ids, r_rows, top, known)
                yield pd.DataFrame({"query_id": q_ids[q], "vec_id": r_ids[r], "score": score})

    found = pairs.mapInPandas(compare, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
