"""Mixing sources to target weights by fitting each source's budget exactly.

A source's target gives a number of whole passes over its documents and a rest. Documents are counted by exact length,
and the rest is filled as a subset sum: an even share of each length first, then a bounded knapsack over the lengths
that are left, before which sums of single long documents are chosen so that the short ones can fill what they leave. Which documents of a length are taken is settled by a seeded hash, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import fresh, words
from tallyspark.llm.simhash import row_hash
from tallyspark.operators.joins import per_key
from tallyspark.sources.staging import staged

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 42
# Hash buckets of a length: the copies of a text have one length, so a length can hold a third of all rows.
BUCKETS = 1024
# Budget that the knapsack still fits once whole shares are taken, in words.
KNAPSACK = 1 << 16
# How many of the longest documents' lengths are left to choose among sums of long documents.
SPARE = 12
# How many of these sums are completed by short documents until one meets the budget.
TRIALS = 30


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source.

    Weights go by the sources' order by code point, NULL last, and repeat. A target stops at ``most`` times its
    source's size and the excess goes to the others by weight: sorted by the level at which a source stops, the level
    of all others follows from running sums. The window spans the sources, of which a mix has a list, never the rows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    stop = weighed.withColumn("cap", most * F.col("source_size").cast("double")).withColumn("stop", F.col("cap") / F.col("w"))
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    running = stop.select(
        "*",
        F.row_number().over(by_stop).alias("place"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("w").over(by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("open"),
    )
    level = (F.col("total") - F.col("capped")) / F.col("open")
    # From the first source in this order that the level of it and all after it doesn't stop, all are open.
    first = F.min(F.when(F.col("stop") >= level, F.struct("place", level.alias("at")))).over(everything)
    settled = running.withColumn("level", first["at"])
    return settled.select("source", "source_size", F.least("cap", F.coalesce(F.col("w") * F.col("level"), "cap")).alias("target"))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, knapsack: int = KNAPSACK) -> np.ndarray:
    """How many documents of each length to take so that their lengths sum to ``budget`` or come as near below as can be found.

    Lengths over half of ``knapsack`` are settled first, see ``_fit_long``. For the others an even share of every length
    is taken, then single documents from the longest down, until the rest is under ``knapsack``; from there the sums that
    the remaining documents reach are the bits of one integer for each step, with counts in powers of two, and the steps
    are walked back from the greatest sum.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int(lengths @ counts)
    if budget <= 0 or not total:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    if ((lengths > knapsack // 2) & (counts > 0)).any():
        return _fit_long(lengths, counts, budget, knapsack)
    taken = _even_share(lengths, counts, budget, knapsack / 2, total)
    rest = budget - int(lengths @ taken)
    order = np.argsort(-lengths)
    limit = (1 << (rest + 1)) - 1
    reach, steps = 1, []
    for k in order:
        left = int(counts[k] - taken[k])
        left = min(left, rest // int(lengths[k])) if lengths[k] else 0
        part = 1
        while left > 0:
            n = min(part, left)
            steps.append((int(k), n, reach))
            reach |= (reach << (n * int(lengths[k]))) & limit
            left -= n
            part *= 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for k, n, before in reversed(steps):
        if before >> at & 1:
            continue
        taken[k] += n
        at -= n * int(lengths[k])
    return taken


def _even_share(lengths: np.ndarray, counts: np.ndarray, budget: float, spare: float, total: int) -> np.ndarray:
    """An even share of every length, then single documents from the longest down, until less than twice ``spare`` is left.

    At least ``spare`` is left, which no length may exceed, or all of the budget if that is less.
    """
    taken = np.minimum(counts, np.floor(counts * max(0.0, (budget - spare) / total)).astype(np.int64))
    rest = int(budget) - int(lengths @ taken)
    for k in np.argsort(-lengths):
        if rest <= 2 * spare:
            break
        if lengths[k]:
            more = min(int(counts[k] - taken[k]), max(0, rest - int(spare)) // int(lengths[k]))
            taken[k] += more
            rest -= more * int(lengths[k])
    return taken


def _fit_long(lengths: np.ndarray, counts: np.ndarray, budget: int, knapsack: int) -> np.ndarray:
    """``fit_lengths`` where some lengths are over half of ``knapsack``.

    The long documents' even share leaves out ``SPARE`` to twice ``SPARE`` times the greatest length, for which sums of
    single long documents are listed. A sum fits if what it leaves of the budget is no more than all short documents together. Of
    these the ones nearest to the long documents' share, the least and the greatest are completed by short documents,
    until one meets the budget; else the one that comes nearest counts, in this order, with single documents exchanged.
    """
    long = lengths > knapsack // 2
    small = int(lengths[~long] @ counts[~long])
    whole = int(lengths[long] @ counts[long])
    longest = int(lengths[counts > 0].max())
    aim = budget * whole // (whole + small)
    base = np.where(long, _even_share(lengths, np.where(long, counts, 0), aim, SPARE * longest, whole), 0)
    rest = budget - int(lengths @ base)
    aim -= int(lengths @ base)
    spare = min(rest - aim, aim - rest + small)
    near = (aim - spare // 2, aim + spare // 2) if spare >= longest else (rest, rest)
    of, n, parent, sums = _sums(lengths, np.where(long, counts - base, 0), min(rest, aim + longest), near, 4 * knapsack)
    fits = np.flatnonzero(sums >= rest - small)
    chosen = [int(np.argmax(sums))]
    if len(fits):
        nearest = fits[np.argsort(np.abs(sums[fits] - aim), kind="stable")[:TRIALS]]
        chosen = nearest.tolist() + [int(fits[np.argmin(sums[fits])])] + chosen
    best, most = None, -1
    for node in dict.fromkeys(chosen):
        taken = base.copy()
        while node:
            taken[of[node]] += n[node]
            node = parent[node]
        taken[~long] = fit_lengths(lengths[~long], counts[~long], budget - int(lengths @ taken), knapsack)
        if (got := int(lengths @ taken)) > most:
            best, most = taken, got
        if most == budget:
            break
    return _exchanged(lengths, counts, best, budget - most)


def _exchanged(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, gap: int) -> np.ndarray:
    """Narrows the gap by the best exchange of one document taken, or none, for a longer one, until there is none."""
    order = np.argsort(lengths)
    while gap > 0:
        free, used = order[(taken < counts)[order]], order[(taken > 0)[order]]
        given = np.concatenate([[0], lengths[used]])
        at = np.searchsorted(lengths[free], given + gap, "right") - 1
        gains = np.where(at >= 0, lengths[free][at] - given, 0)
        k = int(np.argmax(gains))
        if gains[k] <= 0:
            break
        taken[free[at[k]]] += 1
        if k:
            taken[used[k - 1]] -= 1
        gap -= int(gains[k])
    return taken


def _sums(
    lengths: np.ndarray, counts: np.ndarray, top: int, enough: tuple[int, int], cells: int
) -> tuple[list[int], list[int], list[int], np.ndarray]:
    """Sums up to ``top`` of documents: for each the last length and its number of documents, the sum it extends, itself.

    Sums are exact; of those in one of ``cells`` equal parts of the range, and of those at the very top, the first stays.
    No more lengths are tried once a sum is within ``enough``, bounds included.
    """
    unit = top // cells + 1
    held = np.full(top // unit + 2, -1)
    held[0] = 0
    of, many, parent, sums = [-1], [0], [-1], [np.zeros(1, np.int64)]
    so_far = sums[0]
    for k in np.argsort(-lengths):
        length = int(lengths[k])
        left = min(int(counts[k]), top // length) if length else 0
        part = 1
        while left > 0:
            n = min(part, left)
            left -= n
            part *= 2
            nodes = held[held >= 0]
            new = so_far[nodes] + n * length
            nodes, new = nodes[new <= top], new[new <= top]
            at = np.where(new == top, len(held) - 1, new // unit)
            free = held[at] < 0
            at, first = np.unique(at[free], return_index=True)
            if not len(at):
                continue
            held[at] = len(so_far) + np.arange(len(at))
            of += [int(k)] * len(at)
            many += [n] * len(at)
            parent += nodes[free][first].tolist()
            so_far = np.concatenate([so_far, new[free][first]])
        if ((so_far >= enough[0]) & (so_far <= enough[1])).any():
            break
    return of, many, parent, so_far


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` for each row of ``docs``.

    ``size`` counts words, none in a NULL text. ``taken`` is ``size`` times the number of copies that the mix takes,
    ``most`` at most. Texts without words are taken with no words. NULL is a source like any other, ordered last.
    Repeated rows are documents of their own; an empty table gives no row; other columns are not looked at.
    """
    return _mixed_rows(docs.select("doc_id", "source", "text"), weights, most, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _mixed_rows(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int, *more: Column) -> DataFrame:
    """``docs`` without texts, with ``size``, ``source_size``, ``target``, ``copies``, and columns that name a row."""
    order = _hash(seed, "doc_id", "text")
    sized = docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), order.alias("order"), *more
    )
    sized = staged(sized.withColumn("bucket", F.pmod(F.shiftright("order", 40), F.lit(BUCKETS)).cast("int")), "mix_sizes")
    return _choose(sized, weights, most)


def _choose(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    per_bucket = staged(sized.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix_counts")
    goals = targets(per_bucket.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    lengths = per_bucket.groupBy("source", "size").agg(F.sum("n").alias("n"))
    # One row per source and length; the sort inside a group makes the fit the same however rows arrive.
    joined = lengths.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size").reset_index(drop=True)
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = min(most, int(target // size)) if size else 0
        budget = int(round(target)) - passes * size if passes < most else 0
        group["passes"] = passes
        group["extra"] = fit_lengths(group["size"].to_numpy(), group["n"].to_numpy(), budget)
        return group[["source", "size", "source_size", "target", "passes", "extra"]]

    fitted = joined.groupBy("source").applyInPandas(
        fit, "source string, size long, source_size long, target double, passes long, extra long"
    )
    fitted = staged(fitted, "mix_fit")
    running = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    plan = before.alias("b").join(
        fitted.alias("f"), F.col("b.source").eqNullSafe(F.col("f.source")) & (F.col("b.size") == F.col("f.size"))
    )
    plan = plan.select(
        F.col("b.source").alias("of_source"),
        F.col("b.size").alias("of_size"),
        F.col("bucket").alias("of_bucket"),
        "before",
        "source_size",
        "target",
        "passes",
        "extra",
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id"))
    rows = sized.withColumn("place", place).join(
        plan,
        F.col("source").eqNullSafe(F.col("of_source"))
        & (F.col("size") == F.col("of_size"))
        & (F.col("bucket") == F.col("of_bucket")),
    )
    copies = F.col("passes") + F.when(F.col("before") + F.col("place") <= F.col("extra"), 1).otherwise(0)
    return rows.withColumn("copies", copies)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, all columns unchanged.

    Of rows equal in all columns one is repeated as often as the mix takes all of them together, so a source has exactly
    the words that ``mix`` counts. NULL and empty texts may be in it, they spend no budget; a NULL source or id is a value
    like any other; texts may have any length; an empty table gives no row.
    """
    one, two, n, rows, copy, split = fresh(docs, "_row", "_row2", "_copies", "_rows", "_copy", "_split")
    # Two hashes of 64 bits name a row, since among billions of rows two may share one.
    keys = {one: row_hash(docs, seed), two: row_hash(docs, seed + 1)}
    chosen = _mixed_rows(docs, weights, most, seed, *[c.alias(name) for name, c in keys.items()])
    total, count = F.sum("copies").cast("int").alias(n), F.count(F.lit(1)).alias(rows)
    copies = staged(per_key(chosen, [one, two], total, count).filter(F.col(n) > 0), "mix_copies")
    keyed = docs.withColumns(keys)
    single = keyed.join(copies.filter(F.col(rows) == 1), [one, two])
    equal = keyed.join(copies.filter(F.col(rows) > 1), [one, two])
    # Grouped apart from the join's keys, so that many equal rows can be split in the join.
    equal = equal.withColumn(split, F.length(F.col(one).cast("string")) < 0).dropDuplicates([one, two, split]).drop(split)
    taken = single.unionByName(equal)
    return taken.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(n)))).select(*[f"`{c}`" for c in docs.columns])
