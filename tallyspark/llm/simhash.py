"""Near-duplicate texts by SimHash, compared exactly tile against tile.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Two fingerprints link if they differ
in few bits. Equal fingerprints are one from the start, so copies cost nothing; the distinct ones are cut into tiles by
their population count. Two fingerprints whose population counts differ by more than the radius can't link, so only
tile pairs with close counts are compared. Inside a pair the same bound is used once more with the counts of the four
quarters: rows are sorted by these, and an exclusive-or with a bit count runs over the quarters' surviving ranges only.

A tile pair yields a forest of its links and never the links themselves, so a group of thousands of near copies gives
thousands of rows and not their square. ``components`` joins the forests of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.components import connected
from tallyspark.llm.common import fresh
from tallyspark.operators.joins import apart, per_key
from tallyspark.sources.staging import staged

SEED = 42
SHINGLE = 3
RADIUS = 3
TILE = 32_768
_STEP = 1 << 16
_QUARTERS = np.array([17**3, 17**2, 17, 1])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text; zero if it has no word."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    width = min(width, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s:e], SEED) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist())),
        np.uint64,
        len(found) - width + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _STEP):
        octets = hashes[at : at + _STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint as a signed ``bigint`` of the same bits."""
    return _fingerprints(text)


class _Forest:
    """Links between numbered rows, kept as a root for each row."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        apart_ = a != b
        if not apart_.any():
            return
        pairs = np.unique(np.stack([a[apart_], b[apart_]], axis=1), axis=0)
        parent = {int(r): int(r) for r in np.unique(pairs)}

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        moved = np.arange(len(self.root))
        for r in parent:
            moved[r] = find(r)
        self.root = moved[self.root]


def _quarters(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints.view(np.uint16).reshape(-1, 4)).astype(np.int64)


def _sorted_cells(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints sorted by the counts of their quarters, the distinct counts, and where each begins and how many it has."""
    code = _quarters(prints) @ _QUARTERS
    order = np.argsort(code, kind="stable")
    _, first, many = np.unique(code[order], return_index=True, return_counts=True)
    prints = prints[order]
    return prints, _quarters(prints[first]), first, many


def tile_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``left``, or from ``left`` to ``right``, as a forest: each linked fingerprint and its root."""
    a, a_cells, a_first, a_many = _sorted_cells(left)
    b, b_cells, b_first, b_many = (a, a_cells, a_first, a_many) if right is None else _sorted_cells(right)
    shift = 0 if right is None else len(a)
    forest = _Forest(len(a) + (0 if right is None else len(b)))
    for cell, at, n in zip(a_cells, a_first.tolist(), a_many.tolist()):
        near = np.abs(b_cells - cell).sum(axis=1) <= radius
        if not near.any():
            continue
        others = np.flatnonzero(np.repeat(near, b_many))
        step = max(1, (1 << 21) // len(others))
        for start in range(at, at + n, step):
            rows = np.arange(start, min(start + step, at + n))
            i, j = np.nonzero(np.bitwise_count(a[rows][:, None] ^ b[others][None, :]) <= radius)
            i, j = rows[i], others[j] + shift
            forest.link(i[i != j], j[i != j])
    both = a if right is None else np.concatenate([a, b])
    linked = np.flatnonzero(forest.root != np.arange(len(both)))
    return both[linked].view(np.int64), both[forest.root[linked]].view(np.int64)


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(a, b)``: a forest of the links between distinct fingerprints, given in the column ``fp``.

    What the driver sees are 65 counts, one for each population count.
    """
    weighed = prints.select("fp", F.bit_count("fp").cast("int").alias("ones"))
    blocks = [0] * 65
    for row in weighed.groupBy("ones").count().collect():
        blocks[row["ones"]] = -(-row["count"] // tile)
    sizes = F.array(*[F.lit(n) for n in blocks])
    own = F.struct("ones", "block")
    tiles = (
        weighed.withColumn("block", F.pmod(F.xxhash64("fp"), F.get(sizes, F.col("ones"))).cast("int"))
        .groupBy("ones", "block")
        .agg(F.collect_list("fp").alias("prints"))
    )
    near = F.sequence(F.greatest(F.lit(0), F.col("ones") - radius), F.least(F.lit(64), F.col("ones") + radius))
    others = F.flatten(
        F.transform(
            near,
            lambda p: F.transform(
                F.filter(F.sequence(F.lit(0), F.get(sizes, p)), lambda b: b < F.get(sizes, p)),
                lambda b: F.struct(p.alias("ones"), b.cast("int").alias("block")),
            ),
        )
    )
    pairs = tiles.select("prints", own.alias("own"), F.explode(others).alias("other")).select(
        "prints", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sides = [np.asarray(p, np.int64).view(np.uint64) for p in group["prints"]]
        a, b = tile_forest(sides[0], sides[1] if len(sides) > 1 else None, radius)
        return pd.DataFrame({"a": a, "b": b})

    keys = [F.col(f"{side}.{part}").alias(f"{side}_{part}") for side in ("low", "high") for part in ("ones", "block")]
    keyed = pairs.select("prints", *keys)
    return keyed.groupBy("low_ones", "low_block", "high_ones", "high_block").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included. Texts without a word (NULL,
    empty, blank) have the fingerprint zero and link like any other. Repeated rows stay, in one component. A NULL
    ``doc_id`` names no component: a component of such rows only has a NULL id. An empty table gives no row, and other
    columns are not looked at.
    """
    prints = staged(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash_prints")
    named = _labelled(prints, F.min("doc_id").alias("first_id"), radius, tile)
    smallest = per_key(named, ["label"], F.min("first_id").alias("component_id"))
    by_print = apart(named.join(smallest, "label").select("fp", "component_id"), "fp")
    by_print = by_print.groupBy("fp", "_apart").agg(F.min("component_id").alias("component_id")).drop("_apart")
    return prints.join(by_print, "fp", "left").select("doc_id", "fp", "component_id")


def _labelled(prints: DataFrame, first: Column, radius: int, tile: int) -> DataFrame:
    """Each distinct ``fp`` once, with the aggregate ``first`` over its rows and the ``label`` of its component."""
    firsts = staged(prints.groupBy("fp").agg(first), "simhash_firsts")
    labels = connected(staged(near_links(firsts.select("fp"), radius, tile), "simhash_links"))
    return firsts.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def row_hash(docs: DataFrame, seed: int) -> Column:
    """A hash of all columns in which a NULL counts where it stands; nested values go in as JSON with their NULLs."""
    nested = ("map<", "variant", "struct<", "array<")
    values = []
    for name, kind in docs.dtypes:
        column = F.col(f"`{name}`")
        whole = F.to_json(F.struct(column.alias("c")), {"ignoreNullFields": "false"}) if any(n in kind for n in nested) else column
        values += [column.isNull(), whole]
    return F.xxhash64(F.lit(seed), *values)


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps exactly one, all columns unchanged.

    It is the row with the smallest ``doc_id``, NULL last; of several such rows the one with the least hash of the whole
    row, and of equal rows one. What stays is chosen by row and never by ``doc_id``: distinct texts without id all stay,
    and so do distinct texts with one id, each for its own component. NULL and empty texts are one component. A NULL counts
    in the hash where it stands, so rows that have the same values in other columns are not equal. Columns may have any
    names; an empty table gives no row.
    """
    one, two, split = fresh(docs, "_row", "_row2", "_split")
    # Two hashes of 64 bits name a row, since among billions of rows two may share one.
    hashed = docs.withColumns({one: row_hash(docs, SEED), two: row_hash(docs, SEED + 1)})
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(one).alias("row"), F.col(two).alias("row2"))
    prints = staged(hashed.select(fingerprints(F.col("text")).alias("fp"), rank.alias("rank")), "simhash_rows")
    named = _labelled(prints, F.min("rank").alias("rank"), radius, TILE)
    firsts = per_key(named, ["label"], F.min("rank").alias("rank"))
    kept = hashed.join(firsts.select(F.col("rank.row").alias(one), F.col("rank.row2").alias(two)), [one, two], "left_semi")
    # Of equal rows one stays. Grouped apart from the join's keys, so that many equal rows can be split in the join.
    kept = kept.withColumn(split, F.length(F.col(one).cast("string")) < 0).dropDuplicates([one, two, split])
    return kept.select(*[f"`{c}`" for c in docs.columns])
