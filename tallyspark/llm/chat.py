"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation again after each of its turns. A rolling hash of a conversation's turns names each of its
prefixes, so a conversation that is a prefix of a longer one is one whose whole hash is among the proper prefixes of
others: an anti join keeps the maximal ones. Of conversations equal turn for turn the one with the smallest id stays.

The rolling hash of a prefix is the exclusive-or of its turns' hashes, each taken together with the turn's place, twice
with different seeds. It is a running aggregate; places and prefixes are counted in two levels, so that one very long
conversation is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import per_key
from tallyspark.sources.staging import staged

SEEDS = (42, 1042)
# Turns of a conversation that are numbered together, and turns of one rendered segment.
BLOCK = 64
SEGMENT = 256
# The marks around a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# How both marks begin, and what stands in its place in roles and texts.
MARK, ESCAPED = "<|im_", "<| im_"


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]


def placed(turns: DataFrame) -> DataFrame:
    """``conv_id, role, text`` with ``block`` and ``place``, a turn's number in its conversation from 0, and prefix hashes.

    Turns go by ``turn``, NULL first, then role and text. They are first numbered in blocks of neighbouring turn numbers,
    and each block then adds what comes before it.
    """
    rows = turns.select("conv_id", "turn", "role", "text", F.floor(F.col("turn") / BLOCK).alias("block"))
    key = ["conv_id", "block"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"of_{k}") for k in key], F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy(*key).orderBy(*_order())
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & F.col("block").eqNullSafe(F.col("of_block"))
    rows = rows.withColumn("number", F.row_number().over(within) - 1).join(starts, same)
    rows = rows.withColumn("place", F.col("start") + F.col("number"))
    own = [F.xxhash64(F.lit(s), "place", "role", "text", F.col("role").isNull(), F.col("text").isNull()) for s in SEEDS]
    return staged(rows.select(*key, "place", "role", "text", *[h.alias(f"h{k}") for k, h in enumerate(own)]), "chat_turns")


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id``, the length of each prefix and its two hashes."""
    key = ["conv_id", "block"]
    by_block = rows.groupBy(*key).agg(*[F.bit_xor(f"h{k}").alias(f"h{k}") for k in (0, 1)])
    earlier = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = by_block.select(
        *[F.col(k).alias(f"of_{k}") for k in key],
        *[F.coalesce(F.bit_xor(f"h{k}").over(earlier), F.lit(0)).alias(f"b{k}") for k in (0, 1)],
    )
    running = Window.partitionBy(*key).orderBy("place")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & F.col("block").eqNullSafe(F.col("of_block"))
    summed = rows.select(*key, "place", *[F.bit_xor(f"h{k}").over(running).alias(f"h{k}") for k in (0, 1)])
    hashes = [F.col(f"h{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"h{k}") for k in (0, 1)]
    return summed.join(before, same).select("conv_id", (F.col("place") + 1).alias("length"), *hashes)


def maximal(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``n_turns`` of the conversations that stay, from ``placed`` rows.

    The last prefix of a conversation is its whole; all others are proper ones.
    """
    found = staged(prefixes(rows), "chat_prefixes")
    lengths = found.groupBy("conv_id").agg(F.max("length").alias("n_turns"))
    whole = found.join(lengths.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("length") == F.col("n_turns")))
    name = ["length", "h0", "h1"]
    # Equal conversations become one row each before anything is joined by what they share.
    wholes = whole.groupBy(*name).agg(F.min("conv_id").alias("conv_id"))
    inner = found.join(lengths.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).filter("length < n_turns")
    proper = inner.groupBy(*name).agg(F.count(F.lit(1)).alias("n")).drop("n")
    return wholes.join(proper, name, "left_anti").select("conv_id", F.col("length").alias("n_turns"))


def render(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id``, ``n_turns``, ``segment`` and ``rendered`` of each conversation that stays.

    A turn is rendered as its role and text between marks; a conversation of more than ``segment`` turns has several
    segments that follow each other, so that none has to fit in memory whole. What could be taken for a mark in a role or a
    text has a space put into it, so neither can pass for turns of its own. NULL roles and texts are rendered as empty;
    a NULL ``conv_id`` is a conversation like any other, and of equal ones an id that isn't NULL stays. Repeated rows are
    turns of their own. An empty table gives no row; other columns are not looked at.
    """
    rows = placed(turns.select("conv_id", "turn", "role", "text"))
    kept = staged(maximal(rows), "chat_kept").select(F.col("conv_id").alias("of"), "n_turns")
    own = [F.replace(F.coalesce(c, F.lit("")), F.lit(MARK), F.lit(ESCAPED)) for c in ("role", "text")]
    text = F.concat(F.lit(OPEN), own[0], F.lit("\n"), own[1], F.lit(CLOSE + "\n"))
    turn = F.struct("place", text.alias("text"))
    numbered = rows.withColumn("segment", F.floor(F.col("place") / segment))
    parts = numbered.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    joined = parts.join(kept, F.col("conv_id").eqNullSafe(F.col("of")))
    return joined.select("conv_id", "n_turns", "segment", F.array_join("turns.text", "").alias("rendered"))
