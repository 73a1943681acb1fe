"""Join helpers that hold up when one key carries a large share of the rows.

Adaptive execution splits the partition of a hot key by itself, as long as both sides of the join come straight from
shuffles made for it. An aggregate on the join key does not: its rows already lie where the join wants them, so no
shuffle is added and nothing can be split. The helpers here build such sides apart from their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

APART = "_apart"


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with a column to group or join by beside the keys.

    The column is always false, which the planner cannot know. It changes no group, but leaves the result partitioned
    by more than the keys, so that a later join on the keys alone shuffles it. That second shuffle moves one row per
    key; in return a hot key on the other side is split.
    """
    return df.withColumn(APART, F.length(F.col(keys[0]).cast("string")) < 0)


def per_key(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """One row per non-NULL key, to be the small side of a join whose other side may have hot keys."""
    return apart(df.dropna(subset=keys), *keys).groupBy(*keys, APART).agg(*aggregates).drop(APART)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The non-NULL keys once each, to be the listed side of an anti join whose other side may have hot keys."""
    return apart(df.select(*keys).dropna(), *keys).distinct().drop(APART)


def not_in(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key is ``NOT IN`` the list, by SQL's NULL rules, at any list size.

    An empty list keeps every row; a NULL in the list keeps none; otherwise non-NULL keys without a match stay. The
    two facts about the list are one-row subqueries and the match is a plain anti join, so nothing needs to fit in one
    executor as it would in a null-aware anti join.
    """
    names = listed.select(F.col(listed_key).alias(key))
    facts = names.agg(
        F.struct(
            (F.count(F.lit(1)) == 0).alias("empty"),
            (F.count_if(F.col(key).isNull()) > 0).alias("has_null"),
        ).alias("facts")
    ).scalar()
    candidates = df.filter((F.col(key).isNotNull() & ~facts["has_null"]) | facts["empty"])
    return candidates.join(names, key, "left_anti").select(*df.columns)
