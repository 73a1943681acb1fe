"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.joins import per_key
from tallyspark.sources.staging import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).select(
        "col.a", "col.b"
    )


def _least_of(edges: DataFrame) -> DataFrame:
    return per_key(edges, ["a"], F.min(F.least("a", "b")).alias("least"))


def _distinct(edges: DataFrame, a: Column, b: Column) -> DataFrame:
    return edges.select(a.alias("a"), b.alias("b")).filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    ways = _both_ways(edges)
    return _distinct(ways.filter("b > a").join(_least_of(ways), "a"), F.col("b"), F.col("least"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    moved = down.join(_least_of(down), "a").select(
        F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b"))))
    )
    return _distinct(moved, F.col("col.a"), F.col("col.b"))


def connected(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for each node of the links ``(a, b)`` but the label itself, the component's least node.

    Each round is stored in the shared folder, which also ends its lineage. A round at least halves the depth that is
    left, so the number of rounds grows with the logarithm of a component's size. The driver sees a count and a checksum.
    Links to oneself and repeated links change nothing; NULL ends are left out.
    """

    def mark(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = staged(_distinct(edges.dropna(), F.greatest("a", "b"), F.least("a", "b")), "links")
    seen = mark(now)
    while seen[0]:
        now = staged(_small_star(_large_star(now)), "links")
        if (new := mark(now)) == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
