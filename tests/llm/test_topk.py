import random

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import topk


def brute(rows, every, top):
    """All inner products of usable vectors."""
    bad = (float("nan"), float("inf"), float("-inf"))
    good = [(i, [int(x * 256 // 1) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and x == x and x not in bad for x in v)]
    asks = {}
    for i, v in good:
        if i % every == 0 and (i not in asks or (len(v), v) < (len(asks[i]), asks[i])):
            asks[i] = v
    out = []
    for i, q in asks.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:top]
        out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 17)])
def test_against_all_products(spark, blocks):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(10)]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(60)] + [(400, [0.0] * 10), (450, rows[3][1]), (450, rows[3][1])]
    rows += [(500, [1.0, -1.0]), (501, [0.5, 0.25]), (550, []), (551, []), (600, [float("nan")] * 10), (650, None)]
    rows += [(601, [None] + [0.1] * 9), (602, [float("inf")] * 10), (None, [0.3] * 10), (700, [9e9] * 10), (701, [-9e9] * 10)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("dim", F.lit("clash"))
    exact = [(i, None if v is None else v) for i, v in ((r["vec_id"], r["embedding"]) for r in frame.collect())]
    found = topk.top_rows(frame, query_block=blocks[0], row_block=blocks[1]).collect()
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    expected = [(q, r, j, clip(s)) for q, r, j, s in brute(exact, 50, 5)]
    assert sorted(tuple(r) for r in found) == expected


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -1.0])], schema)
    assert [tuple(r) for r in topk.top_rows(two).collect()] == [(0, 1, 1, 128 * 256 - 512 * 256)]
    assert topk.top_rows(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_rows(two, queries=F.col("vec_id") == 1, top=1).select("vec_id").first()[0] == 0
