import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, count, weights=None):
    """``n``, exact deviations and whitened vectors by whole numbers and one dense matrix."""
    x = [[int(c * 64 // 1) + 1_000_000 for c in v] for v in vectors]
    keys = sorted(set(map(tuple, x)))
    many = [1 if weights is None else x.count(list(k)) for k in keys]
    n, sums = sum(many), [sum(w * c for w, c in zip(many, column)) for column in zip(*keys)]
    centred = lambda v: np.array([n * c - s for c, s in zip(v, sums)], float) / n
    y = np.array([centred(k) for k in keys])
    values, axes = np.linalg.eigh((y.T * many) @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    done = np.array([centred(v) for v in x]) @ axes[:, :count] / np.sqrt(values[:count])
    return n, deviations, done, values[:count] / values.sum()


@pytest.mark.parametrize("by_count", [False, True])
def test_against_one_matrix(spark, by_count):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 0.1 + 0.3 * j) for j in range(20)]) for k in range(300)]
    rows += [(1000 + k, rows[9][1]) for k in range(200)] + [(None, rows[4][1]), (4, rows[4][1])]
    bad = [(2000, None), (2001, [float("nan")] * 20), (2002, [None] * 20), (2003, [float("-inf")] * 20)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0))
    good = [(r["vec_id"], r["embedding"]) for r in frame.collect() if r["vec_id"] is None or r["vec_id"] < 2000]
    n, deviations, done, explained = brute([v for _, v in good], 16, by_count or None)
    found = whitening.whiten(frame, by_count=by_count).collect()
    assert len(found) == 16 * len(good)
    per_id = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        per_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append((r["whitened"], r["deviation"]))
    signs = {k: np.sign(per_id[0][k][0][0] * done[0, k - 1]) for k in range(1, 17)}
    for (i, _), d, w in zip(good, deviations, done):
        for k in range(1, 17):
            assert all(dev == d and abs(signs[k] * z - w[k - 1]) < 1e-8 for z, dev in per_id[i][k])
            assert len(per_id[i][k]) == sum(j == i for j, _ in good)


def test_no_spread_few_vectors_and_lengths(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    rows = whitening.whiten(same).collect()
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, 0.0) for r in rows)
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 2.0]), (3, [5.0]), (4, [6.0]), (5, [])], SCHEMA)
    rows = {(r["vec_id"], r["component"]): r for r in whitening.whiten(mixed).collect()}
    assert sorted(rows) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)]
    assert {round(abs(rows[k]["whitened"]), 9) for k in ((1, 1), (2, 1), (3, 1), (4, 1))} == {1.0}
    assert rows[1, 2]["whitened"] is None and rows[1, 2]["explained"] == 0.0 and rows[1, 1]["identity_error"] < 1e-12
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_components(spark):
    rows = [(k, [float(s) * 1e30, 3e9 * k, 0.5]) for k, s in enumerate([1, -1, 1, -1])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["deviation"] for r in found} == {(1 << 63) - 1} and {r["n"] for r in found} == {4}
    assert all(r["identity_error"] < 1e-4 for r in found)
