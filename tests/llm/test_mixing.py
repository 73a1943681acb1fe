import itertools
import random
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling round by round; sizes by source in order."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def test_fit_against_all_subsets():
    rng = random.Random(4)
    for _ in range(150):
        lengths = rng.sample(range(1, 30), rng.randrange(1, 5))
        counts = [rng.randrange(1, 4) for _ in lengths]
        budget = rng.randrange(0, 100)
        taken = mixing.fit_lengths(np.array(lengths), np.array(counts), budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        sums = {sum(a * b for a, b in zip(lengths, t)) for t in itertools.product(*[range(c + 1) for c in counts])}
        assert int(taken @ lengths) == max(s for s in sums if s <= budget)


def test_fit_of_large_budgets():
    rng = np.random.default_rng(6)
    lengths = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 50, len(lengths))
    for share in (0.013, 0.4, 0.97):
        budget = int(share * (lengths @ counts))
        taken = mixing.fit_lengths(lengths, counts, budget)
        assert ((taken >= 0) & (taken <= counts)).all() and int(taken @ lengths) == budget
    assert mixing.fit_lengths(np.array([0, 0]), np.array([3, 1]), 5).sum() == 0
    assert mixing.fit_lengths(np.array([10**7]), np.array([4]), 25 * 10**6).tolist() == [2]


def test_fit_of_very_long_documents():
    fit = lambda lengths, counts, budget: mixing.fit_lengths(np.array(lengths), np.array(counts), budget).tolist()
    for length in (32_769, 70_000, 131_073, 150_000, 200_003, 10**7):
        for n in (1, 2, 3, 4, 39, 40):
            for over in (0, 1, 10_000, 32_767, length - 1):
                assert fit([length], [40], n * length + over) == [n]
    assert fit([200_000], [4], 210_000) == [1] and fit([200_000], [40], 820_000) == [4] and fit([150_000], [10], 160_000) == [1]
    # Few short documents beside long ones: a long one must not miss its place to an even share of the short ones.
    for budget in range(100_000, 2_100_001, 5_000):
        fits = any(0 <= budget - 200_000 * k <= 100_000 for k in range(11))
        taken = fit([200_000, 5_000], [10, 20], budget)
        got = 200_000 * taken[0] + 5_000 * taken[1]
        assert 0 <= taken[0] <= 10 and 0 <= taken[1] <= 20
        assert got == budget if fits else got == budget // 200_000 * 200_000 + 100_000


def test_fit_of_many_long_and_short_documents():
    rng = np.random.default_rng(9)
    lengths = np.unique(np.concatenate([rng.integers(1, 9_000, 500), rng.integers(32_000, 2_000_000, 300)]))
    counts = rng.integers(1, 4, len(lengths))
    for share in (0.0001, 0.013, 0.4, 0.97):
        budget = int(share * (lengths @ counts))
        taken = mixing.fit_lengths(lengths, counts, budget)
        assert ((taken >= 0) & (taken <= counts)).all() and int(taken @ lengths) == budget


@pytest.mark.parametrize("shape", [{"a": 90, "b": 6, "c": 4}, {"a": 2, "b": 3, "c": 5, "d": 90, None: 7}, {"only": 5}])
def test_mix(spark, documents, shape):
    rng = random.Random(8)
    rows = [{"source": s, "text": " ".join(["w"] * rng.randrange(0, 40))} for s, n in shape.items() for _ in range(n)]
    rows += [{"source": "a", "text": None}, {"source": None, "text": ""}, {"source": "a", "text": "same text"}] + [{"source": "a", "text": "same text"}]
    for k, r in enumerate(rows[:-1]):
        r["doc_id"] = k
    rows[-1]["doc_id"] = rows[-2]["doc_id"]
    docs = documents(*rows)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes, taken, goal = Counter(), Counter(), {}
    for r in rows:
        sizes[r["source"]] += len((r["text"] or "").split())
    source = {r["doc_id"]: r["source"] for r in rows}
    for r in found:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        goal[s] = r["target"]
        assert r["source_size"] == sizes[s] and 0 <= r["taken"] <= 3 * r["size"]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
    expected = brute_targets(sizes)
    for s in sizes:
        assert goal[s] == pytest.approx(expected[s])
        assert abs(taken[s] - goal[s]) <= 41
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, again)) == sorted(map(key, found))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len((r["text"] or "").split())
    for s in sizes:
        assert abs(words[s] - goal[s]) <= 82


def test_empty_tables(documents):
    assert mixing.mix(documents()).collect() == []
    assert mixing.mixed(documents()).collect() == []
    only = mixing.mix(documents({"doc_id": 1, "text": None, "source": "a"})).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0)]
