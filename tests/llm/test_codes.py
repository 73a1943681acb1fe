import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import codes

BAD = (float("nan"), float("inf"), float("-inf"))


def brute(rows, parts, entries, rounds):
    """Codes, errors and codebooks of rows ``(vec_id, vector, label)`` of one length, all distances computed."""
    good = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and x == x and x not in BAD for x in v)]
    whole = [(i, [max(-(1 << 63), min((1 << 63) - 1, int(x * 256 // 1))) for x in v], g) for i, v, g in good]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(whole[0][1])
    cuts = [k * length // parts for k in range(parts + 1)]
    cut = lambda v: [v[a:b] for a, b in zip(cuts, cuts[1:])]
    books = [[cut(v)[p] for _, v, _ in whole[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(w, e)), k) for k, e in enumerate(books[p])) for p, w in enumerate(cut(v))] for _, v, _ in whole]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), a in zip(whole, found) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [min((1 << 63) - 1, sum(d for d, _ in a)) for a in found]
    per_label = {}
    for (_, _, g), e in zip(whole, errors):
        per_label[g] = min((1 << 63) - 1, per_label.get(g, 0) + e)
    rows = [(i, "".join(f"{k:02x}" for _, k in a), e, per_label[g]) for (i, _, g), a, e in zip(whole, found, errors)]
    return sorted(rows, key=repr), ",".join(str(x) for p in books for e in p for x in e)


def both(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    exact = [tuple(r) for r in frame.collect()]
    coded, books = codes.compress(frame.withColumn("length", F.lit("clash")).withColumn("v", F.lit(1)), **settings)
    found = sorted((tuple(r) for r in coded.select("vec_id", "code", "error", "label_error").collect()), key=repr)
    return exact, found, books


def test_against_all_distances(spark):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 0.12) for _ in range(16)], rng.choice([1, 2, None])) for k in range(700)]
    rows += [(1000 + k, rows[3][1], 7) for k in range(90)] + [(3, rows[3][1], 1), (None, rows[5][1], 1), (-4, [0.0] * 16, None)]
    rows += [(2000, None, 1), (2001, [float("nan")] * 16, 1), (2002, [None] + [0.1] * 15, 1), (2003, [float("inf")] * 16, 2)]
    exact, found, books = both(spark, rows, parts=4, entries=32)
    expected, text = brute(exact, 4, 32, 2)
    assert found == expected
    assert [hashlib.sha256(b.text().encode()).digest() for b in books.values()] == [hashlib.sha256(text.encode()).digest()]


def test_huge_components_and_odd_lengths(spark):
    rng = random.Random(6)
    rows = [(k, [rng.choice([1e30, -1e30, 5e8, -3.25, 0.5, 2.0**40]) for _ in range(5)], 0) for k in range(40)]
    exact, found, books = both(spark, rows, parts=3, entries=4)
    expected, text = brute(exact, 3, 4, 2)
    assert found == expected and books[5].text() == text
    assert [p.shape for p in books[5].entries] == [(4, 1), (4, 2), (4, 2)]
    mixed = [(1, [1.0, 2.0], 1), (2, [1.0], 1), (3, [], 2), (4, [0.5, 2.0], 2)]
    _, found, books = both(spark, mixed, parts=2, entries=4)
    assert sorted(books) == [0, 1, 2] and [r[:3] for r in found] == [(1, "0000", 0), (2, "0000", 0), (3, "0000", 0), (4, "0100", 0)]


def test_empty_table(spark):
    _, found, books = both(spark, [])
    assert found == [] and books == {}
    assert both(spark, [(1, None, 2)])[1] == []


def test_cells_drop_entries_and_never_the_nearest():
    rng = np.random.default_rng(3)
    entries = rng.integers(-60, 60, (64, 4))
    grid = codes.Grid(entries, memory=500)
    tried = 0
    for _ in range(5):
        points = rng.integers(-100, 100, (3000, 4))
        best, distance = grid.nearest(points)
        all_ = ((points[:, None, :] - entries) ** 2).sum(axis=2)
        assert (best == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
        tried += grid.candidates(points // grid.width * grid.width).sum()
    assert tried < 0.5 * 5 * 3000 * 64


def test_cells_of_one_hash(monkeypatch):
    """All cells share a hash, so all but one are compared with every entry."""
    monkeypatch.setattr(codes, "_MULTIPLIERS", np.zeros(4096, np.uint64))
    rng = np.random.default_rng(4)
    entries, points = rng.integers(-60, 60, (20, 3)), rng.integers(-90, 90, (500, 3))
    grid = codes.Grid(entries)
    for _ in range(2):
        assert (grid.nearest(points)[0] == ((points[:, None, :] - entries) ** 2).sum(axis=2).argmin(axis=1)).all()
