import random

import numpy as np
import pytest

from tallyspark.llm import toxicity as X


def brute_kernel(s, t, order=X.ORDER, decay=X.DECAY):
    """All pairs of equal subsequences, weighed by the stretches they span."""
    from itertools import combinations

    total = 0.0
    for i in combinations(range(len(s)), order):
        for j in combinations(range(len(t)), order):
            if all(s[a] == t[b] for a, b in zip(i, j)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_against_all_subsequences():
    rng = random.Random(1)
    words = ["".join(rng.choices("abé", k=rng.randrange(3, 9))) for _ in range(12)]
    marks = ["".join(rng.choices("abé", k=rng.randrange(4, 7))) for _ in range(5)]
    found = X.kernel(X.codes(words, 9), X.codes(marks, 6))
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            assert found[i, j] == pytest.approx(brute_kernel(w, m), rel=1e-4)


def test_longest_common_subsequence():
    def brute(s, t):
        best = [[0] * (len(t) + 1) for _ in range(len(s) + 1)]
        for i, a in enumerate(s):
            for j, b in enumerate(t):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(2)
    words = ["".join(rng.choices("abcd", k=rng.randrange(1, 12))) for _ in range(60)]
    for mark in ("abca", "ddddcba", "a"):
        assert X.in_order(X.codes(words, 12), X.codes([mark], 8)[0]).tolist() == [brute(w, mark) for w in words]


def test_gapped_and_inserted_characters_stay_close():
    k = X.Kernels(["idiot", "stupid"])
    forms = ["idiot", "Idiot!", "i.d.i.o.t", "id-iot", "idiiot", "st_upid", "x" * 100 + "idiot" + "x" * 100]
    described = k.sentences([f"You are {f} there." for f in forms] + ["i d i o t", "the idyll of it", None, ""])
    best = [max((float(x.max()) for x in d), default=0.0) for d in described]
    assert all(b > 0.6 for b in best[:6] + best[7:8]) and best[6] > 0.0 and best[8:] == [0.0] * 3


def test_memory_starts_anew_without_change(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("idotxe", k=6)) for _ in range(50)) + " idiot." for _ in range(600)]
    whole = X.Kernels(["idiot"]).sentences(texts)
    monkeypatch.setattr(X, "MEMORY", 700)
    again = X.Kernels(["idiot"]).sentences(texts)
    assert [[x.tolist() for x in d] for d in whole] == [[x.tolist() for x in d] for d in again]


@pytest.fixture()
def corpus(documents, spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("thereinsoaw", k=rng.randrange(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        text = rng.choices(words, k=rng.randrange(5, 60))
        toxic = k % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["blockhead", "dimwit", "numpty"]))
        rows.append({"doc_id": k, "text": " ".join(text) + ".", "lang": "toxic" if toxic else "ok", "source": str(toxic)})
        labels.append((k, int(toxic)))
    rows += [{"doc_id": 1000, "text": "You d.i.m.w.i.t over there."}, {"doc_id": 1001, "text": "A numpty numptyy."}]
    rows += [{"doc_id": 1002, "text": None}, {"doc_id": 1003, "text": ""}, {"text": "Nice words here."}, {"text": "Nice words here."}]
    rows += [{"doc_id": 1004, "text": "there is " * 20_000 + "dimwit"}]
    return documents(*rows), spark.createDataFrame(labels + [(None, 1), (2000, 1), (3, None)], "doc_id long, toxic int")


def test_held_out_accuracy(corpus, spark):
    docs, labels = corpus
    rows = X.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.dropna().collect()}
    known = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert len(known) > 100 and all(r["predicted"] == truth[r["doc_id"]] for r in known)
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[k]["predicted"] for k in (1000, 1001, 1002, 1003, 1004, None)] == [1, 1, 0, 0, 1, 0]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    kept = X.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_held_out_labels_are_not_read(corpus, spark):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", labels.toxic)
    held = X.held_out(flipped.doc_id)
    from pyspark.sql import functions as F

    flipped = flipped.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda l: sorted((str(r["doc_id"]), r["score"]) for r in X.judge(docs, l).collect())  # noqa: E731, E741
    assert scores(labels) == scores(flipped)


def test_without_labels_or_documents(documents, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in X.judge(documents({"doc_id": 1, "text": "a b"}), none).collect()] == [0]
    assert X.judge(documents(), none).collect() == []


def test_sample_is_bounded(corpus):
    docs, labels = corpus
    assert X.training_rows(docs, labels, 50).count() == 50
    assert np.isin([r["toxic"] for r in X.training_rows(docs, labels, 50).collect()], [0, 1]).all()


def test_repeated_ids_are_one_row(documents, spark):
    docs = documents(*[{"doc_id": 1, "text": f"text {k}"} for k in range(500)], {"doc_id": 3, "text": "other"})
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    found = sorted(tuple(r) for r in X.training_rows(docs, labels, 10).collect())
    assert found == [t for t in [(1, "text 0", 1), (3, "other", 0)] if t[0] in {r["doc_id"] for r in labels.filter(~X.held_out(labels.doc_id)).collect()}]
    assert found


def test_more_candidates_raise_the_share(corpus, monkeypatch):
    rows = X.training_rows(*corpus)
    whole = X.landmarks(rows)
    monkeypatch.setattr(X, "CANDIDATES", 6)
    assert X.landmarks(rows) and set(X.landmarks(rows)) <= set(whole)
