import random

import numpy as np
import xxhash

from tallyspark.llm import simhash
from tallyspark.llm.components import connected


def brute_print(text):
    """The fingerprint bit by bit."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    shingles = [" ".join(found[k : k + 3]) for k in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The least position reachable from each by links of three bits or fewer."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprint():
    rng = random.Random(1)
    texts = ["", None, " \n\t", "One", "one TWO", "é À ÄÖ x y", "a b c a b c a b c", "x" * 5000]
    texts += [" ".join(rng.choices("ab Cd é fgh".split(), k=rng.randrange(1, 60))) for _ in range(40)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_print(t)
    assert simhash.fingerprint(None) == 0


def test_long_text_in_steps(monkeypatch):
    text = " ".join(str(k % 97) for k in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_STEP", 64)
    assert simhash.fingerprint(text) == whole == brute_print(text)


def test_tiles_against_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64))) for b in base for _ in range(4)]
    prints = np.unique(np.concatenate([base, np.array(near, np.uint64), np.array([0, 7, (1 << 64) - 1], np.uint64)]))
    half = len(prints) // 2
    for left, right in ((prints, None), (prints[:half], prints[half:])):
        a, root = simhash.tile_forest(left, right, 3)
        label = {int(p): int(p) for p in prints.view(np.int64)} | dict(zip(a.tolist(), root.tolist()))
        both = list(map(int, prints))
        n = len(both)
        inside = [(i, j) for i in range(n) for j in range(i) if (both[i] ^ both[j]).bit_count() <= 3]
        if right is not None:
            inside = [(i, j) for i, j in inside if (i < half) != (j < half)]
        parent = list(range(n))
        for i, j in inside:
            old, new = parent[i], parent[j]
            parent = [new if p == old else p for p in parent]
        signed = prints.view(np.int64).tolist()
        for i in range(n):
            for j in range(n):
                assert (parent[i] == parent[j]) == (label[signed[i]] == label[signed[j]])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (5, 4), (5, 4)]
    found = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_against_brute_force(spark, documents):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(12):
        text = rng.choices(words, k=400)
        texts.append(" ".join(text))
        for _ in range(3):
            text = list(text)
            text[rng.randrange(400)] = "other"
            texts.append(" ".join(text))
    texts += ["", None, "  ", texts[0], texts[0].upper().lower(), "one two", "very " * 3000]
    docs = documents(*({"doc_id": 10 + k, "text": t} for k, t in enumerate(texts)))
    prints = [brute_print(t) for t in texts]
    expected = {10 + k: 10 + c for k, c in enumerate(brute_components(prints))}
    for tile in (simhash.TILE, 5):
        rows = simhash.near_duplicates(docs, tile=tile).collect()
        assert {r["doc_id"]: r["component_id"] for r in rows} == expected
        assert {r["doc_id"]: r["fp"] % (1 << 64) for r in rows} == {10 + k: p for k, p in enumerate(prints)}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(expected.values())


def test_null_ids_and_repeated_rows(spark, documents):
    rows = [{"doc_id": None, "text": "a b c d"}, {"doc_id": 4, "text": "a b c d"}, {"doc_id": 4, "text": "a b c d"}]
    found = simhash.near_duplicates(documents(*rows, {"doc_id": None, "text": "quite another text"})).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in found) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert len(simhash.keep_first(documents(*rows)).collect()) == 1
    assert simhash.near_duplicates(documents()).collect() == []
    assert simhash.keep_first(documents()).collect() == []


def test_each_component_keeps_one_row(spark, documents):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) for _ in range(12)]
    prints = [brute_print(t) for t in texts]
    assert brute_components(prints) == list(range(12))
    a, b, c, *others = texts
    rows = [(None, t) for t in others] + [(None, others[0])] * 3  # distinct texts without id, one of them repeated
    rows += [(4, a), (7, a), (4, b), (2, b)]  # one id with two texts in two components
    rows += [(5, c), (None, c)]  # a copy without id of a row with one
    rows += [(9, None), (9, ""), (None, " ")]
    kept = simhash.keep_first(documents(*({"doc_id": i, "text": t} for i, t in rows))).collect()
    found = sorted(((r["doc_id"], r["text"] or "") for r in kept if (r["text"] or "").strip()), key=repr)
    assert found == sorted([(None, t) for t in others] + [(4, a), (2, b), (5, c)], key=repr)
    assert [r["doc_id"] for r in kept if not (r["text"] or "").strip()] == [9]


def test_one_row_of_several_with_one_id(spark):
    rows = [(4, "a b c d", {"k": str(k)}) for k in range(20)]
    schema = "doc_id long, text string, `_row` map<string,string>"
    found = [simhash.keep_first(spark.createDataFrame(x, schema).repartition(n)).collect() for x, n in ((rows, 1), (rows[::-1], 7))]
    assert found[0] == found[1] and len(found[0]) == 1
