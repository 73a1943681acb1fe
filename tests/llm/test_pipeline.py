from collections import Counter

import pytest

import corpus_pipeline
from tallyspark.llm import mixing, packing, quality, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gets and returns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.staged(stage(spark, docs, FOLDER), name)
        out.append((name, docs, new))
        docs = new
    return out


def test_stages_keep_the_columns(steps, spark):
    assert [n for n, _, _ in steps] == ["quality_rules", "toxicity", "near_dedup", "mix_sources", "pack"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").dtypes
    for _, _, new in steps[:-1]:
        assert new.dtypes == columns


def test_decisions_take_effect(steps, spark):
    (_, d0, d1), (_, _, d2), (_, _, d3), (_, _, d4), (_, _, pieces) = steps
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids(d1) == ids(quality.judge(d0).filter("kept"))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert ids(d2) == ids(toxicity.judge(d1, labels).filter("predicted = 0"))
    found = simhash.near_duplicates(d2).collect()
    assert ids(d3) == {r["component_id"] for r in found}
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(d3).collect()}
    copies = Counter(r["doc_id"] for r in d4.select("doc_id").collect())
    assert copies == Counter({k: n for k, n in taken.items() if n})
    encoder = packing.Encoder(packing.public_tokenizers.path("word_bpe_49k.json"), 2)
    tokens = Counter()
    for r in pieces.collect():
        tokens[r["doc_id"]] += r["length"]
    texts = {r["doc_id"]: r["text"] for r in d4.select("doc_id", "text").collect()}
    assert tokens == Counter({k: n * len(encoder.encode(texts[k])) for k, n in copies.items()})


def test_run_equals_its_stages(steps, spark):
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(key, steps[-1][2].collect()))


GOOD = "The first words of this text are all in one plain line and each of them is said only once here. "
ODD = [
    {"doc_id": 1, "text": GOOD + "One.", "source": "a", "lang": "en"},
    {"doc_id": 1, "text": GOOD + "One.", "source": "a", "lang": "en"},
    {"doc_id": 1, "text": GOOD + "Another story ends in a garden where nobody was ever seen by those who live nearby.", "source": None},
    {"doc_id": None, "text": GOOD + "And more of it was told by a man from the old town who had to leave before the end.", "source": "b"},
    {"doc_id": None, "text": GOOD + "And more of it was told by a man from the old town who had to leave before the end.", "source": "b"},
    {"doc_id": None, "text": "Some other words that have an end of their own and that is the reason to say them at all.", "_measures": "x"},
    {"doc_id": 2, "text": None, "source": "a"},
    {"doc_id": 3, "text": "", "source": "a"},
    {"doc_id": 4, "text": " ".join(f"the{k} was of{k}" for k in range(30_000)), "source": "b", "n_chars": 5},
]


def _plain(row):
    return tuple(sorted(row.asDict().items(), key=lambda kv: kv[0].lower()))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_with_null_repeated_long_and_empty_rows(spark, documents, stage):
    """Against plain Python: what each stage keeps of odd rows, with columns that are named as those it adds."""
    name, function = stage
    docs = documents(*ODD).withColumnsRenamed({"lang": "_row", "n_chars": "_copies"})
    rows = docs.collect()
    found = function(spark, docs, FOLDER)
    if name != "pack":
        assert found.dtypes == docs.dtypes
    found = [r for r in found.collect()]
    if name == "quality_rules":
        verdicts = quality.judge(docs).collect()
        keep = Counter((r["doc_id"], r["n_words"]) for r in verdicts if r["kept"])
        words = lambda r: len((r["text"] or "").split())
        assert Counter((r["doc_id"], words(r)) for r in found) == keep and sum(keep.values()) >= 5
    elif name == "toxicity":
        assert Counter(map(_plain, found)) == Counter(map(_plain, rows))
    elif name == "near_dedup":
        prints = [simhash.fingerprint(r["text"]) for r in rows]
        groups = {}
        for k, p in enumerate(prints):
            near = [g for g in groups if any((p ^ prints[j]).bit_count() <= 3 for j in groups[g])]
            groups[k] = [k] + [j for g in near for j in groups.pop(g)]
        assert len(found) == len(groups)
        texts = sorted(simhash.fingerprint(r["text"]) for r in found)
        assert all(any(prints[j] in texts for j in g) for g in groups.values())
    elif name == "mix_sources":
        sizes = mixing.mix(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
        assert sum(len((r["text"] or "").split()) for r in found) == sum(r["sum(taken)"] for r in sizes)
        assert set(map(_plain, found)) <= set(map(_plain, rows))
    else:
        encoder = packing.Encoder(packing.public_tokenizers.path("word_bpe_49k.json"), 2)
        total = Counter()
        for r in found:
            total[r["doc_id"]] += r["length"]
        expected = Counter()
        for r in rows:
            expected[r["doc_id"]] += len(encoder.encode(r["text"]))
        assert total == expected


def test_values_in_other_columns_are_other_rows(spark):
    """The same values beside NULLs in another order: two components, two rows."""
    text = "one two three four five six"
    docs = spark.createDataFrame([(7, None, text), (7, text, None)], "doc_id long, text string, lang string")
    assert simhash.keep_first(docs).count() == 2


def test_equal_rows_are_mixed_to_the_word(spark):
    rows = [(1, "one two three", "big")] * 400 + [(2, "one two three", "small")] * 40 + [(1, "one two three", "other")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix(docs).groupBy("source_size").agg({"taken": "sum"}).collect()
    taken = {r["source_size"]: r["sum(taken)"] for r in mix}
    found = Counter(r["source"] for r in mixing.mixed(docs).collect())
    assert {"big": taken[1200], "small": taken[120], "other": taken[9]} == {s: 3 * n for s, n in found.items()}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_of_an_empty_table(spark, documents, stage):
    assert stage[1](spark, documents(), FOLDER).collect() == []
