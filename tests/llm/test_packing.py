import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    None,
    " \t\n",
    "Straße ÄÖ don't 12.5% naïve café — “q”",
    "<|endoftext|> x<|startoftext|>y",
    "İΣας ΣΑΣ \x1c\x85   á 漢字 ½ ² ǅ ﬁ",
    "it's I'll we've\x0bx\x0cy\rz ''s",
    "ß" * 300 + "x" * 3000,
]


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_the_tokenizers_own(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    encoder = packing.Encoder(PATH, 2)
    for t in ODD:
        assert encoder.encode(t).tolist() == whole(tokenizer, t), repr(t)
    monkeypatch.setattr(packing, "WORDS", 5)
    for t in ODD * 2:
        assert encoder.encode(t).tolist() == whole(tokenizer, t), repr(t)


def test_ids_of_all_texts(spark):
    tokenizer = Tokenizer.from_file(PATH)
    encoder = packing.Encoder(PATH, 2)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert encoder.encode(r["text"]).tolist() == whole(tokenizer, r["text"])


def test_memory_of_words():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("enistrhadu", k=9)) + rng.choice(["", ",", "."]) for _ in range(400)) for _ in range(50)]
    encoder = packing.Encoder(PATH, 2)
    encoder.encode(texts[0])
    tracemalloc.start()
    for t in texts:
        encoder.encode(t)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held / (400 * len(texts)) < 300, held


def test_texts_are_not_copied_to_pandas(documents, capsys):
    packing.pack(documents({"doc_id": 1, "text": "one"})).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "Pandas" not in plan


def test_lowest_cost_first():
    pieces = [packing._Piece(k, k, 0, np.zeros(n, "<u4"), n) for k, n in enumerate([60, 50, 40, 30, 20])]
    sequences = packing.balanced(pieces, 2, 100)
    assert [[len(p.ids) for p in s] for s in sequences] == [[60, 30, 10], [50, 40, 10]]


@pytest.mark.parametrize("length, group", [(4096, 512), (64, 2)])
def test_round_trip(spark, documents, length, group):
    rng = random.Random(7)
    texts = ODD + [" ".join(rng.choices(["alpha", "Beta.", "gamma-ray", "δ"], k=rng.randrange(0, 900))) for _ in range(80)]
    docs = documents(*({"doc_id": k, "text": t} for k, t in enumerate(texts)))
    rows = packing.pack(docs.repartition(3), length, group=group).collect()
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(range(len(texts)))
    for k, found in pieces.items():
        ids, at = np.array(whole(tokenizer, texts[k]), "<u4"), 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and at.bit_count() == 1  # full, or a power of two: no padding


def test_odd_rows(documents):
    same = {"doc_id": None, "text": "one two"}
    rows = packing.pack(documents(same, same).coalesce(1)).collect()
    assert all(r["doc_id"] is None for r in rows) and sum(r["length"] for r in rows) == 2 * rows[0]["doc_tokens"]
    assert packing.pack(documents()).collect() == []
