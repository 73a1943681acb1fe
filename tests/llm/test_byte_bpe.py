import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyspark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def engine():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def expected(engine, text):
    return np.array(engine.encode_ordinary(text or ""), "<u4").tobytes()


def test_documents(spark, engine):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = byte_bpe.encode_texts(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r["ids"] == expected(engine, texts[r["doc_id"]]) and r["decoded"] == (texts[r["doc_id"]] or "").encode()


def test_random_texts(engine, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CUTS", 500)
    monkeypatch.setattr(byte_bpe, "WINDOW", 20)
    rng = random.Random(1)
    bits = [" ", " ", "\n", "the", "  ", "\t", "'ll", "'", "don't", "▁", "　", "\x1c", "<|endoftext|>", "1", "23", "՘", "₏", "a" * 70]
    ranges = [(32, 127), (0x80, 0x3000), (0x4E00, 0x9000), (0x1F300, 0x1F700), (0x11DE0, 0x11DEA)]
    own = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    texts = ["".join(rng.choice([*bits, *(chr(rng.randrange(*r)) for r in ranges)]) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        some = [*texts[at : at + 100], None, ""]
        ids = own.encode(some)
        assert ids == [expected(engine, t) for t in some]
        assert [own.decode(i) for i in ids] == [(t or "").encode() for t in some]


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab" * 20000, "x y" * 500_000, "!" * 999, "\n" * 777 + "a", " a", "a ", " "])
def test_long_runs(engine, text):
    (ids,) = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN).encode([text])
    assert ids == expected(engine, text)


def test_null_repeated_and_empty(spark, documents):
    docs = documents({"doc_id": 1, "text": None}, {"doc_id": None, "text": "two words"}, {"doc_id": 2, "text": ""}, {"doc_id": 1, "text": None})
    found = sorted((r["doc_id"] or 0, len(r["ids"]) // 4, bytes(r["decoded"])) for r in byte_bpe.encode_texts(docs).collect())
    assert found == [(0, 2, b"two words"), (1, 0, b""), (1, 0, b""), (2, 0, b"")]
    assert byte_bpe.encode_texts(documents()).collect() == []


def test_vocabulary_must_be_whole():
    with pytest.raises(ValueError):
        byte_bpe.model_proto({b"a": 0, b"b": 2})
