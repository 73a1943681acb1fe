"""One query for each operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import byte_bpe, chat, codes, licenses, mixing, packing, quality, simhash, topk, toxicity, url_filter, warc, whitening
from tallyspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@_query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@_query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@_query
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_rows(table(spark, folder, "embeddings"))


@_query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found


@_query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


@_query
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(table(spark, folder, "conversations"))


@_query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@_query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codes.compress(table(spark, folder, "embeddings"))
    text = F.lit(None).cast("string")
    for length, own in books.items():
        text = F.when(F.col("length") == length, F.lit(own.text())).otherwise(text)
    return coded.select("vec_id", "code", "error", "label_error", F.sha2(text, 256).alias("codebooks_sha256"))


@_query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@_query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = byte_bpe.encode_texts(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
