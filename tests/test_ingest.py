from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from tallyspark.functions.types import RUNTIME_TYPES
from tallyspark.operators import ingest
from tallyspark.sources import staging
from tallyspark.sources.sinks import bulk_append, bulk_append_path
from tallyspark.sources.staging import staging_path, staging_root
from tallyspark.sources.tables import TABLE_NAMES, read_catalog, read_parquet
from tallyspark.streaming.messages import save_messages


def meta(name, kind, **flags):
    return {"ColumnName": name, "DataType": f"System.{kind}", **flags}


META = [
    meta("id", "Int64", AllowDBNull=False, IsKey=True),
    meta("note", "String", ColumnSize=5),
    meta("secret", "String", IsHidden=True),
    meta("price", "Decimal", NumericPrecision=20, NumericScale=6),
    meta("when", "DateTime", AllowDBNull=False, IsHidden=False),
    meta("tiny", "Byte", AllowDBNull=None),
]


def test_schema_from_metadata():
    assert ingest.metadata_schema(META) == T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("note", T.StringType()),
            T.StructField("price", T.DecimalType(13, 2)),
            T.StructField("when", T.TimestampType(), False),
            T.StructField("tiny", T.ShortType()),
        ]
    )
    with pytest.raises(ValueError, match="System.TimeSpan not implemented"):
        ingest.metadata_schema([meta("x", "TimeSpan")])
    assert len(RUNTIME_TYPES) == 11


def test_conform_to_metadata(spark):
    df = spark.createDataFrame(
        [("1", "abcdefgh", "s", Decimal("1.235"), "2001-01-02 03:04:05", 255), (None, None, None, None, None, None)],
        "id string, note string, secret string, price decimal(20,6), when string, tiny int",
    )
    result = ingest.conform_to_metadata(df, META)
    assert [f.dataType for f in result.schema] == [f.dataType for f in ingest.metadata_schema(META)]
    assert result.first() == (1, "abcdefgh", Decimal("1.24"), datetime(2001, 1, 2, 3, 4, 5), 255)
    assert rows(ingest.null_violations(result, META)) == [("id", 1), ("when", 1)]
    assert ingest.null_violations(result, [meta("note", "String")]).count() == 0


def test_key_columns():
    assert ingest.key_columns(META) == ["id"]
    assert ingest.key_columns(META, 2) == ["id", "note"]
    assert ingest.key_columns(META, [4, 0]) == ["when", "id"]
    assert ingest.key_columns([meta("x", "Int32")]) == []


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None)], "x int, y string")
    assert rows(ingest.key_violations(df, ["x", "y"])) == [(1, "a", 2), (2, None, 1), (None, "c", 1)]
    assert rows(ingest.key_violations(df, [])) == []


def test_conform_frame(spark):
    df = spark.range(1).selectExpr(
        "id", "1.5d as d", "cast(2 as byte) b", "cast(3 as short) s", "date'2001-01-01' day", "'x' t", "true f",
        "cast(1.005 as decimal(10,3)) m",
    )
    result = ingest.conform_frame(df)
    assert [f.dataType.simpleString() for f in result.schema] == [
        "bigint", "float", "smallint", "int", "timestamp", "string", "boolean", "decimal(13,2)",
    ]
    with pytest.raises(ValueError, match="array<int> not implemented"):
        ingest.conform_frame(spark.sql("select array(1) a"))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_staging_ids_are_dense_and_texts_whole(spark, n):
    df = spark.range(0, n, 1, 7).selectExpr("(id * 37) % 1009 as k", "repeat('x', 300) as long", "null as nothing")
    result = ingest.to_staging(df, 5, ["k"])
    assert result.columns == ["rowID", *[f"column{i}" for i in range(1, 6)]]
    found = sorted((r.rowID, int(r.column1), len(r.column2), r.column3, r.column4, r.column5) for r in result.collect())
    keys = sorted((i * 37) % 1009 for i in range(n))
    assert found == [(i, k, 300, None, None, None) for i, k in enumerate(keys, start=1)]


def test_staging_refuses_what_it_cannot_hold(spark):
    df = spark.createDataFrame([("x" * 255, 1)], "text string, k int")
    assert ingest.to_staging(df, 2, ["text"], width=255).count() == 1
    with pytest.raises(Exception, match="longer than 255"):
        ingest.to_staging(df.selectExpr("text || 'y' as text", "k"), 2, ["text"], width=255)
    with pytest.raises(ValueError, match="1 staging columns cannot hold the 2"):
        ingest.to_staging(df, 1, ["text"])


def test_staging_spreads_rows_of_one_order_key(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    copies = spark.range(0, 4000, 1, 8).selectExpr("'same' as k", "'copy' as text")
    result = ingest.to_staging(copies, 2, ["k"])
    assert sorted(r.rowID for r in result.collect()) == list(range(1, 4001))
    assert len([f for f in result.inputFiles() if "numbered_rows" in f]) > 4


def test_bulk_append(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    path = staging_path(spark, "rows")
    bulk_append_path(df, path)
    bulk_append_path(df, path)
    assert spark.read.parquet(path).count() == 2
    spark.sql("create table appended (name string, id int) using parquet")
    try:
        bulk_append(df, "appended")
        bulk_append(df, "appended")
        assert rows(spark.table("appended")) == [("a", 1), ("a", 1)]
    finally:
        spark.sql("drop table appended")


def test_appends_refuse_other_columns(spark):
    path = staging_path(spark, "rows")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    bulk_append_path(df, path)
    bulk_append_path(spark.createDataFrame([("b", 2)], "name string, id short"), path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]
    spark.sql("create table strict_rows (name string, id int) using parquet")
    try:
        for other in ("1 as id", "1 as id, 'a' as name, 2 as more", "1 as id, 'a' as nam"):
            frame = spark.sql(f"select {other}")
            with pytest.raises(ValueError, match="columns differ"):
                bulk_append_path(frame, path)
            with pytest.raises(ValueError, match="columns differ"):
                bulk_append(frame, "strict_rows")
        with pytest.raises(ValueError, match="id: bigint to int"):
            bulk_append_path(df.withColumn("id", df.id.cast("long")), path)
        assert spark.read.parquet(path).count() == 2 and spark.table("strict_rows").count() == 0
    finally:
        spark.sql("drop table strict_rows")


TEXTS = [
    '{"k": 1}', '{"k": ', '{"k": "no"}', None, "", '{"other": 2}', '{"k": null}', "  ", '{"k": 1} junk', '{"k": 1}{"k": 2}',
    '[{"k": 1}]', '{"k": 1},{"k": 2}', "5", '  {"k": 7}  ', "{}",
]


def test_json_records(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string")
    parsed = ingest.json_records(df, "body", "k int")
    bad = [1, 2, 3, 4, 7, 8, 9, 10, 11, 12]
    assert sorted((r.id, r.raw) for r in parsed.rejects.collect()) == [(i, TEXTS[i]) for i in bad]
    assert rows(parsed.records) == [(0, 1), (13, 7), (14, None), (5, None), (6, None)]
    assert parsed.records.schema["k"].dataType == T.IntegerType()


def test_messages_are_saved_once(spark):
    source, target, refused, progress = (staging_path(spark, n) for n in ("inbox", "messages", "refused", "progress"))
    df = spark.createDataFrame([(f'{{"k": {i}}}',) for i in range(5)] + [("broken",), (None,)], "body string")
    for times in (1, 2):
        df.write.mode("append").parquet(source)
        stream = spark.readStream.schema("body string").parquet(source)
        save_messages(stream, "body", "k int", target, refused, progress, available_now=True).await_termination()
        assert spark.read.parquet(target).count() == 5 * times
        assert rows(spark.read.parquet(refused)) == sorted([("broken",), (None,)] * times, key=repr)


def test_ledger_tables_are_read_when_asked_for(spark):
    root = staging_path(spark, "ledger")
    spark.createDataFrame([("A1",)], "AccountID string").write.parquet(f"{root}/account_list")
    tables = read_parquet(spark, root)
    assert rows(tables.accounts) == [("A1",)]
    other = tables.replacing(bills=spark.createDataFrame([("B1",)], "VendorBillID string"))
    assert rows(other.bills) == [("B1",)] and rows(other.accounts) == [("A1",)]
    with pytest.raises(AttributeError):
        tables.invoices
    spark.sql("create database if not exists books")
    spark.sql("create table books.account_list using parquet as select 'A2' AccountID")
    try:
        assert rows(read_catalog(spark, "books").accounts) == [("A2",)]
    finally:
        spark.sql("drop database books cascade")
    assert len(TABLE_NAMES) == 13


class Session:
    """Stands in for a session in which only what names the folder is set."""

    def __init__(self, setting=None, checkpoint=None, master="local[2]"):
        self.conf, self.sparkContext = self, self
        self._values, self._checkpoint, self.master, self.applicationId = {"spark.checkpoint.dir": setting}, checkpoint, master, "app-1"

    def get(self, key, default=None):
        return self._values.get(key) or default

    def set(self, key, value):
        self._values[key] = value

    def getCheckpointDir(self):
        return self._checkpoint


def test_staging_root():
    assert staging_root(Session("hdfs:///a", "hdfs:///b", "yarn")) == "hdfs:///a"
    assert staging_root(Session(None, "hdfs:///b", "yarn")) == "hdfs:///b"
    local = Session()
    assert staging_root(local) == staging_root(local)
    for master in ("yarn", "spark://host:1", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            staging_root(Session(master=master))


def test_staging_root_comes_from_the_session(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_frames_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(staging, "run_folder", lambda s: f"{staging_root(s)}/tallyspark/another-run")
    frame = staging.staged(spark.range(3), "numbers")
    assert frame.count() == 3 and "another-run" in frame.inputFiles()[0]
    assert staging.clear_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(frame.inputFiles()[0])
