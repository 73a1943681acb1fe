import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_plans import plan

from tallyspark.plans import extract_runs as runs
from tallyspark.sources import loads, purge
from tallyspark.sources.purge import purge_files, replace_batches_in_files
from tallyspark.sources.sinks import bulk_append
from tallyspark.sources.tables import LedgerTables
from tallyspark.streaming.messages import save_batches, saved, store_batch

SCHEMA = "id int, name string"


@pytest.fixture()
def table(spark, tmp_path):
    """Makes tables, with a folder of their own, that go after the test."""
    made = []

    def make(name, schema, by):
        loads.create_partitioned(spark, name, spark.createDataFrame([], schema).schema, by, str(tmp_path / name))
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def test_a_load_is_there_once_or_not_at_all(spark, table):
    name = table("loaded", f"{SCHEMA}, load_id string", ["load_id"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    assert loads.append_once(first, name, "it's load=1/a")
    assert not loads.append_once(first, name, "it's load=1/a")
    broken = first.withColumn("name", F.when(F.col("id") == 2, F.raise_error(F.lit("cut off"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException):
        loads.append_once(broken, name, "second")
    with pytest.raises(ValueError, match="columns differ"):
        loads.append_once(first.withColumn("more", F.lit(1)), name, "second")
    assert rows(spark.table(name), "id", "name") == [(1, "a"), (2, "b")]
    assert loads.append_once(first.limit(0), name, "second")
    assert sorted(loads.committed_loads(spark, name)) == ["it's load=1/a", "second"]


def test_the_same_load_twice_at_once(spark, table, monkeypatch):
    """The other one commits while this one writes."""
    name = table("raced", f"{SCHEMA}, load_id string", ["load_id"])
    first = spark.createDataFrame([(1, "a")], SCHEMA)
    assert loads.append_once(first, name, "x")
    monkeypatch.setattr(loads, "committed", lambda *_: False)
    assert not loads.append_once(first, name, "x")
    assert spark.table(name).count() == 1


def test_readers_see_old_or_new_and_never_none(spark, table, monkeypatch):
    name = table("switched", "account string, LastUpdatedBy string", ["LastUpdatedBy"])
    start = [("CJ1", "1"), ("CJ2", "2"), ("x", "3"), (None, "4")]
    bulk_append(spark.createDataFrame(start, "LastUpdatedBy string, account string"), name)
    seen, run = [], loads._run

    def watched(session, statement):
        seen.append(rows(session.table(name), "account"))
        done = run(session, statement)
        session.catalog.refreshTable(name)
        seen.append(rows(session.table(name), "account"))
        return done

    monkeypatch.setattr(loads, "_run", watched)
    new = spark.createDataFrame([("CJ1", "5"), ("CJ1", "6"), ("it's \\ new", "7")], "LastUpdatedBy string, account string")
    loads.switch_batches(new, name, ["CJ1", "CJ2", "it's \\ new", "CJ4"])
    for accounts in seen:
        found = {a for (a,) in accounts}
        assert {"3", "4"} <= found and (found & {"1"} or {"5", "6"} <= found) and not ("1" in found and "5" in found)
    assert rows(spark.table(name), "account") == [("3",), ("4",), ("5",), ("6",), ("7",)]
    # From the table itself, and a row of another batch changes nothing.
    loads.switch_batches(spark.table(name).filter("LastUpdatedBy = 'CJ1'").withColumn("account", F.upper("account")), name, ["CJ1"])
    with pytest.raises(PySparkException, match="another batch"):
        loads.switch_batches(new, name, ["CJ1"])
    assert rows(spark.table(name), "account") == [("3",), ("4",), ("5",), ("6",), ("7",)]


def test_other_partitions_keep_their_files(spark, table):
    name = table("kept_files", "account string, LastUpdatedBy string", ["LastUpdatedBy"])
    bulk_append(spark.createDataFrame([("a", "1"), ("b", "2")], "LastUpdatedBy string, account string"), name)
    files = lambda: {r[0] for r in spark.table(name).filter("LastUpdatedBy = 'b'").select("_metadata.file_path").collect()}
    before = files()
    loads.switch_batches(spark.createDataFrame([("a", "3")], "LastUpdatedBy string, account string"), name, ["a"])
    assert files() == before


def test_periods(spark, table):
    name = table("periods", "AccountID string, Balance int, period string, basis string", ["period", "basis"])
    one = spark.createDataFrame([("A1", 5)], "AccountID string, Balance int")
    loads.switch_period(one, name, "2001", "A")
    loads.switch_period(one.withColumn("basis", F.lit("C")), name, "2001", "C")
    loads.switch_period(one.limit(0), name, "2001", "A")
    assert rows(spark.table(name), "period", "basis", "Balance") == [("2001", "C", 5)]
    with pytest.raises(PySparkException, match="another period"):
        loads.switch_period(one.withColumn("period", F.lit("2002")), name, "2001", "C")


@pytest.fixture()
def keyed(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string, v int").schema
    loads.create_keyed(spark, "keyed_rows", schema, ["a", "b"], str(tmp_path / "keyed_rows"), buckets=8)
    yield "keyed_rows", lambda *r: spark.createDataFrame(list(r), schema)
    spark.sql("DROP TABLE keyed_rows")
    spark.sql("DROP TABLE keyed_rows_keys")


def test_keys(spark, keyed, monkeypatch):
    name, make = keyed
    add = lambda load, *r: loads.append_keyed(make(*r), name, load, ["a", "b"])
    assert add("1", (1, "x", 1), (1, "y", 1)) and not add("1", (1, "x", 1))
    for load, bad, inside, stored in (
        ("2", [(2, "x", 1), (2, "x", 2)], [(2, "x")], []),
        ("3", [(3, "x", 1), (1, "y", 2)], [], [(1, "y")]),
        ("4", [(3, None, 1)], [(3, None)], []),
    ):
        with pytest.raises(loads.KeyClash) as clash:
            add(load, *bad)
        assert rows(clash.value.inside, "a", "b") == inside and rows(clash.value.stored) == stored
    # A load that fails after its keys were written can be run again.
    with monkeypatch.context() as m:
        m.setattr(loads, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            add("5", (5, "x", 1))
    assert add("5", (5, "x", 1)) and add("6", (6, "x", 1))
    assert rows(spark.table(name), "a", "b") == [(1, "x"), (1, "y"), (5, "x"), (6, "x")]


def test_stored_keys_are_not_shuffled(spark, keyed, settings):
    name, make = keyed
    loads.append_keyed(make((1, "x", 1), (2, "y", 1)), name, "1", ["a", "b"])
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    load = spark.range(100_000).selectExpr("int(id) a", "string(id) b", "1 v")
    text = plan(loads.stored_clashes(load, name, ["a", "b"]))
    join = text.index("SortMergeJoin")
    between = text[join : text.index("keyed_rows_keys")]
    # One exchange below the join, which is the new keys' own.
    assert between.count("Exchange hashpartitioning") == 1 and "Range" in between[between.index("Exchange") :], text
    assert "Bucketed: true" in text and "load_id" in text[text.index("PartitionFilters") :]


def test_batches_of_messages_run_twice(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, '{"k": 1}'), (2, "{broken"), (3, None)], "id int, body string").write.parquet(source)
    stream = spark.readStream.schema("id int, body string").parquet(source)
    for _ in range(2):
        save_batches(stream, "body", "k int", folder, str(tmp_path / "progress"), available_now=True).awaitTermination()
    fields = spark.createDataFrame([], "id int, k int").schema
    expected = [(1, 1)], [(2, "{broken"), (3, None)]
    both = lambda: (rows(saved(spark, folder, fields).records, "id", "k"), rows(saved(spark, folder, fields).rejects, "id", "raw"))
    assert both() == expected
    # The batch is run again, as after a failure before its progress was noted.
    again = spark.read.schema("id int, body string").parquet(source)
    store_batch(again, 0, "body", "k int", folder)
    assert both() == expected
    store_batch(again.filter("id > 3"), 1, "body", "k int", folder)
    assert both() == expected


def _files(spark, path):
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return {r[0]: r[1] for r in files.collect()}


def test_purge_writes_only_the_files_that_hold_the_tag(spark, tmp_path):
    path = str(tmp_path / "a ledger")
    start = [("CJ1", 1), ("CJ1", 2), ("x", 3), ("y", 4), (None, 5), ("CJ2", 6)]
    for tag, number in start:
        spark.createDataFrame([(tag, number)], "LastUpdatedBy string, file int").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("CJ1", 7), ("x", 8), (None, 9)], "LastUpdatedBy string, file int").coalesce(1).write.mode("append").parquet(path)
    before = _files(spark, path)
    assert purge_files(spark, path, F.col("LastUpdatedBy").isin(["CJ1"])) == 3
    assert rows(spark.read.parquet(path), "file") == [(3,), (4,), (5,), (6,), (8,), (9,)]
    after = _files(spark, path)
    # Files that are empty now have no row that could name them; all others have their names, and four are untouched.
    assert set(after) <= set(before) and sum(after[f] == before[f] for f in after) == 4
    assert purge_files(spark, path, F.col("LastUpdatedBy").isin(["CJ1"])) == 0
    own = spark.read.parquet(path).filter("LastUpdatedBy = 'CJ2'").selectExpr("LastUpdatedBy", "file + 100 as file")
    assert replace_batches_in_files(own, path, ["CJ2", "CJ9"]) == 1
    assert rows(spark.read.parquet(path), "file") == [(106,), (3,), (4,), (5,), (8,), (9,)]


def test_purge_sorts_no_rows_and_names_may_clash(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    for number in range(12):
        frame = spark.createDataFrame([("t", number, "f"), ("x", 10 + number, "g")], "LastUpdatedBy string, number int, file string")
        frame.coalesce(1).write.mode("append").parquet(path)
    plans, write = [], DataFrameWriter.parquet

    def seen(writer, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        assert not writer._partitioned
        return write(writer, *args, **kwargs)

    partitioned = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "_partitioned", False, raising=False)
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda w, *c: setattr(w, "_partitioned", True) or partitioned(w, *c))
    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    assert purge_files(spark, path, F.col("LastUpdatedBy") == "t") == 12
    assert plans and not any("Sort " in p for p in plans)
    assert rows(spark.read.parquet(path)) == sorted((("x", 10 + n, "g") for n in range(12)), key=repr)


def test_a_broken_purge_is_run_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    for number in range(4):
        frame = spark.createDataFrame([("t", number), ("x", 10 + number)], "LastUpdatedBy string, number int")
        frame.coalesce(1).write.mode("append").parquet(path)
    moved, move = [], purge._move_over

    def breaks(*paths):
        if len(moved) == 2:
            raise RuntimeError("lost")
        moved.append(paths)
        move(*paths)

    with monkeypatch.context() as m:
        m.setattr(purge, "_move_over", breaks)
        with pytest.raises(RuntimeError):
            purge_files(spark, path, F.col("LastUpdatedBy") == "t")
    assert spark.read.parquet(path).filter("LastUpdatedBy = 'x'").count() == 4
    assert purge_files(spark, path, F.col("LastUpdatedBy") == "t") == 2
    assert rows(spark.read.parquet(path), "number") == [(10,), (11,), (12,), (13,)]


def test_columns_of_a_stored_table(spark, table):
    name = table("gaining", "F2 string, run string", ["run"])
    loads.switch_partition(spark.createDataFrame([("old",)], "F2 string"), name, {"run": "0"})
    files = _names(spark, name)
    assert loads.ensure_stored_columns(spark, name, {"Balance": "decimal(19,4)", "f2": "string"}, 0) == ["Balance"]
    assert loads.ensure_stored_columns(spark, name, {"AccountID": "string"}) == ["AccountID"]
    assert loads.ensure_stored_columns(spark, name, {"accountid": "string", "BALANCE": "decimal(19,4)"}) == []
    loads.switch_partition(spark.createDataFrame([("new", "A1", None), ("more", None, 5)], "F2 string, AccountID string, Balance int"), name, {"run": "1"})
    assert rows(spark.table(name), "F2", "AccountID", "Balance") == [("more", None, 5.0), ("new", "A1", None), ("old", None, 0.0)]
    assert files <= _names(spark, name)


def _names(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_a_run_starts_from_what_the_one_before_has_left(frames, tmp_path):
    spark = frames.spark
    extract = frames.extract(
        {"basis": "A", "F2": "10 · Cash", "Debit": 5}, {"basis": "A", "F2": "odd"}, {"basis": "A", "F2": None, "Debit": 9}
    )
    bundle = LedgerTables(lambda name: None).replacing(
        qb_accounts=frames.qb({"ListID": "L1", "FullName": "Cash"}), accounts=frames.accounts({"AccountID": "A1", "QBLinkID": "L1"})
    )
    runs.create_extract(spark, "extract_states", str(tmp_path / "states"))
    try:
        runs.store_extract(extract, "extract_states", "0")
        ledger = frames.tb({"basis": "A", "AccountID": "A1", "Balance": 2}, {"basis": "A", "AccountID": "A7", "Balance": 4})
        state = lambda df: rows(df, "F2", "AccountID", "FinalBalance")
        expected = [("10 · Cash", "A1", 3.0), ("odd", None, 0.0), (None, "A7", -4.0)]
        assert state(runs.reconcile_run(bundle, "extract_states", ledger, "0", "1")) == expected
        assert state(runs.reconcile_run(bundle, "extract_states", ledger, "1", "2")) == expected
        # The ledger has lost the account meanwhile: its row of the earlier run is gone, too.
        later = ledger.filter("AccountID = 'A1'")
        assert state(runs.reconcile_run(bundle, "extract_states", later, "2", "3")) == expected[:2]
        with pytest.raises(ValueError, match="from itself"):
            runs.reconcile_run(bundle, "extract_states", later, "2", "2")
        assert state(spark.table("extract_states").filter("run = '1'")) == expected
    finally:
        spark.sql("DROP TABLE extract_states")
