from datetime import datetime

import pytest
from conftest import AS_OF, rows

from tallyspark.operators import journals, recheck, validation
from tallyspark.sources.sinks import bulk_append, replace_batches

AT = datetime(2001, 7, 1, 12)


def row(account, balance, basis="A", kind=None, label="x"):
    return {"basis": basis, "F2": label, "AccountID": account, "FinalBalance": balance, "JournalType": kind}


def made(frames, *final):
    return journals.generate_journals(frames.final(*final), AS_OF, updated=AT)


LINE = ("LastUpdatedBy", "TransactionType", "CreditAccountID", "CreditAmount", "DebitAccountID", "DebitAmount")
HEADER = ("LastUpdatedBy", "TransactionType", "TransactionAmount", "ParentAccountID")


def test_nothing_to_book(frames):
    result = made(frames, row("A1", 0), row("A2", None), row("A3", 5, "A", "Hybrid"))
    assert result.headers.count() == 0 and result.details.count() == 0


def test_accrual_takes_its_parent_from_the_debits(frames):
    result = made(frames, row("A1", 10), row(" A3", 5), row("A2", -4))
    assert rows(result.headers, *HEADER) == [("CJ200106A", 45, 15.0, "A3")]
    assert rows(result.details, *LINE) == [
        ("CJ200106A", 20, None, None, "A3", 5.0),
        ("CJ200106A", 45, "A2", 4.0, None, None),
        ("CJ200106A", 45, "BQ101", 11.0, None, None),
        ("CJ200106A", 45, None, None, "A1", 10.0),
    ]


def test_hybrid_takes_its_parent_from_the_credits(frames):
    result = made(frames, row("A1", 10, "C", "Hybrid"), row("A3", -5, "C", "Hybrid"), row("A2", -40, "C", "Hybrid"))
    assert rows(result.headers, *HEADER) == [("CJ200106HYB", 5, 10.0, "A3")]
    assert rows(result.details, *LINE) == [
        ("CJ200106HYB", 20, "A3", 5.0, None, None),
        ("CJ200106HYB", 5, "A2", 40.0, None, None),
        ("CJ200106HYB", 5, "BQ101", -35.0, None, None),
        ("CJ200106HYB", 5, None, None, "A1", 10.0),
    ]


def test_hybrid_of_debits_has_no_parent_line(frames):
    result = made(frames, row("A1", 10, "C", "Hybrid"))
    assert rows(result.details, *LINE) == [
        ("CJ200106HYB", 5, "BQ101", 10.0, None, None),
        ("CJ200106HYB", 5, None, None, "A1", 10.0),
    ]
    checks = validation.parent_lines_per_batch(result.details, ["CJ200106HYB", "CJ200106A"])
    assert rows(checks) == [("CJ200106A", 0, False), ("CJ200106HYB", 0, False)]


def test_hybrid_with_suspense_as_parent_keeps_the_parent_code(frames):
    result = made(frames, row("BQ101", 10, "C", "Hybrid"))
    assert rows(result.details, "TransactionType", "CreditAmount", "DebitAmount") == [
        (20, 10.0, None), (5, None, 10.0),
    ]


def test_credits_only(frames):
    result = made(frames, row("A1", -6), row("A2", -1), row("A9", -3, "C"), row("A8", -2, "C", "Hybrid"))
    assert rows(result.headers, *HEADER) == [
        ("CJ200106A", 45, 0.0, "A2"), ("CJ200106C", 46, 0.0, "A9"), ("CJ200106HYB", 5, 0.0, "A8"),
    ]
    assert rows(result.details, *LINE) == [
        ("CJ200106A", 20, "A2", 1.0, None, None),
        ("CJ200106A", 45, "A1", 6.0, None, None),
        ("CJ200106A", 45, "BQ101", -7.0, None, None),
        ("CJ200106C", 20, "A9", 3.0, None, None),
        ("CJ200106C", 46, "BQ101", -3.0, None, None),
        ("CJ200106HYB", 20, "A8", 2.0, None, None),
        ("CJ200106HYB", 5, "BQ101", -2.0, None, None),
        # Only the hybrid batch fills an empty debit side.
        ("CJ200106HYB", 5, None, None, "BQ101", 0.0),
    ]


def test_debits_only(frames):
    result = made(frames, row("A1", 6), row("A9", 3, "C"))
    assert rows(result.details, *LINE) == [
        ("CJ200106A", 20, None, None, "A1", 6.0),
        ("CJ200106A", 45, "BQ101", 0.0, None, None),
        ("CJ200106A", 45, "BQ101", 6.0, None, None),
        ("CJ200106C", 20, None, None, "A9", 3.0),
        ("CJ200106C", 46, "BQ101", 0.0, None, None),
        ("CJ200106C", 46, "BQ101", 3.0, None, None),
    ]


def test_balanced_batch_has_no_adjustment(frames):
    result = made(frames, row("A1", 6), row("A2", -6))
    assert result.details.count() == 2
    assert rows(result.headers, "TransactionAmount") == [(6.0,)]


def test_every_batch_balances_and_its_header_agrees(frames):
    final = [row(f"A{i}", i * 7 % 11 - 5, b, k) for i in range(40) for b, k in (("A", None), ("C", None), ("C", "Hybrid"))]
    result = made(frames, *final)
    assert recheck.unbalanced(result.details).count() == 0
    assert validation.header_amounts(result.headers, result.details).count() == 0
    assert validation.header_amounts(result.headers, result.details, "credit").count() == 0
    ids = [r.APTransDetailID for r in result.details.collect()]
    assert len(set(ids)) == len(ids)
    again = made(frames, *reversed(final))
    assert rows(again.details) == rows(result.details) and rows(again.headers) == rows(result.headers)


def test_single_steps_give_the_same(frames):
    final = frames.final(
        row("A1", 10), row("A3", -5), row("A7", 4, "C"), row("A5", -5, "C", "Hybrid"), row("A6", 8, "C", "Hybrid")
    )
    items = journals.journal_rows(final)
    facts = journals.journal_facts(items)
    headers = journals.journal_headers(facts, AS_OF, updated=AT)
    assert rows(headers, "LastUpdatedBy", "TransactionAmount") == [
        ("CJ200106A", -10.0), ("CJ200106C", 4.0), ("CJ200106HYB", 5.0),
    ]
    lines = journals.journal_lines(items, facts, "credit", AS_OF, updated=AT)
    for more in (
        journals.journal_lines(items, facts, "debit", AS_OF, updated=AT),
        journals.journal_zero_lines(facts, AS_OF, updated=AT),
        journals.journal_adjustment(facts, AS_OF, updated=AT),
    ):
        lines = lines.unionByName(more)
    whole = journals.generate_journals(final, AS_OF, updated=AT)
    assert rows(journals.retype_lines(lines, headers)) == rows(whole.details)
    assert rows(journals.with_header_amount(headers, lines)) == rows(whole.headers)


@pytest.mark.parametrize("as_array", [False, True])
def test_replace_batch_keeps_other_rows(frames, as_array):
    old = frames.details(*[{"ThisAccountID": a, "LastUpdatedBy": t} for a, t in (("1", "CJ200106A"), ("2", "x"), ("3", None))])
    new = frames.details({"ThisAccountID": "4", "LastUpdatedBy": "CJ200106A"})
    tags = journals.batch_tags(AS_OF) if as_array else ["CJ200106A"]
    assert rows(journals.replace_batch(old, new, tags), "ThisAccountID") == [("2",), ("3",), ("4",)]
    assert rows(journals.replace_batch(old, new.limit(0), tags), "ThisAccountID") == [("2",), ("3",)]


def test_replace_batches_in_a_table(frames):
    spark = frames.spark
    spark.sql("create table kept_lines (account string, LastUpdatedBy string) using parquet partitioned by (LastUpdatedBy)")
    try:
        schema = "LastUpdatedBy string, account string"
        start = spark.createDataFrame([("CJ1", "1"), ("CJ2", "2"), ("x", "3"), (None, "4")], schema)
        bulk_append(start, "kept_lines")
        replace_batches(spark.createDataFrame([("CJ1", "5")], schema), "kept_lines", ["CJ1", "CJ2", "CJ3"])
        assert rows(spark.table("kept_lines"), "account", "LastUpdatedBy") == [("3", "x"), ("4", None), ("5", "CJ1")]
        # Rows that come from the table itself, and a tag with characters that need quoting.
        odd = "it's a \\ tag"
        own = spark.table("kept_lines").filter("LastUpdatedBy = 'CJ1'")
        replace_batches(own.selectExpr("account || '!' as account", "LastUpdatedBy"), "kept_lines", ["CJ1", odd])
        bulk_append(spark.createDataFrame([(odd, "6")], schema), "kept_lines")
        replace_batches(spark.createDataFrame([(odd, "7")], schema), "kept_lines", [odd])
        found = rows(spark.table("kept_lines"), "account", "LastUpdatedBy")
        assert found == [("3", "x"), ("4", None), ("5!", "CJ1"), ("7", odd)]
        with pytest.raises(ValueError, match="other batches"):
            replace_batches(spark.createDataFrame([("CJ9", "8")], schema), "kept_lines", ["CJ1"])
        with pytest.raises(ValueError, match="columns differ"):
            replace_batches(own.withColumn("more", own.account), "kept_lines", ["CJ1"])
        assert rows(spark.table("kept_lines"), "account", "LastUpdatedBy") == found
    finally:
        spark.sql("drop table kept_lines")


def test_equal_lines_have_ids_of_their_own(frames):
    final = frames.final(
        *[{"basis": "A", "AccountID": "A1", "FinalBalance": 5}] * 3,
        {"basis": "A", "AccountID": "A1", "F2": "", "FinalBalance": 5},
        {"basis": "A", "AccountID": "A1", "F2": "x", "FinalBalance": -5},
    )
    ids = [sorted(r.APTransDetailID for r in journals.generate_journals(final, AS_OF).details.collect()) for _ in range(2)]
    assert len(set(ids[0])) == len(ids[0]) == 6 and ids[0] == ids[1]
