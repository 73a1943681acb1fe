import pytest
from conftest import rows

from tallyspark.functions.labels import clean_label, collate_keys, signed_balance
from tallyspark.operators import aging, recheck
from tallyspark.operators import reconcile as rc


def test_clean_label(spark):
    labels = ["10 · Cash ", "Cash", "1 · a · b", "  Cash  ", "·", "", None, "4·x"]
    df = spark.createDataFrame([(s,) for s in labels], "F2 string").select("F2", clean_label("F2").alias("label"))
    assert [r.label for r in df.collect()] == ["Cash", "Cash", "a · b", "Cash", "", "", None, "x"]


def test_signed_balance(spark):
    data = [(5, 0), (0, 3), (None, 3), (4, 9), (0, 0), (None, None), (-2, 1)]
    df = spark.createDataFrame(data, "Debit int, Credit int").select(signed_balance().alias("b"))
    assert [r.b for r in df.collect()] == [5, -3, -3, 4, 0, 0, -2]


def test_ensure_columns_adds_and_resets(spark):
    df = spark.createDataFrame([(1, "x")], "id int, AccountID string")
    fresh = rc.ensure_columns(df, {"accountid": "string", "qblinkid": "string"})
    assert fresh.columns == ["id", "AccountID", "qblinkid"]
    assert rows(rc.ensure_columns(fresh, {"Balance": "decimal(19,4)"}, 0)) == [(1, None, None, 0.0)]


def test_map_accounts_takes_the_least_of_several(frames):
    extract = frames.extract(*[{"basis": "A", "F2": f} for f in ("1 · Cash", "Bank", "2 · Odd", "3 · Lost", None)])
    qb = frames.qb(
        {"ListID": "Q2", "FullName": "Cash"}, {"ListID": "Q1", "FullName": "Cash"},
        {"ListID": "Q3", "FullName": "Bank"}, {"ListID": "Q9", "FullName": "Odd"}, {"ListID": "Q8", "FullName": None},
    )
    accounts = frames.accounts(
        {"AccountID": "A5", "QBLinkID": "Q1"}, {"AccountID": "A4", "QBLinkID": "Q1"},
        {"AccountID": "A3", "QBLinkID": "Q3"}, {"AccountID": "A0", "QBLinkID": None},
    )
    mapped = rc.map_accounts(extract, qb, accounts)
    assert rows(mapped, "F2", "qblinkid", "AccountID") == [
        ("1 · Cash", "Q1", "A4"), ("2 · Odd", "Q9", None), ("3 · Lost", None, None), ("Bank", "Q3", "A3"),
        (None, None, None),
    ]
    again = rc.map_accounts(mapped, qb, accounts)
    assert again.columns == mapped.columns and rows(again) == rows(mapped)
    assert rows(rc.unmapped(mapped), "F2") == [("2 · Odd",), ("3 · Lost",), (None,)]


def mapped(label, account, balance, basis="A"):
    return {"basis": basis, "F2": label, "AccountID": account, "Balance": balance}


def test_final_balance(frames):
    extract = frames.mapped(
        mapped("both", "A1", 10), mapped("only extract", "A2", 7), mapped("no account", None, 5), mapped(None, "A4", 3),
        mapped("twice", "A6", 1), mapped("twice again", "A6", 2), mapped("other basis", "A1", 10, "C"),
    )
    tb = frames.tb(
        {"basis": "A", "AccountID": "A1", "Balance": 4}, {"basis": "A", "AccountID": "A3", "Balance": 8},
        {"basis": "A", "AccountID": "A4", "Balance": 9}, {"basis": "A", "AccountID": "A5", "Balance": 0},
        {"basis": "A", "AccountID": "A6", "Balance": 1}, {"basis": "C", "AccountID": "A1", "Balance": 1},
        {"basis": "A", "AccountID": None, "Balance": 1},
    )
    final = rc.final_balance(extract, tb)
    assert rows(final, "basis", "F2", "AccountID", "Balance", "FinalBalance") == [
        ("A", "both", "A1", 10.0, 6.0),
        ("A", "no account", None, 5.0, 0.0),
        ("A", "only extract", "A2", 7.0, 7.0),
        # Each row of a repeated account is charged the whole ledger balance.
        ("A", "twice again", "A6", 2.0, 1.0),
        ("A", "twice", "A6", 1.0, 0.0),
        # The unlabelled row of A4 went first, so A4 is only in the ledger.
        ("A", None, "A3", None, -8.0),
        ("A", None, "A4", None, -9.0),
        ("C", "other basis", "A1", 10.0, 9.0),
    ]
    # Added rows have no label, so the next run starts without them.
    assert rc.drop_blank_rows(final).count() == 6


def test_duplicates_report_null(frames):
    extract = frames.mapped(*[mapped("x", a, 1) for a in ("A1", "A1", "A2", None, None)])
    assert rows(rc.duplicates(extract, "AccountID")) == [("A1", 2), (None, 2)]


def test_hybrid_needs_both_bases_and_a_balance(frames):
    def row(basis, account, balance):
        return {"basis": basis, "AccountID": account, "FinalBalance": balance}

    final = frames.final(
        row("A", "A1", 5), row("C", "A1", 5), row("A", "A2", 0), row("C", "A2", 0), row("A", "A3", 1), row("C", "A3", 2),
        row("A", "A4", 3), row("A", "A4", 3), row("A", None, 4), row("C", None, 4),
    )
    flagged = rc.hybrid_flag(final)
    assert flagged.count() == 10
    assert rows(flagged.filter("JournalType = 'Hybrid'"), "basis", "AccountID") == [("A", "A1"), ("C", "A1")]


def test_suspect_links(frames):
    df = frames.mapped({"qblinkid": "A1", "AccountID": "A1"}, {"qblinkid": "Q", "AccountID": "A2"}, {"AccountID": "A3"})
    assert rows(rc.suspect_links(df), "AccountID") == [("A1",)]


def test_control_totals(frames):
    df = frames.extract({"basis": "A", "Debit": 1}, {"basis": "A", "Debit": 2, "Credit": 5}, {"basis": "C"})
    assert rows(rc.control_totals(df, "basis")) == [("A", 3.0, 5.0), ("C", None, None)]


def test_mismatch_compares_four_decimals(frames):
    extract = frames.mapped(mapped("a", "A1", 1), mapped("b", "A2", 2), mapped("c", None, 3))
    tb = frames.spark.sql(
        "select 'A' basis, 'A1' AccountID, 1.00001 Balance union all select 'A', 'A2', 2.0001 union all select 'A', null, 1"
    )
    assert rows(recheck.mismatch(extract, tb), "AccountID") == [("A2",)]


def test_missing_either_way(frames):
    extract = frames.mapped(
        mapped("a", " A1 ", 1), mapped("b", "A2", 2), mapped("c", "A3", 0), mapped(None, "A4", None), mapped("d", None, 5)
    )
    tb = frames.tb(*[{"basis": "A", "AccountID": a, "Balance": 1} for a in ("A1", "A4", "A5", None)])
    assert rows(recheck.missing(extract, tb, trim=True), "AccountID") == [("A2",)]
    assert rows(recheck.missing(tb, extract), "AccountID") == [("A1",), ("A5",)]


@pytest.mark.parametrize("collated", [False, True])
def test_collation_of_keys(frames, collated):
    bills = frames.bills({"VendorBillID": "b1 "}, {"VendorBillID": "B2"})
    details = frames.details(
        *[{"VendorBillID": b, "TransactionType": 20, "CreditAccountID": "A1"} for b in ("B1", "b1", "B2")]
    )
    extract = frames.mapped(mapped("x", "a1 ", 5), mapped("y", "A1", 7))
    tb = frames.tb({"basis": "A", "AccountID": "A1", "Balance": 1}, {"basis": "A", "AccountID": "a1", "Balance": 2})
    if collated:
        bills, details = (collate_keys(df, ["VendorBillID"]) for df in (bills, details))
        extract, tb = (collate_keys(df, ["AccountID"]) for df in (extract, tb))
    accounts = {r.VendorBillID: r.APAccount for r in aging.ap_account(bills, details).collect()}
    assert accounts == {"b1 ": "A1" if collated else None, "B2": "A1"}
    final = rc.final_balance(extract, tb)
    expected = [("x", 4.0), ("y", 6.0)] if collated else [("x", 5.0), ("y", 6.0), (None, -2.0)]
    assert rows(final, "F2", "FinalBalance") == expected
