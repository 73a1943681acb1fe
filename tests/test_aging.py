from datetime import date

import pytest
from conftest import AS_OF, rows

from tallyspark.operators import aging
from tallyspark.plans.ap_report import ap_aging
from tallyspark.sources.tables import LedgerTables

OLD, LATE = date(2001, 1, 5), date(2001, 9, 1)


def bill(id="B1", vendor="V1", account="A1", day=OLD, number="N1"):
    return {"VendorBillID": id, "VendorID": vendor, "APAccountID": account, "BillDate": day, "BillNumber": number}


def credit_line(bill="B1", amount=100, account="A1", txn="T1", day=OLD):
    return {
        "VendorBillID": bill,
        "ApTransactionID": txn,
        "TransactionType": 20,
        "TransactionDate": day,
        "CreditAccountID": account,
        "CreditAmount": amount,
    }


def payment(bill="B1", amount=40, kind=4, txn="T1", day=OLD, account="A1"):
    return {
        "VendorBillID": bill,
        "ApTransactionID": txn,
        "TransactionType": kind,
        "TransactionDate": day,
        "DebitAccountID": account,
        "DebitAmount": amount,
    }


def header(id="T1", kind=4, amount=0, payee="V1", parent="A1", day=OLD):
    return {
        "APTransactionID": id,
        "TransactionType": kind,
        "TransactionAmount": amount,
        "PayeeID": payee,
        "ParentAccountID": parent,
        "TransactionDate": day,
    }


def check(txn="T1", day=OLD):
    return {"APTransactionID": txn, "CheckDate": day}


def use(credit="T1", bill="B1", amount=10, day=OLD):
    return {"BillCreditTransactionID": credit, "VendorBillID": bill, "Amount": amount, "TransactionDate": day}


V1 = {"EmployeeID": "V1"}


def test_billed_sums_lines_of_any_date_for_bills_up_to_the_date(frames):
    bills = frames.bills(bill(), bill("B2", day=LATE), bill("B3", day=AS_OF))
    details = frames.details(credit_line(), credit_line(amount=5, day=LATE), credit_line("B2"), credit_line("B3", 7))
    assert rows(aging.billed(bills, details, AS_OF), "VendorBillID", "Billed") == [("B1", 105.0), ("B3", 7.0)]


def test_account_falls_back_to_the_credit_line(frames):
    bills = frames.bills(bill(account=None), bill("B2"), bill("B3", account=None))
    details = frames.details(credit_line(account="A7"), credit_line(account="A8"), credit_line("B2", account="A9"))
    result = aging.ap_account(bills, details)
    assert rows(result, "VendorBillID", "APAccount") == [("B1", "A8"), ("B2", "A1"), ("B3", None)]
    with pytest.raises(Exception, match="more than one credit line for bill B1"):
        aging.ap_account(bills, details, on_multiple="error").collect()
    fine = frames.bills(bill("B2", account=None))
    assert rows(aging.ap_account(fine, details.filter("VendorBillID = 'B2'"), "error"), "APAccount") == [("A9",)]
    # Only a bill that has to fall back may fail.
    assert rows(aging.ap_account(frames.bills(bill()), details, "error"), "APAccount") == [("A1",)]


@pytest.mark.parametrize("checks, paid", [(0, 40.0), (1, 40.0), (2, 80.0)])
def test_payment_counts_once_per_dated_check(frames, checks, paid):
    args = (
        frames.employees(V1),
        frames.bills(bill()),
        frames.details(payment()),
        frames.txns(header()),
        frames.checks(*[check()] * checks, check(day=LATE)),
    )
    assert rows(aging.payments(*args, AS_OF), "Paid") == [(paid,)]
    assert rows(aging.payments(*args, AS_OF, dedupe_checks=True), "Paid") == [(40.0,)]


def test_payments_need_vendor_bill_and_header(frames):
    bills = frames.bills(bill(), bill("B2", vendor="V2"))
    details = frames.details(
        payment(kind=-4),
        payment(amount=None),
        payment(amount=3, txn="T9"),
        payment("B2"),
        payment("B3"),
        payment(amount=9, day=LATE),
    )
    result = aging.payments(frames.employees(V1), bills, details, frames.txns(header()), frames.checks(), AS_OF)
    assert rows(result, "VendorBillID", "PayeeID", "Paid") == [("B1", "V1", 40.0)]


def test_discounts_need_a_debit_account(frames):
    bills = frames.bills(bill(), bill("B2"))
    details = frames.details(
        payment(kind=11), payment(kind=11, account=None, amount=5), payment("B2", kind=11, amount=None)
    )
    result = aging.discounts(frames.employees(V1), bills, details, frames.txns(header()), frames.checks(), AS_OF)
    assert rows(result, "VendorBillID", "Paid") == [("B1", 40.0), ("B2", None)]


def test_positions_equal_the_merged_sources(frames):
    bills = frames.bills(
        bill(), bill("B2", day=LATE), bill("B3", vendor="V2"), bill("B4", account=None), bill("B5"), bill("B6", day=None)
    )
    details = frames.details(
        credit_line(),
        payment(),
        payment(kind=11, amount=2),
        payment("B2", amount=5),
        credit_line("B3"),
        payment("B3"),
        credit_line("B4", account="A5", amount=None),
        payment("B5", kind=11, amount=None),
        credit_line("B6"),
        payment("B6", amount=1),
    )
    # The vendor is listed twice, which doubles what was settled but not what was billed.
    args = (frames.employees(V1, V1), bills, details, frames.txns(header()), frames.checks(check(), check()))
    merged = aging.bill_balance(
        aging.billed(bills, details, AS_OF), aging.payments(*args, AS_OF), aging.discounts(*args, AS_OF)
    )
    positions = aging.bill_positions(*args, AS_OF)
    assert rows(positions, *merged.columns) == rows(merged)
    assert ("B1", "A1", "V1", OLD, None, "N1", 100.0, 168.0) in rows(positions)
    assert ("B2", None, "V1", None, None, None, 0.0, 20.0) in rows(positions)
    assert ("B5", None, "V1", None, None, None, 0.0, None) in rows(positions)


def test_credit_use_is_repeated_per_dated_credit_line(frames):
    txns = frames.txns(header(kind=7, amount=50), header("T2", kind=7, amount=8), header("T3", kind=5))
    details = frames.details(credit_line(), credit_line(), credit_line(day=LATE), credit_line(txn="T2"))
    uses = frames.uses(use(), use(amount=None), use(day=LATE), use("T3"))
    result = aging.credit_used(txns, details, uses, AS_OF)
    columns = ("VendorBillID", "PayeeID", "VendorCreditAmount", "creditused", "CreditBalance")
    assert rows(result, *columns) == [("B1", "V1", 200.0, 20.0, 180.0), (None, "V1", 8.0, None, 8.0)]


def test_vendor_credit_dates_differ_by_source(frames):
    txns = frames.txns(header(kind=7, amount=50), header("T2", kind=7, amount=30, day=LATE), header("T3", kind=7, day=LATE))
    details = frames.details(credit_line(), credit_line(day=LATE), credit_line(txn="T2"))
    uses = frames.uses(use(), use("T2", amount=1), use("T3", amount=99), use(day=LATE))
    result = aging.vendor_credit(txns, details, uses, AS_OF)
    assert rows(result, "PayeeID", "APAccount", "BillDate", "BillNumber", "Balance") == [
        ("V1", "A1", OLD, "Vendor Credit", -29.0)
    ]


def test_journal_balance_of_payable_accounts(frames):
    txns = frames.txns(header("T1", 5), header("T2", 46), header("T3", 45, day=LATE), header("T4", 0))
    accounts = frames.accounts({"AccountID": "A1", "AccountTypeID": 0}, {"AccountID": "A2", "AccountTypeID": 1})

    def line(txn, account="A1", party=None, debit=None, credit=None):
        return {
            "ApTransactionID": txn,
            "ThisAccountID": account,
            "AccountLineID": party,
            "DebitAmount": debit,
            "CreditAmount": credit,
        }

    details = frames.details(
        line("T1", credit=9), line("T4", debit=2), line("T1", party="V1", debit=4), line("T1", "A2", credit=5),
        line("T2", credit=7), line("T3", credit=7), line("T1", None, credit=7),
    )
    result = aging.journal_balance(txns, details, accounts, AS_OF)
    assert rows(result, "APAccount", "PayeeID", "Balance") == [("A1", "V1", -4.0), ("A1", "ZZZZ", 7.0)]


def test_buckets(spark):
    today = date(2001, 7, 15)
    data = [
        (date(2001, 7, 20), "N", 1), (date(2001, 6, 15), "N", 2), (date(2001, 6, 14), "N", 3), (date(2001, 5, 16), "N", 4),
        (date(2001, 5, 15), "N", 5), (date(2001, 4, 16), "N", 6), (date(2001, 4, 15), "N", 7),
        (date(2001, 6, 15), None, 8), (None, "N", 9), (date(2001, 6, 15), "Vendor Credit", 10),
        (None, "GeneralJournalBalance", 11),
    ]
    df = spark.createDataFrame(data, "BillDate date, BillNumber string, Balance int")
    found = {r["Balance"]: [c for c in ("current", "31-60", "61-90", ">90") if r[c]] for r in aging.aging_buckets(df, today).collect()}
    assert found == {
        1: ["current"], 2: ["current"], 3: ["31-60"], 4: ["31-60"], 5: ["61-90"], 6: ["61-90"], 7: [">90"],
        8: [], 9: [], 10: [], 11: [],
    }


def test_report_order_filter_and_names(frames):
    parts = {
        "vendor_bill": frames.bills(bill("B2"), bill("B1"), bill("B3", vendor="V0"), bill("B4")),
        "ap_transaction_details": frames.details(
            credit_line("B2"), credit_line("B1"), credit_line("B3"), credit_line("B4", amount=40), payment("B4"),
            credit_line(txn="T7", bill=None), payment(bill="B9", txn="T8"),
        ),
        "ap_transaction_table": frames.txns(header(), header("T7", 7, 60, parent=None)),
        "check_details": frames.checks(),
        "ap_credit_used": frames.uses(use("T7", "B1", 15), use("T7", "B3", 5)),
        "employee": frames.employees({"EmployeeID": "V1", "EmpLName": "One"}),
        "account_list": frames.accounts({"AccountID": "A1", "AccountName": "Payables", "AccountTypeID": 0}),
    }
    report = ap_aging(LedgerTables(parts.__getitem__), AS_OF, date(2001, 7, 15))
    found = [
        (r.PayeeID, r.VendorBillID, r.EmpLName, r.AccountName, float(r.CreditUsed), float(r.Balance), float(r[">90"]))
        for r in report.collect()
    ]
    # V0 is not the payee of the credit, so its bill is not reduced; the paid-off bill is gone.
    assert found == [
        ("V0", "B3", None, "Payables", 0.0, 100.0, 100.0),
        ("V1", None, "One", None, 0.0, -40.0, 0.0),
        ("V1", "B1", "One", "Payables", 15.0, 85.0, 85.0),
        ("V1", "B2", "One", "Payables", 0.0, 100.0, 100.0),
    ]
