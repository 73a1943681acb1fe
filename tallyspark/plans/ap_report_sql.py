"""The accounts-payable aging report for SQL users: a table function with the dates as its parameters."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyspark.functions.ageing import BUCKETS, CREDIT_ROW, JOURNAL_ROW
from tallyspark.operators import aging
from tallyspark.plans.ap_report import REPORT_COLUMNS
from tallyspark.sources.tables import TABLE_NAMES, LedgerTables

_MONEY = "DECIMAL(38,2)"
_PARTS = ("bills", "txns", "details", "checks", "credit_uses", "employees", "accounts")
_TYPES = {"BillDate": "DATE", "BillDueDate": "DATE", "IsSub": "BOOLEAN"} | dict.fromkeys(
    ["Billed", "Paid", "CreditUsed", "totalPaid", "Balance", *BUCKETS], _MONEY
)


def _list(values: tuple[int, ...]) -> str:
    return ", ".join(map(str, values))


def _bucket(low: int | None, high: int | None) -> str:
    bounds = [f"age >= {low}"] * (low is not None) + [f"age <= {high}"] * (high is not None)
    return f"CASE WHEN BillNumber NOT IN ('{CREDIT_ROW}', '{JOURNAL_ROW}') AND {' AND '.join(bounds)} THEN Balance ELSE 0 END"


def _statement(name: str, view: dict[str, str]) -> str:
    """Sides are summed before they are joined, as in the report's frames. A date can't stand inside an aggregate."""
    payment = f"TransactionType IN ({_list(aging.PAYMENT_LINES)})"
    nothing = f"CAST(0 AS {_MONEY})"
    shown = {"BillDate": "BillDate", "BillDueDate": "BillDueDate", **{b: _bucket(*bounds) for b, bounds in BUCKETS.items()}}
    columns = ",\n    ".join(f"CAST({shown.get(c, f'r.{c}' if c in ('PayeeID', 'APAccount') else c)} AS {_TYPES.get(c, 'STRING')})" for c in REPORT_COLUMNS)
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of DATE DEFAULT current_date(), today DATE DEFAULT current_date())
RETURNS TABLE ({", ".join(f"`{c}` {_TYPES.get(c, 'STRING')}" for c in REPORT_COLUMNS)})
RETURN
WITH bill_lines AS (
    SELECT VendorBillID, sum(CreditAmount) AS credited, max(CreditAccountID) AS line_account
    FROM {view["details"]} WHERE TransactionType = {aging.CREDIT_LINE} GROUP BY VendorBillID
), times AS (
    SELECT APTransactionID, sum(header) * greatest(sum(dated_check), 1) AS n FROM (
        SELECT APTransactionID, 1 AS header, 0 AS dated_check FROM {view["txns"]}
        UNION ALL SELECT APTransactionID, 0, 1 FROM {view["checks"]} WHERE CheckDate <= {name}.as_of
    ) GROUP BY APTransactionID HAVING sum(header) > 0
), settled AS (
    SELECT VendorBillID, sum(paid * n) AS settled FROM (
        SELECT VendorBillID, ApTransactionID, CASE WHEN {payment} THEN coalesce(DebitAmount, 0) ELSE DebitAmount END AS paid
        FROM {view["details"]}
        WHERE TransactionDate <= {name}.as_of
            AND ({payment} OR TransactionType = {aging.DISCOUNT_LINE} AND DebitAccountID IS NOT NULL)
    ) JOIN times USING (APTransactionID) GROUP BY VendorBillID
), vendors AS (
    SELECT EmployeeID AS VendorID, count(*) AS vendor_rows FROM {view["employees"]} GROUP BY EmployeeID
), positions AS (
    SELECT VendorBillID, max(CASE WHEN billed THEN coalesce(APAccountID, line_account) END) AS APAccount,
        max(VendorID) AS PayeeID, max(CASE WHEN billed THEN BillDate END) AS BillDate,
        max(CASE WHEN billed THEN BillDueDate END) AS BillDueDate, max(CASE WHEN billed THEN BillNumber END) AS BillNumber,
        sum(coalesce(CASE WHEN billed THEN credited END, 0)) AS Billed,
        sum(CASE WHEN paying AND settled IS NOT NULL THEN settled * vendor_rows WHEN billed THEN 0 END) AS Paid
    FROM (
        SELECT b.VendorBillID, b.VendorID, b.APAccountID, b.BillDate, b.BillDueDate, b.BillNumber, l.line_account, l.credited,
            s.settled, v.vendor_rows, l.VendorBillID IS NOT NULL AND coalesce(b.BillDate <= {name}.as_of, false) AS billed,
            s.VendorBillID IS NOT NULL AND v.VendorID IS NOT NULL AS paying
        FROM {view["bills"]} b LEFT JOIN vendors v ON v.VendorID = b.VendorID
        LEFT JOIN bill_lines l ON l.VendorBillID = b.VendorBillID LEFT JOIN settled s ON s.VendorBillID = b.VendorBillID
    ) WHERE billed OR paying GROUP BY VendorBillID
), credit_lines AS (
    SELECT APTransactionID, count(*) AS all_lines, count_if(dated) AS dated_lines FROM (
        SELECT ApTransactionID AS APTransactionID, TransactionDate <= {name}.as_of AS dated
        FROM {view["details"]} WHERE TransactionType = {aging.CREDIT_LINE}
    ) GROUP BY APTransactionID
), drawn AS (
    SELECT BillCreditTransactionID AS APTransactionID, VendorBillID, sum(Amount) AS amount
    FROM {view["credit_uses"]} WHERE TransactionDate <= {name}.as_of GROUP BY BillCreditTransactionID, VendorBillID
), credits AS (
    SELECT t.APTransactionID, t.PayeeID, t.ParentAccountID, t.TransactionDate, t.TransactionAmount, l.all_lines, l.dated_lines,
        t.TransactionDate <= {name}.as_of AS dated
    FROM {view["txns"]} t LEFT JOIN credit_lines l ON l.APTransactionID = t.APTransactionID
    WHERE t.TransactionType = {aging.VENDOR_CREDIT_HEADER}
), used_by_bill AS (
    SELECT d.VendorBillID, c.PayeeID, sum(d.amount * c.dated_lines) AS credit_used
    FROM drawn d JOIN credits c ON c.APTransactionID = d.APTransactionID WHERE c.dated_lines > 0
    GROUP BY d.VendorBillID, c.PayeeID
), used_of_credit AS (
    SELECT APTransactionID, sum(coalesce(amount, 0)) AS amount FROM drawn GROUP BY APTransactionID
), credit_rows AS (
    SELECT c.ParentAccountID AS APAccount, c.PayeeID, max(CASE WHEN c.dated THEN c.TransactionDate END) AS BillDate,
        coalesce(sum(u.amount * c.all_lines), 0) - coalesce(sum(CASE WHEN c.dated THEN c.TransactionAmount END), 0) AS Balance
    FROM credits c LEFT JOIN used_of_credit u ON u.APTransactionID = c.APTransactionID AND c.all_lines > 0
    WHERE c.dated OR u.amount IS NOT NULL GROUP BY c.PayeeID, c.ParentAccountID
), journal_rows AS (
    SELECT d.ThisAccountID AS APAccount, coalesce(d.AccountLineID, '{aging.NO_PARTY}') AS PayeeID,
        sum(coalesce(d.CreditAmount, 0)) - sum(coalesce(d.DebitAmount, 0)) AS Balance
    FROM {view["details"]} d JOIN {view["txns"]} t ON t.APTransactionID = d.ApTransactionID
    LEFT SEMI JOIN {view["accounts"]} a ON a.AccountID = d.ThisAccountID AND a.AccountTypeID = {aging.PAYABLE_ACCOUNT_TYPE}
    WHERE t.TransactionType IN ({_list(aging.JOURNAL_HEADERS)}) AND t.TransactionDate <= {name}.as_of
    GROUP BY d.ThisAccountID, coalesce(d.AccountLineID, '{aging.NO_PARTY}')
), report AS (
    SELECT p.*, coalesce(u.credit_used, 0) AS CreditUsed, p.Paid + coalesce(u.credit_used, 0) AS totalPaid,
        p.Billed - p.Paid - coalesce(u.credit_used, 0) AS Balance
    FROM positions p LEFT JOIN used_by_bill u ON u.VendorBillID = p.VendorBillID AND u.PayeeID = p.PayeeID
    UNION ALL
    SELECT NULL, APAccount, PayeeID, BillDate, NULL, '{CREDIT_ROW}', {nothing}, {nothing}, {nothing}, {nothing}, Balance FROM credit_rows
    UNION ALL
    SELECT NULL, APAccount, PayeeID, NULL, NULL, '{JOURNAL_ROW}', {nothing}, {nothing}, {nothing}, {nothing}, Balance FROM journal_rows
), aged AS (
    SELECT *, datediff({name}.today, BillDate) AS age FROM report WHERE Balance <> 0
)
SELECT {columns}
FROM aged r LEFT JOIN {view["employees"]} e ON e.EmployeeID = r.PayeeID LEFT JOIN {view["accounts"]} a ON a.AccountID = r.APAccount"""


def create_ap_aging(spark: SparkSession, tables: LedgerTables, name: str = "ap_aging") -> None:
    """Makes ``select * from ap_aging(as_of, today)`` work in this session, both dates being today if left out.

    The ledger's tables become temporary views named by the function and the table. Rows and columns are those of
    ``ap_report.ap_aging`` with its default options, in no order; amounts have two decimals. The dates reach the scans as
    filters.
    """
    views = {part: f"{name}_{TABLE_NAMES[part]}" for part in _PARTS}
    for part, view in views.items():
        getattr(tables, part).createOrReplaceTempView(view)
    spark.sql(_statement(name, views))
