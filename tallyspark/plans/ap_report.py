"""The accounts-payable aging report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.ageing import BUCKETS
from tallyspark.functions.dates import AsOf
from tallyspark.operators import aging
from tallyspark.sources.tables import LedgerTables

REPORT_COLUMNS = [
    "VendorBillID",
    "APAccount",
    "AccountName",
    "PayeeID",
    "EmpFName",
    "EmpMI",
    "EmpLName",
    "EmpCompany",
    "IsSub",
    "BillDate",
    "BillDueDate",
    "BillNumber",
    "Billed",
    "Paid",
    "CreditUsed",
    "totalPaid",
    "Balance",
    *BUCKETS,
]


def ap_aging(
    tables: LedgerTables,
    as_of: AsOf = None,
    today: AsOf = None,
    on_multiple: str = "max",
    dedupe_checks: bool = False,
) -> DataFrame:
    """Open bills, open vendor credits and journal balances with names and age buckets, sorted by payee and bill.

    ``as_of`` bounds what is counted and ``today`` sets the ages; both default to the current moment. Credits and their
    uses are stored in the shared checkpoint folder when this is called, since two parts of the report read them.
    """
    positions = aging.bill_positions(
        tables.employees, tables.bills, tables.details, tables.txns, tables.checks, as_of, on_multiple, dedupe_checks
    )
    # Credits without a use name no bill and could match no row, so only drawn credit is grouped.
    state = aging.credit_state(tables.txns, tables.details, tables.credit_uses, as_of)
    credit = aging.credit_used_by_bill(*state)
    used = F.coalesce(F.col("_credit_used"), F.lit(0))
    bills = positions.join(credit, ["VendorBillID", "PayeeID"], "left").select(
        *positions.columns,
        used.alias("CreditUsed"),
        (F.col("Paid") + used).alias("totalPaid"),
        (F.col("Billed") - F.col("Paid") - used).alias("Balance"),
    )
    credits = aging.open_credit(*state, as_of)
    journals = aging.journal_balance(tables.txns, tables.details, tables.accounts, as_of)
    rows = bills.unionByName(credits).unionByName(journals).filter(F.col("Balance") != 0)

    people = tables.employees.select(
        F.col("EmployeeID").alias("PayeeID"), "EmpFName", "EmpMI", "EmpLName", "EmpCompany", "IsSub"
    )
    names = tables.accounts.select(F.col("AccountID").alias("APAccount"), "AccountName")
    return (
        rows.join(people, "PayeeID", "left")
        .join(names, "APAccount", "left")
        .transform(lambda df: aging.aging_buckets(df, today))
        .select(*[F.col(f"`{c}`") for c in REPORT_COLUMNS])
        .orderBy("PayeeID", "VendorBillID", "BillDate")
    )
