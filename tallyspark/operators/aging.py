"""Accounts-payable aging: what is owed per bill, per vendor credit and per journal, by age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.ageing import CREDIT_ROW, JOURNAL_ROW, bucket_columns
from tallyspark.functions.dates import AsOf, as_of_column
from tallyspark.operators.joins import APART, apart, per_key
from tallyspark.sources.staging import staged

# Codes of detail lines and transaction headers, the account type of payables, and the party of journal
# lines that name none.
CREDIT_LINE = 20
PAYMENT_LINES = (4, -4)
DISCOUNT_LINE = 11
VENDOR_CREDIT_HEADER = 7
JOURNAL_HEADERS = (5, 0, 45)
PAYABLE_ACCOUNT_TYPE = 0
NO_PARTY = "ZZZZ"

BILL_COLUMNS = ["VendorBillID", "APAccountID", "VendorID", "BillDate", "BillDueDate", "BillNumber"]
BALANCE_COLUMNS = [
    "VendorBillID",
    "APAccount",
    "PayeeID",
    "BillDate",
    "BillDueDate",
    "BillNumber",
    "Billed",
    "Paid",
    "CreditUsed",
    "totalPaid",
    "Balance",
]


def _credit_lines(details: DataFrame) -> DataFrame:
    return details.filter(F.col("TransactionType") == CREDIT_LINE)


def _credit_lines_by_bill(details: DataFrame) -> DataFrame:
    """Per bill: credited amount, number of credit lines, and the greatest of their credit accounts."""
    return (
        _credit_lines(details)
        .filter(F.col("VendorBillID").isNotNull())
        .groupBy("VendorBillID")
        .agg(
            F.sum("CreditAmount").alias("_credited"),
            F.count(F.lit(1)).alias("_credit_lines"),
            F.max("CreditAccountID").alias("_line_account"),
        )
    )


def _ap_account(on_multiple: str) -> Column:
    own, fallback = F.col("APAccountID"), F.col("_line_account")
    if on_multiple == "error":
        message = F.concat(F.lit("more than one credit line for bill "), F.col("VendorBillID"))
        fallback = F.when(F.col("_credit_lines") > 1, F.raise_error(message)).otherwise(fallback)
    elif on_multiple != "max":
        raise ValueError(f"on_multiple must be max or error, not {on_multiple!r}")
    return F.when(own.isNull(), fallback).otherwise(own)


def ap_account(bills: DataFrame, details: DataFrame, on_multiple: str = "max") -> DataFrame:
    """Bills with ``APAccount``: their own payable account, else the credit account of their credit line.

    ``on_multiple`` says what a bill without an account and with several credit lines gets: the greatest account, or
    an ``error``.
    """
    lines = _credit_lines_by_bill(details)
    return bills.join(lines, "VendorBillID", "left").select(*bills.columns, _ap_account(on_multiple).alias("APAccount"))


def billed(bills: DataFrame, details: DataFrame, as_of: AsOf = None, on_multiple: str = "max") -> DataFrame:
    """Amount billed per bill dated up to ``as_of``, from its credit lines of any date.

    Credit lines are summed per bill before the join, so a bill with very many lines is one row when it moves.
    """
    dated = bills.filter(F.col("BillDate") <= as_of_column(as_of))
    lines = _credit_lines_by_bill(details)
    return (
        dated.join(lines, "VendorBillID")
        .groupBy(*BILL_COLUMNS, "_line_account", "_credit_lines")
        .agg(F.sum("_credited").alias("Billed"))
        .select(
            "VendorBillID",
            _ap_account(on_multiple).alias("APAccount"),
            F.col("VendorID").alias("PayeeID"),
            "BillDate",
            "BillDueDate",
            "BillNumber",
            "Billed",
            F.lit(0).cast("decimal(18,2)").alias("Paid"),
        )
    )


def _settled_by_bill(
    details: DataFrame, txns: DataFrame, checks: DataFrame, as_of: AsOf, kinds: tuple[str, ...], dedupe_checks: bool
) -> DataFrame:
    """Amount settled per bill, each line counted once per header and per dated check of its transaction."""
    line = F.col("TransactionType")
    payment = line.isin(*PAYMENT_LINES)
    discount = (line == DISCOUNT_LINE) & F.col("DebitAccountID").isNotNull()
    wanted = {"payment": payment, "discount": discount}
    keep = F.lit(False)
    for kind in kinds:
        keep = keep | wanted[kind]
    lines = details.filter(keep & (F.col("TransactionDate") <= as_of_column(as_of))).select(
        F.col("ApTransactionID").alias("APTransactionID"),
        "VendorBillID",
        F.when(payment, F.coalesce(F.col("DebitAmount"), F.lit(0))).otherwise(F.col("DebitAmount")).alias("_paid"),
    )

    counted = txns.select("APTransactionID", F.lit(1).alias("_header"), F.lit(0).alias("_check"))
    if not dedupe_checks:
        dated_checks = checks.filter(F.col("CheckDate") <= as_of_column(as_of))
        counted = counted.union(dated_checks.select("APTransactionID", F.lit(0), F.lit(1)))
    times = per_key(
        counted,
        ["APTransactionID"],
        F.sum("_header").alias("_headers"),
        (F.sum("_header") * F.greatest(F.sum("_check"), F.lit(1))).alias("_times"),
    ).filter(F.col("_headers") > 0)
    return (
        lines.join(times, "APTransactionID")
        .groupBy("VendorBillID")
        .agg(F.sum(F.col("_paid") * F.col("_times")).alias("_settled"))
    )


def settlements(
    employee: DataFrame,
    bills: DataFrame,
    details: DataFrame,
    txns: DataFrame,
    checks: DataFrame,
    as_of: AsOf = None,
    kinds: tuple[str, ...] = ("payment", "discount"),
    dedupe_checks: bool = False,
) -> DataFrame:
    """Settled amount per bill of a known vendor. See ``payments`` and ``discounts``."""
    settled = _settled_by_bill(details, txns, checks, as_of, kinds, dedupe_checks)
    vendors = employee.select(F.col("EmployeeID").alias("VendorID"))
    payees = bills.join(vendors, "VendorID").select("VendorBillID", "VendorID")
    return (
        payees.join(settled, "VendorBillID")
        .groupBy("VendorBillID")
        .agg(F.max("VendorID").alias("PayeeID"), F.sum("_settled").alias("Paid"))
    )


def payments(
    employee: DataFrame,
    bills: DataFrame,
    details: DataFrame,
    txns: DataFrame,
    checks: DataFrame,
    as_of: AsOf = None,
    dedupe_checks: bool = False,
) -> DataFrame:
    """Paid per bill: payment lines dated up to ``as_of`` whose transaction and vendor exist.

    A payment counts once for every check of its transaction dated up to ``as_of`` (once if there is none);
    ``dedupe_checks`` counts it once whatever the checks.
    """
    return settlements(employee, bills, details, txns, checks, as_of, ("payment",), dedupe_checks)


def discounts(
    employee: DataFrame,
    bills: DataFrame,
    details: DataFrame,
    txns: DataFrame,
    checks: DataFrame,
    as_of: AsOf = None,
    dedupe_checks: bool = False,
) -> DataFrame:
    """Discount taken per bill: as ``payments``, for discount lines that name a debit account.

    A bill whose discount lines all lack an amount has a NULL total.
    """
    return settlements(employee, bills, details, txns, checks, as_of, ("discount",), dedupe_checks)


def bill_balance(billed_rows: DataFrame, payment_rows: DataFrame, discount_rows: DataFrame) -> DataFrame:
    """The three sources merged into one row per bill."""
    return (
        billed_rows.unionByName(payment_rows, allowMissingColumns=True)
        .unionByName(discount_rows, allowMissingColumns=True)
        .groupBy("VendorBillID")
        .agg(
            *[F.max(c).alias(c) for c in ("APAccount", "PayeeID", "BillDate", "BillDueDate", "BillNumber")],
            F.sum(F.coalesce(F.col("Billed"), F.lit(0))).alias("Billed"),
            F.sum("Paid").alias("Paid"),
        )
    )


def bill_positions(
    employee: DataFrame,
    bills: DataFrame,
    details: DataFrame,
    txns: DataFrame,
    checks: DataFrame,
    as_of: AsOf = None,
    on_multiple: str = "max",
    dedupe_checks: bool = False,
) -> DataFrame:
    """Same rows as ``bill_balance`` over ``billed``, ``payments`` and ``discounts``, in one pass over the bills.

    Lines and settlements arrive already grouped by bill, so the bills move to them once and the final grouping needs
    no further shuffle; payments and discounts share one scan and one join to their transactions.
    """
    lines = _credit_lines_by_bill(details).withColumn("_has_lines", F.lit(True))
    settled = _settled_by_bill(details, txns, checks, as_of, ("payment", "discount"), dedupe_checks).withColumn(
        "_has_settled", F.lit(True)
    )
    vendors = per_key(
        employee.select(F.col("EmployeeID").alias("VendorID")), ["VendorID"], F.count(F.lit(1)).alias("_vendor_rows")
    )
    known = bills.select(*BILL_COLUMNS).join(vendors, "VendorID", "left")

    is_billed = F.coalesce(F.col("_has_lines"), F.lit(False)) & (F.col("BillDate") <= as_of_column(as_of))
    is_settled = F.coalesce(F.col("_has_settled"), F.lit(False)) & F.col("_vendor_rows").isNotNull()
    return (
        known.join(lines, "VendorBillID", "left")
        .join(settled, "VendorBillID", "left")
        .withColumns({"_billed": F.coalesce(is_billed, F.lit(False)), "_paying": is_settled})
        .filter(F.col("_billed") | F.col("_paying"))
        .groupBy("VendorBillID")
        .agg(
            F.max(F.when(F.col("_billed"), _ap_account(on_multiple))).alias("APAccount"),
            F.max("VendorID").alias("PayeeID"),
            *[F.max(F.when(F.col("_billed"), F.col(c))).alias(c) for c in ("BillDate", "BillDueDate", "BillNumber")],
            F.sum(F.coalesce(F.when(F.col("_billed"), F.col("_credited")), F.lit(0))).alias("Billed"),
            F.sum(
                F.when(F.col("_paying") & F.col("_settled").isNotNull(), F.col("_settled") * F.col("_vendor_rows"))
                .when(F.col("_billed"), F.lit(0))
            ).alias("Paid"),
        )
    )


def _credit_headers(txns: DataFrame) -> DataFrame:
    return txns.filter(F.col("TransactionType") == VENDOR_CREDIT_HEADER)


def _dated_credits(txns: DataFrame, details: DataFrame, as_of: AsOf) -> DataFrame:
    """Credits with the number, latest date and reference of their credit lines up to ``as_of``.

    A use of a credit is repeated once per line, so the number is all that is needed of them.
    """
    lines = _credit_lines(details).filter(F.col("TransactionDate") <= as_of_column(as_of))
    per_credit = (
        apart(lines.select(F.col("ApTransactionID").alias("APTransactionID"), "TransactionDate", "Ref"), "APTransactionID")
        .groupBy("APTransactionID", APART)
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.max("TransactionDate").alias("_line_date"),
            F.max("Ref").alias("_line_ref"),
        )
    )
    headers = _credit_headers(txns).select("APTransactionID", "PayeeID", "TransactionAmount")
    return apart(headers, "APTransactionID").join(per_credit, ["APTransactionID", APART]).drop(APART)


def _dated_uses(uses: DataFrame, as_of: AsOf) -> DataFrame:
    return uses.filter(F.col("TransactionDate") <= as_of_column(as_of)).select(
        F.col("BillCreditTransactionID").alias("APTransactionID"), "VendorBillID", "Amount"
    )


def applied_credit(txns: DataFrame, details: DataFrame, uses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The credit really drawn: one row per (credit, bill) with the number and amount of its uses and its credit.

    Uses are summed per (credit, bill) before the join, in which a credit drawn by very many bills can be split.
    """
    drawn = (
        _dated_uses(uses, as_of)
        .groupBy("APTransactionID", "VendorBillID")
        .agg(F.count(F.lit(1)).alias("_uses"), F.sum("Amount").alias("_drawn"))
    )
    return drawn.join(_dated_credits(txns, details, as_of), "APTransactionID")


def credit_used(txns: DataFrame, details: DataFrame, uses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Vendor credit drawn per (bill, payee), with the size and the rest of the credits behind it.

    A credit enters once per credit line dated up to ``as_of`` and per use dated up to ``as_of``; credits without a
    use form the group with a NULL bill.
    """
    joined = applied_credit(txns, details, uses, as_of)
    drawn_ids = _dated_uses(uses, as_of).select("APTransactionID").distinct()
    idle = (
        _dated_credits(txns, details, as_of)
        .join(drawn_ids, "APTransactionID", "left_anti")
        .withColumn("_uses", F.lit(1).cast("long"))
    )
    copies = F.col("_lines") * F.col("_uses")
    return (
        joined.unionByName(idle, allowMissingColumns=True)
        .groupBy("VendorBillID", "PayeeID")
        .agg(
            F.max("_line_date").alias("TransactionDate"),
            F.max("_line_ref").alias("Ref"),
            F.sum(F.col("TransactionAmount") * copies).alias("VendorCreditAmount"),
            F.sum(F.col("_drawn") * F.col("_lines")).alias("creditused"),
            F.lit("CreditBalance").alias("TYPE"),
            F.sum(
                F.col("TransactionAmount") * copies - F.coalesce(F.col("_drawn"), F.lit(0)) * F.col("_lines")
            ).alias("CreditBalance"),
        )
    )


def vendor_credit(txns: DataFrame, details: DataFrame, uses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Open vendor credit per (payee, parent account), negated, as rows of the report.

    Credits count if dated up to ``as_of``; uses dated up to ``as_of`` count whatever the date of their credit, once
    per credit line of any date. Both sides are one row per transaction when they meet.
    """
    lines = (
        _credit_lines(details)
        .filter(F.col("ApTransactionID").isNotNull())
        .groupBy(F.col("ApTransactionID").alias("APTransactionID"))
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    drawn = (
        _dated_uses(uses, as_of)
        .filter(F.col("APTransactionID").isNotNull())
        .groupBy("APTransactionID")
        .agg(F.sum(F.coalesce(F.col("Amount"), F.lit(0))).alias("_drawn"))
    )
    used = drawn.join(lines, "APTransactionID").select(
        "APTransactionID", (F.col("_drawn") * F.col("_lines")).alias("_used")
    )
    return _open_credit_rows(_credit_headers(txns).join(used, "APTransactionID", "left"), as_of)


def _open_credit_rows(credits: DataFrame, as_of: AsOf) -> DataFrame:
    """Credits with what is ``_used`` of them as balance rows."""
    dated = F.coalesce(F.col("TransactionDate") <= as_of_column(as_of), F.lit(False))
    return (
        credits.filter(dated | F.col("_used").isNotNull())
        .groupBy("PayeeID", "ParentAccountID")
        .agg(
            F.max(F.when(dated, F.col("TransactionDate"))).alias("BillDate"),
            F.sum(F.when(dated, F.coalesce(F.col("TransactionAmount"), F.lit(0)))).alias("_credit"),
            F.sum("_used").alias("_used"),
        )
        .select(
            F.col("ParentAccountID").alias("APAccount"),
            "PayeeID",
            "BillDate",
            F.lit(CREDIT_ROW).alias("BillNumber"),
            (F.coalesce(F.col("_used"), F.lit(0)) - F.coalesce(F.col("_credit"), F.lit(0))).alias("Balance"),
        )
        .transform(_as_balance_rows)
    )


def credit_state(txns: DataFrame, details: DataFrame, uses: DataFrame, as_of: AsOf = None) -> tuple[DataFrame, DataFrame]:
    """What a report needs of vendor credits, from one scan of the lines and one of the uses; both stored.

    First every credit with the number of its credit lines, of any date and up to ``as_of``; then the number and amount
    of the dated uses per (credit, bill).
    """
    on_time = F.coalesce(F.col("TransactionDate") <= as_of_column(as_of), F.lit(False))
    lines = _credit_lines(details).select(F.col("ApTransactionID").alias("APTransactionID"), on_time.alias("_on_time"))
    counts = per_key(
        lines, ["APTransactionID"], F.count(F.lit(1)).alias("_all_lines"), F.count_if("_on_time").alias("_lines")
    )
    own = ["APTransactionID", "PayeeID", "ParentAccountID", "TransactionDate", "TransactionAmount"]
    credits = _credit_headers(txns).select(*own).join(counts, "APTransactionID", "left")
    drawn = (
        _dated_uses(uses, as_of)
        .groupBy("APTransactionID", "VendorBillID")
        .agg(F.count(F.lit(1)).alias("_uses"), F.sum("Amount").alias("_drawn"))
    )
    return staged(credits, "vendor_credits"), staged(drawn, "drawn_credit")


def credit_used_by_bill(credits: DataFrame, drawn: DataFrame) -> DataFrame:
    """Vendor credit drawn per (bill, payee) from ``credit_state``, as ``_credit_used``."""
    dated = credits.filter(F.col("_lines") > 0).select("APTransactionID", "PayeeID", "_lines")
    return (
        drawn.join(dated, "APTransactionID")
        .groupBy("VendorBillID", "PayeeID")
        .agg(F.sum(F.col("_drawn") * F.col("_lines")).alias("_credit_used"))
    )


def open_credit(credits: DataFrame, drawn: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Same rows as ``vendor_credit`` from ``credit_state``."""
    per_credit = per_key(drawn, ["APTransactionID"], F.sum(F.coalesce("_drawn", F.lit(0))).alias("_sum"))
    used = F.when(F.col("_all_lines") > 0, F.col("_sum") * F.col("_all_lines"))
    return _open_credit_rows(credits.join(per_credit, "APTransactionID", "left").withColumn("_used", used), as_of)


def journal_balance(txns: DataFrame, details: DataFrame, accounts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Journal effect per (payable account, line party) from journals dated up to ``as_of``, as rows of the report."""
    payables = accounts.filter(F.col("AccountTypeID") == PAYABLE_ACCOUNT_TYPE).select(
        F.col("AccountID").alias("ThisAccountID")
    )
    journals = txns.filter(
        F.col("TransactionType").isin(*JOURNAL_HEADERS) & (F.col("TransactionDate") <= as_of_column(as_of))
    ).select("APTransactionID")
    lines = details.select(
        F.col("ApTransactionID").alias("APTransactionID"), "ThisAccountID", "AccountLineID", "CreditAmount", "DebitAmount"
    )
    return (
        lines.join(payables, "ThisAccountID", "left_semi")
        .join(journals, "APTransactionID")
        .groupBy(
            F.col("ThisAccountID").alias("APAccount"), F.coalesce(F.col("AccountLineID"), F.lit(NO_PARTY)).alias("PayeeID")
        )
        .agg(
            (
                F.sum(F.coalesce(F.col("CreditAmount"), F.lit(0))) - F.sum(F.coalesce(F.col("DebitAmount"), F.lit(0)))
            ).alias("Balance")
        )
        .withColumn("BillNumber", F.lit(JOURNAL_ROW))
        .transform(_as_balance_rows)
    )


def _as_balance_rows(df: DataFrame) -> DataFrame:
    """Fill the report columns that credit and journal rows do not have: NULL text and dates, zero amounts."""
    empty = {
        "VendorBillID": F.lit(None).cast("string"),
        "BillDate": F.lit(None).cast("date"),
        "BillDueDate": F.lit(None).cast("date"),
        **{c: F.lit(0).cast("decimal(18,2)") for c in ("Billed", "Paid", "CreditUsed", "totalPaid")},
    }
    return df.withColumns({c: v for c, v in empty.items() if c not in df.columns}).select(*BALANCE_COLUMNS)


def aging_buckets(df: DataFrame, today: AsOf = None) -> DataFrame:
    """Spread ``Balance`` over age buckets by days from bill date to ``today``; credit and journal rows get zeros."""
    return df.withColumns(bucket_columns(today))
