"""Balancing journals generated from final balances, in up to three batches per period.

Every step is driven by ``JournalSpec`` rules and per-batch facts. The facts frame has at most one row per rule, which
is what makes it safe to broadcast to the line-level rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import AsOf, as_of_column, period_key
from tallyspark.operators.reconcile import HYBRID, MONEY
from tallyspark.operators.trial_balance import ACCRUAL, CASH

# The code of the line on the header's account, the suspense account, and the start of a batch tag.
PARENT_CODE = 20
SUSPENSE_ACCOUNT = "BQ101"
TAG_PREFIX = "CJ"

CREDIT = "credit"
DEBIT = "debit"


@dataclass(frozen=True)
class JournalSpec:
    """How one batch is made.

    ``first_side`` is the side whose greatest account becomes the parent if it has rows, else the other side's does.
    ``zero_side`` gets a zero line on the suspense account if it has no rows. With ``fixed_codes``, credit lines have
    the parent code and debit lines the base code; otherwise the side of the parent has the parent code and the other
    the base code. ``amount_sign`` is the sign of a first header amount taken from the debit side.
    """

    suffix: str
    basis: str
    journal_type: str | None
    base_code: int
    first_side: str
    zero_side: str
    fixed_codes: bool
    amount_sign: int


# The rules of the three batches.
SPECS = (
    JournalSpec("HYB", CASH, HYBRID, 5, CREDIT, DEBIT, True, -1),
    JournalSpec("A", ACCRUAL, None, 45, DEBIT, CREDIT, False, -1),
    JournalSpec("C", CASH, None, 46, DEBIT, CREDIT, False, 1),
)


@dataclass(frozen=True)
class Journals:
    headers: DataFrame
    details: DataFrame


def batch_tag(as_of: AsOf, suffix: Column | str, kind: str = "monthly") -> Column:
    end = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit(TAG_PREFIX), period_key(as_of, kind), end)


def _of_spec(attribute: str) -> Column:
    """The attribute of the row's rule, found by ``suffix``."""
    pairs = [(F.col("suffix") == s.suffix, F.lit(getattr(s, attribute))) for s in SPECS]
    first = F.when(*pairs[0])
    return reduce(lambda column, pair: column.when(*pair), pairs[1:], first)


def _suffix() -> Column:
    """Suffix of the batch a final balance belongs to; NULL if to none."""
    pairs = []
    for s in SPECS:
        kind = F.col("JournalType").isNull() if s.journal_type is None else F.col("JournalType") == s.journal_type
        pairs.append(((F.col("basis") == s.basis) & kind, F.lit(s.suffix)))
    return reduce(lambda column, pair: column.when(*pair), pairs[1:], F.when(*pairs[0]))


def journal_rows(final: DataFrame) -> DataFrame:
    """Final balances to be booked: non-zero, with the ``suffix`` of their batch and the trimmed account."""
    return (
        final.filter(F.col("FinalBalance") != 0)
        .select(
            _suffix().alias("suffix"),
            F.trim("AccountID").alias("account"),
            F.col("F2").alias("label"),
            F.col("FinalBalance").cast(MONEY).alias("amount"),
        )
        .filter(F.col("suffix").isNotNull())
    )


def journal_facts(rows: DataFrame) -> DataFrame:
    """Per batch: rows, amount and greatest account of each side, and the side the parent account is on."""
    credit = F.col("amount") < 0
    debit = F.col("amount") > 0
    first_rows = F.when(_of_spec("first_side") == CREDIT, F.col("credit_rows")).otherwise(F.col("debit_rows"))
    other_side = F.when(_of_spec("first_side") == CREDIT, F.lit(DEBIT)).otherwise(F.lit(CREDIT))
    return (
        rows.groupBy("suffix")
        .agg(
            F.count_if(credit).alias("credit_rows"),
            F.count_if(debit).alias("debit_rows"),
            F.coalesce(F.sum(F.when(credit, -F.col("amount"))), F.lit(0)).alias("credit_total"),
            F.coalesce(F.sum(F.when(debit, F.col("amount"))), F.lit(0)).alias("debit_total"),
            F.max(F.when(credit, F.col("account"))).alias("credit_account"),
            F.max(F.when(debit, F.col("account"))).alias("debit_account"),
        )
        .withColumn("parent_side", F.when(first_rows > 0, _of_spec("first_side")).otherwise(other_side))
        .withColumn(
            "ParentAccountID",
            F.when(F.col("parent_side") == CREDIT, F.col("credit_account")).otherwise(F.col("debit_account")),
        )
    )


def _stamp(as_of: AsOf, kind: str, updated: AsOf) -> dict[str, Column]:
    return {
        "TransactionDate": as_of_column(as_of),
        "CreatedOn": as_of_column(as_of),
        "LastUpdated": as_of_column(updated),
        "LastUpdatedBy": batch_tag(as_of, F.col("suffix"), kind),
    }


def _header_id(as_of: AsOf, kind: str) -> Column:
    return F.sha2(batch_tag(as_of, F.col("suffix"), kind), 256)


def _headers(facts: DataFrame, amount: Column, as_of: AsOf, kind: str, updated: AsOf) -> DataFrame:
    return facts.withColumns(_stamp(as_of, kind, updated)).select(
        _header_id(as_of, kind).alias("APTransactionID"),
        _of_spec("base_code").alias("TransactionType"),
        "TransactionDate",
        "CreatedOn",
        "LastUpdated",
        amount.cast(MONEY).alias("TransactionAmount"),
        "ParentAccountID",
        "LastUpdatedBy",
    )


def journal_headers(facts: DataFrame, as_of: AsOf, kind: str = "monthly", updated: AsOf = None) -> DataFrame:
    """One header per batch with any rows, with the amount it has before its lines are totalled."""
    amount = F.when(F.col("parent_side") == CREDIT, F.col("credit_total")).otherwise(
        F.col("debit_total") * _of_spec("amount_sign")
    )
    return _headers(facts, amount, as_of, kind, updated)


def _credit_code() -> Column:
    return F.when(_of_spec("fixed_codes") | (F.col("parent_side") == CREDIT), F.lit(PARENT_CODE)).otherwise(
        _of_spec("base_code")
    )


def _debit_code() -> Column:
    return F.when(_of_spec("fixed_codes") | (F.col("parent_side") == CREDIT), _of_spec("base_code")).otherwise(
        F.lit(PARENT_CODE)
    )


def _lines(rows: DataFrame, as_of: AsOf, kind: str, updated: AsOf, retype: bool) -> DataFrame:
    """Detail lines from rows of (suffix, parent_side, ParentAccountID, side, role, account, label, amount)."""
    is_credit = F.col("side") == CREDIT
    code = F.when(is_credit, _credit_code()).otherwise(_debit_code())
    if retype:
        code = F.when(F.col("ParentAccountID") != F.col("account"), _of_spec("base_code")).otherwise(code)
    # Lines alike in every part are numbered, so each has its own id and running again gives the same ids. JSON leaves
    # NULL parts out and quotes all others, so no two lists of parts read alike.
    parts = ["suffix", "role", "side", "account", "label", "amount"]
    ordinal = F.row_number().over(Window.partitionBy(*parts).orderBy(F.lit(0)))
    named = F.struct(batch_tag(as_of, F.col("suffix"), kind).alias("batch"), *parts[1:], "ordinal")
    return rows.withColumn("ordinal", ordinal).withColumns(_stamp(as_of, kind, updated)).select(
        F.sha2(F.to_json(named), 256).alias("APTransDetailID"),
        _header_id(as_of, kind).alias("ApTransactionID"),
        code.alias("TransactionType"),
        "TransactionDate",
        F.when(is_credit, F.col("account")).alias("CreditAccountID"),
        F.when(is_credit, F.col("amount")).alias("CreditAmount"),
        F.when(~is_credit, F.col("account")).alias("DebitAccountID"),
        F.when(~is_credit, F.col("amount")).alias("DebitAmount"),
        F.col("account").alias("ThisAccountID"),
        "CreatedOn",
        "LastUpdated",
        "LastUpdatedBy",
    )


def _booking_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    parents = facts.select("suffix", "parent_side", "ParentAccountID")
    side = F.when(F.col("amount") < 0, F.lit(CREDIT)).otherwise(F.lit(DEBIT))
    return rows.join(F.broadcast(parents), "suffix").withColumns(
        {"side": side, "role": F.lit("line"), "amount": F.abs("amount")}
    )


def _balancing_rows(facts: DataFrame) -> DataFrame:
    """The lines a batch needs beside its bookings, from its facts alone: a zero line, an adjustment, both or none."""
    zero_side = _of_spec("zero_side")
    empty = F.when(zero_side == CREDIT, F.col("credit_rows")).otherwise(F.col("debit_rows")) == 0
    difference = F.col("debit_total") - F.col("credit_total")
    zero = F.struct(zero_side.alias("side"), F.lit("zero").alias("role"), F.lit(0).cast(MONEY).alias("amount"))
    adjustment = F.struct(
        F.lit(CREDIT).alias("side"), F.lit("adjustment").alias("role"), difference.cast(MONEY).alias("amount")
    )
    needed = F.array_compact(F.array(F.when(empty, zero), F.when(difference != 0, adjustment)))
    return facts.select("suffix", "parent_side", "ParentAccountID", F.inline(needed)).withColumns(
        {"account": F.lit(SUSPENSE_ACCOUNT), "label": F.lit(None).cast("string")}
    )


def journal_lines(
    rows: DataFrame, facts: DataFrame, side: str, as_of: AsOf, kind: str = "monthly", updated: AsOf = None
) -> DataFrame:
    """Lines of one side: a credit line per negative final balance, or a debit line per positive one."""
    wanted = {CREDIT: F.col("amount") < 0, DEBIT: F.col("amount") > 0}[side]
    return _lines(_booking_rows(rows.filter(wanted), facts), as_of, kind, updated, retype=False)


def journal_zero_lines(facts: DataFrame, as_of: AsOf, kind: str = "monthly", updated: AsOf = None) -> DataFrame:
    """A zero line on the suspense account where the side that needs one is empty."""
    rows = _balancing_rows(facts).filter(F.col("role") == "zero")
    return _lines(rows, as_of, kind, updated, retype=False)


def journal_adjustment(facts: DataFrame, as_of: AsOf, kind: str = "monthly", updated: AsOf = None) -> DataFrame:
    """The credit on the suspense account, of either sign, that balances a batch; none if it balances already."""
    rows = _balancing_rows(facts).filter(F.col("role") == "adjustment")
    return _lines(rows, as_of, kind, updated, retype=False)


def with_header_amount(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers of generated batches with the total credit of their lines as amount."""
    totals = lines.groupBy("LastUpdatedBy").agg(F.sum("CreditAmount").alias("_credit"))
    return headers.join(totals, "LastUpdatedBy", "left").select(
        *[F.col("_credit").alias(c) if c == "TransactionAmount" else F.col(c) for c in headers.columns]
    )


def retype_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines that are not on their header's account take the header's own code."""
    parents = headers.select(
        F.col("APTransactionID").alias("ApTransactionID"), "ParentAccountID", F.col("TransactionType").alias("_base")
    )
    elsewhere = F.col("ParentAccountID") != F.col("ThisAccountID")
    code = F.when(elsewhere, F.col("_base")).otherwise(F.col("TransactionType"))
    return lines.join(parents, "ApTransactionID", "left").select(
        *[code.alias(c) if c == "TransactionType" else F.col(c) for c in lines.columns]
    )


def generate_journals(final: DataFrame, as_of: AsOf, kind: str = "monthly", updated: AsOf = None) -> Journals:
    """Finished headers and lines of all batches that have rows. ``updated`` defaults to now.

    The same as the single steps in turn, without reading the lines back: line codes are final at once, and a header
    amounts to the debit total, which is what the credit side comes to after its adjustment. ``final`` is read for the
    facts and for the lines, so hand over a stored frame.
    """
    rows = journal_rows(final)
    facts = journal_facts(rows)
    headers = _headers(facts, F.col("debit_total"), as_of, kind, updated)
    bookings = _lines(_booking_rows(rows, facts), as_of, kind, updated, retype=True)
    balancing = _lines(_balancing_rows(facts), as_of, kind, updated, retype=True)
    return Journals(headers, bookings.unionByName(balancing))


def replace_batch(existing: DataFrame, new: DataFrame, tags: Column | list[str]) -> DataFrame:
    """``existing`` without the rows of the tagged batches, followed by ``new``.

    The old rows go even if a batch comes out empty this time; rows without a tag stay. To store the result of a large
    ledger use ``sinks.replace_batches``, which leaves all other rows where they are.
    """
    old = F.col("LastUpdatedBy").isin(tags) if isinstance(tags, list) else F.array_contains(tags, F.col("LastUpdatedBy"))
    return existing.filter(~F.coalesce(old, F.lit(False))).unionByName(new, allowMissingColumns=True)


def batch_tags(as_of: AsOf, kind: str = "monthly") -> Column:
    """Tags of all batches of the period, as an array."""
    return F.array(*[batch_tag(as_of, s.suffix, kind) for s in SPECS])
