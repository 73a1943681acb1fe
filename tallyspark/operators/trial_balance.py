"""Trial balances per account, on the accrual and the cash basis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import HISTORY_START, AsOf, as_of_column, period_key, year_start

# Account types that count from the start of the year, the transaction type kept out of the accrual
# basis, the account that takes the retained-earnings plug, and the names of the two bases.
PROFIT_AND_LOSS_TYPES = (8, 6, 15, 14, 3)
CASH_ONLY_TYPE = 46
PLUG_ACCOUNT = "3900"
ACCRUAL = "A"
CASH = "C"


def _debit() -> Column:
    return F.coalesce(F.col("DebitAmount"), F.lit(0))


def _credit() -> Column:
    return F.coalesce(F.col("CreditAmount"), F.lit(0))


def _trial_balance(
    accounts: DataFrame,
    types: DataFrame,
    entries: DataFrame,
    account: str,
    date: str,
    as_of: AsOf,
    amounts: dict[str, Column],
) -> DataFrame:
    """Sums per account from its own start date up to ``as_of``.

    Both possible start dates are known before any account is, so entries are first summed per account and side of each
    date, in one scan and mostly in its own stage. At most three rows per account ever meet the account list, so a busy
    account is no heavier than a quiet one.
    """
    start, history = year_start(as_of), F.lit(HISTORY_START)
    totals = (
        entries.filter(
            F.col(account).isNotNull()
            & (F.col(date) >= F.least(start, history))
            & (F.col(date) <= as_of_column(as_of))
        )
        .groupBy(
            F.col(account).alias("AccountID"),
            (F.col(date) >= start).alias("_this_year"),
            (F.col(date) >= history).alias("_in_history"),
        )
        .agg(*[F.sum(amount).alias(name) for name, amount in amounts.items()])
    )
    kinds = accounts.join(types.select("AccountTypeID"), "AccountTypeID").select(
        "AccountID", F.col("AccountTypeID").isin(*PROFIT_AND_LOSS_TYPES).alias("_pl")
    )
    return (
        totals.join(kinds, "AccountID")
        .filter(F.when(F.col("_pl"), F.col("_this_year")).otherwise(F.col("_in_history")))
        .groupBy("AccountID", "_pl")
        .agg(*[F.sum(name).alias(name) for name in amounts])
        .drop("_pl")
    )


def trial_balance_accrual(accounts: DataFrame, types: DataFrame, summary: DataFrame, as_of: AsOf) -> DataFrame:
    """Debit, credit and balance per account up to ``as_of``: profit-and-loss accounts from 1 January of that year,
    all others from 1970. Entries of the cash-only type, or of none, are left out, as are accounts of unknown type.

    An account listed under both kinds of type has a row for each.
    """
    entries = summary.filter(F.col("MasterTransactionType") != CASH_ONLY_TYPE)
    amounts = {"DebitAmount": _debit(), "CreditAmount": _credit()}
    sums = _trial_balance(accounts, types, entries, "ThisAccountID", "TransactionDate", as_of, amounts)
    return sums.withColumn("Balance", F.col("DebitAmount") - F.col("CreditAmount"))


def trial_balance_cash(accounts: DataFrame, types: DataFrame, cash: DataFrame, as_of: AsOf) -> DataFrame:
    """Balance per account on the cash basis, with the same date bounds and no type left out."""
    return _trial_balance(accounts, types, cash, "AccountID", "Date", as_of, {"Balance": _debit() - _credit()})


def with_plug(tb: DataFrame, account: str = PLUG_ACCOUNT) -> DataFrame:
    """The table with the plug account's balance set so that all balances sum to 0.

    The plug row is added if missing. Debit and credit of an existing one stay as they are. The total is a one-row
    aggregate of the table, and needs the same columns in both its uses, so that the table's own shuffle is shared.
    """
    is_plug = F.col("AccountID") == account
    facts = tb.agg(F.coalesce(F.sum("Balance"), F.lit(0)).alias("total"), F.count_if(is_plug).alias("present"))
    added = facts.filter(F.col("present") == 0).select(
        *[
            {"AccountID": F.lit(account), "Balance": -F.col("total")}.get(c, F.lit(0)).cast(tb.schema[c].dataType).alias(c)
            for c in tb.columns
        ]
    )
    total = facts.select("total").scalar()
    balance = F.when(is_plug, F.col("Balance") - total).otherwise(F.col("Balance"))
    return tb.withColumn("Balance", balance).unionByName(added)


def zero_check(tb: DataFrame, *by: str) -> DataFrame:
    """Total balance, expected to be 0; ``by`` gives one row per basis or period."""
    return tb.groupBy(*by).agg(F.sum("Balance").alias("TotalBalance"))


def in_period(tb: DataFrame, as_of: AsOf, basis: str, kind: str = "monthly") -> DataFrame:
    """The table with the ``period`` and ``basis`` that name its rebuildable partition."""
    return tb.withColumns({"period": period_key(as_of, kind), "basis": F.lit(basis)})
