"""Comparison of the extract with trial balances rebuilt after the journals are booked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.joins import distinct_keys
from tallyspark.operators.reconcile import MONEY

KEYS = ["basis", "AccountID"]


def mismatch(extract: DataFrame, tb: DataFrame) -> DataFrame:
    """Accounts on both sides whose balances differ at four decimals; ``ledger_balance`` is the rebuilt one."""
    ours = tb.select(*KEYS, F.col("Balance").alias("ledger_balance"))
    return extract.join(ours, KEYS).filter(F.col("Balance").cast(MONEY) != F.col("ledger_balance").cast(MONEY))


def missing(left: DataFrame, right: DataFrame, trim: bool = False) -> DataFrame:
    """Rows of ``left`` with a non-zero balance whose account is not in ``right``; ``trim`` compares without outer spaces.

    The accounts of ``right`` are reduced to one row each first.
    """
    account = F.trim("AccountID") if trim else F.col("AccountID")
    rows = left.filter(F.col("AccountID").isNotNull() & (F.col("Balance") != 0)).withColumn("_account", account)
    listed = distinct_keys(right.withColumn("_account", account), "basis", "_account")
    return rows.join(listed, ["basis", "_account"], "left_anti").select(*left.columns)


def unbalanced(details: DataFrame) -> DataFrame:
    """Transactions whose debit minus credit is not 0, with the difference."""
    return (
        details.groupBy("ApTransactionID")
        .agg((F.sum("DebitAmount") - F.sum("CreditAmount")).alias("difference"))
        .filter(F.col("difference") != 0)
        .select("difference", "ApTransactionID")
    )
