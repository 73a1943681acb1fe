"""Mapping an extracted trial balance to ledger accounts and finding the differences.

An extract has a label column ``F2`` and ``Debit`` and ``Credit``. Both bases are handled in one frame with a
``basis`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.labels import clean_label, signed_balance
from tallyspark.operators.joins import per_key
from tallyspark.operators.trial_balance import ACCRUAL, CASH

HYBRID = "Hybrid"
MONEY = "decimal(19,4)"
LABEL = "F2"


def ensure_columns(df: DataFrame, columns: dict[str, str], value: object = None) -> DataFrame:
    """Columns of the given types, added where absent (whatever their case) and reset to ``value``."""
    present = {c.lower(): c for c in df.columns}
    return df.withColumns(
        {present.get(name.lower(), name): F.lit(value).cast(kind) for name, kind in columns.items()}
    )


def drop_blank_rows(extract: DataFrame) -> DataFrame:
    return extract.filter(F.col(LABEL).isNotNull())


def map_accounts(extract: DataFrame, qb_accounts: DataFrame, accounts: DataFrame) -> DataFrame:
    """``qblinkid`` and ``AccountID`` of each row: cleaned label → extract account → ledger account.

    The two lookups are chained among themselves first, so the extract moves once. A name or link listed more than
    once gives its least id.
    """
    links = per_key(
        accounts.select(F.col("QBLinkID").alias("qblinkid"), "AccountID"),
        ["qblinkid"],
        F.min("AccountID").alias("AccountID"),
    )
    names = per_key(
        qb_accounts.select(F.col("FullName").alias("_name"), "ListID"), ["_name"], F.min("ListID").alias("qblinkid")
    )
    lookup = names.join(links, "qblinkid", "left")
    rows = extract.drop("qblinkid", "AccountID").withColumn("_name", clean_label(LABEL))
    return rows.join(lookup, "_name", "left").select(*[c for c in rows.columns if c != "_name"], "qblinkid", "AccountID")


def unmapped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("AccountID").isNull())


def control_totals(df: DataFrame, *by: str) -> DataFrame:
    """Sums of debit, credit and, once it exists, final balance."""
    amounts = [c for c in ("Debit", "Credit", "FinalBalance") if c in df.columns]
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in amounts])


def with_balance(extract: DataFrame) -> DataFrame:
    return extract.withColumn("Balance", signed_balance().cast(MONEY))


def final_balance(extract: DataFrame, tb: DataFrame) -> DataFrame:
    """``FinalBalance``: what must still be booked for the ledger to agree with the extract.

    Accounts in both: extract minus ledger. Only in the extract: its own balance. Unmapped rows: 0. Accounts with a
    balance only in the ledger come as new rows of account and negated balance. Rows without a label go before the new
    rows are added, so those stay.

    ``extract`` is a mapped extract with ``Balance``; both frames carry ``basis``.
    """
    keys = ["basis", "AccountID"]
    ours = tb.filter(F.col("AccountID").isNotNull()).select(*keys, F.col("Balance").alias("_ledger"))
    per_account = per_key(ours, keys, F.min("_ledger").alias("_ledger"), F.lit(True).alias("_known"))
    labelled = drop_blank_rows(extract.drop("FinalBalance"))
    difference = (
        F.when(F.col("AccountID").isNull(), F.lit(0))
        .when(F.col("_known"), F.col("Balance") - F.col("_ledger"))
        .otherwise(F.col("Balance"))
    )
    compared = labelled.join(per_account, keys, "left").select(
        *labelled.columns, difference.cast(MONEY).alias("FinalBalance")
    )
    seen = labelled.select(*keys).dropna().distinct()
    missing = (
        ours.filter(F.col("_ledger") != 0)
        .join(seen, keys, "left_anti")
        .select(*keys, (-F.col("_ledger")).cast(MONEY).alias("FinalBalance"))
    )
    return compared.unionByName(missing, allowMissingColumns=True)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys on more than one row, with their number. NULL is a key like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def hybrid_flag(final: DataFrame) -> DataFrame:
    """``JournalType``: ``Hybrid`` where account and non-zero final balance agree in both bases, else NULL."""
    keys = ["AccountID", "FinalBalance"]
    balances = final.filter(F.col("FinalBalance") != 0)
    pairs = (
        per_key(balances, keys, F.min("basis").alias("_first"), F.max("basis").alias("_last"))
        .filter(F.col("_first") != F.col("_last"))
        .select(*keys, F.lit(HYBRID).alias("JournalType"))
    )
    rows = final.drop("JournalType")
    return rows.join(pairs, keys, "left").select(*rows.columns, "JournalType")


def suspect_links(df: DataFrame) -> DataFrame:
    """Rows whose external link equals the ledger account id."""
    return df.filter(F.col("qblinkid") == F.col("AccountID"))


def by_basis(accrual: DataFrame, cash: DataFrame) -> DataFrame:
    """The two bases stacked with a ``basis`` column; columns of only one are NULL in the other."""

    return accrual.withColumn("basis", F.lit(ACCRUAL)).unionByName(
        cash.withColumn("basis", F.lit(CASH)), allowMissingColumns=True
    )

