"""The ledger's tables as one bundle of DataFrames, read from a catalog namespace or a Parquet folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

# Table name of each part of the bundle.
TABLE_NAMES = {
    "bills": "vendor_bill",
    "txns": "ap_transaction_table",
    "details": "ap_transaction_details",
    "checks": "check_details",
    "credit_uses": "ap_credit_used",
    "employees": "employee",
    "accounts": "account_list",
    "account_types": "account_type_list",
    "summary": "transaction_summary",
    "cash_details": "transaction_detail_cash",
    "qb_accounts": "qb_account",
    "extract_accrual": "qb_tb_a",
    "extract_cash": "qb_tb_c",
}


class LedgerTables:
    """Tables as attributes named by ``TABLE_NAMES``, each read when first asked for."""

    def __init__(self, read: Callable[[str], DataFrame]) -> None:
        self._read = read
        self._tables: dict[str, DataFrame] = {}

    def __getattr__(self, part: str) -> DataFrame:
        if part not in TABLE_NAMES:
            raise AttributeError(part)
        if part not in self._tables:
            self._tables[part] = self._read(TABLE_NAMES[part])
        return self._tables[part]

    def replacing(self, **tables: DataFrame) -> LedgerTables:
        """The same bundle with some tables exchanged."""
        changed = LedgerTables(lambda name: getattr(self, next(p for p, n in TABLE_NAMES.items() if n == name)))
        changed._tables = dict(tables)
        return changed


def read_catalog(spark: SparkSession, namespace: str) -> LedgerTables:
    return LedgerTables(lambda name: spark.table(f"{namespace}.{name}"))


def read_parquet(spark: SparkSession, root: str) -> LedgerTables:
    return LedgerTables(lambda name: spark.read.parquet(f"{root}/{name}"))


# Parts of the bundle that are bucketed by transaction, with the column that names it, and into how many buckets.
_BY_TRANSACTION = {"details": "ApTransactionID", "txns": "APTransactionID", "checks": "APTransactionID"}
TRANSACTION_BUCKETS = 256


def bucketed(
    tables: LedgerTables,
    spark: SparkSession,
    prefix: str,
    path: str | None = None,
    buckets: int = TRANSACTION_BUCKETS,
    parts: Iterable[str] = tuple(_BY_TRANSACTION),
) -> LedgerTables:
    """The bundle with lines, headers and checks, or those of ``parts``, in catalog tables bucketed and sorted by transaction.

    What is grouped or joined by transaction then isn't shuffled. The tables are named by ``prefix`` and the table and lie
    in ``path`` or where the warehouse puts them; tables of these names are replaced. Choose so many buckets that one fits
    a task. A bucket is read by one task, so keep the plain tables where one transaction, or none at all, holds a
    large share of the lines: adaptive execution splits those, but no bucket.
    """
    stored = {}
    for part in parts:
        key, name = _BY_TRANSACTION[part], f"{prefix}_{TABLE_NAMES[part]}"
        writer = getattr(tables, part).repartition(buckets, key).write.format("parquet").mode("overwrite")
        writer = writer.bucketBy(buckets, key).sortBy(key)
        (writer if path is None else writer.option("path", f"{path.rstrip('/')}/{name}")).saveAsTable(name)
        stored[part] = spark.table(name)
    return tables.replacing(**stored)


def drop_bucketed(spark: SparkSession, prefix: str) -> None:
    """Takes the tables that ``bucketed`` made out of the catalog."""
    for part in _BY_TRANSACTION:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{TABLE_NAMES[part]}")
