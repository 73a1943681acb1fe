"""An extracted trial balance as a stored table that runs of the reconciliation take from one state to the next.

Each run is a partition of the table. It starts from the rows that an earlier run has left: rows without a label, which
that run had added for accounts that only the ledger knows, go first, what it had computed is reset, and the rows are
mapped and compared anew. So a run can be repeated, and running again on the same ledger changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import reconcile
from tallyspark.plans.month_end import reconciled_extract
from tallyspark.sources import loads
from tallyspark.sources.staging import staged
from tallyspark.sources.tables import LedgerTables

RUN = "run"
# The columns of an extract, and those that a run computes, which a new extract doesn't have.
EXTRACT = {"basis": "string", "F2": "string", "Debit": "decimal(19,4)", "Credit": "decimal(19,4)"}
COMPUTED = {
    "qblinkid": "string",
    "AccountID": "string",
    "Balance": reconcile.MONEY,
    "FinalBalance": reconcile.MONEY,
    "JournalType": "string",
}


def create_extract(spark: SparkSession, table: str, path: str | None = None) -> None:
    """An empty table of extracts in ``path`` or where the warehouse puts it."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in EXTRACT.items())
    loads.create_partitioned(spark, table, spark.createDataFrame([], f"{ddl}, {RUN} string").schema, [RUN], path)


def _all_columns(rows: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """``rows`` with the table's columns, NULL where they have none."""
    fields = [f for f in spark.table(table).schema if f.name != RUN]
    have = set(rows.columns)
    return rows.select(
        *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def store_extract(extract: DataFrame, table: str, run: str) -> None:
    """Store both extracts, in one frame with ``basis``, as the state ``run``."""
    loads.switch_partition(_all_columns(extract.select(*EXTRACT), extract.sparkSession, table), table, {RUN: run})


def reconcile_run(tables: LedgerTables, table: str, tb: DataFrame, before: str, run: str) -> DataFrame:
    """Reconcile the state ``before`` with the ledger, store the result as the state ``run``, and return it.

    The table gains the computed columns at its first run without being written anew. ``run`` may have been stored
    already and is replaced in one step, but isn't ``before``.
    """
    spark = tb.sparkSession
    if before == run:
        raise ValueError(f"run {run} can't start from itself")
    loads.ensure_stored_columns(spark, table, COMPUTED)
    rows = spark.table(table).filter(F.col(RUN) == before).drop(RUN)
    fresh = reconcile.ensure_columns(reconcile.drop_blank_rows(rows), COMPUTED)
    compared = reconciled_extract(tables, tb, fresh.select(*EXTRACT))
    final = staged(reconcile.hybrid_flag(staged(compared, "compared")), "reconciled")
    loads.switch_partition(_all_columns(final, spark, table), table, {RUN: run})
    return spark.table(table).filter(F.col(RUN) == run)
