"""Every operator as a query over the trial ledger of ``sources.adapter``, with fixed dates.

Money columns come out as ``decimal(38,2)`` and generated ids are left out, so results can be compared with SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions import labels
from tallyspark.operators import aging, ingest, journals, recheck, reconcile, trial_balance, validation
from tallyspark.plans import extract_runs as runs
from tallyspark.plans import month_end as month
from tallyspark.plans.ap_report import ap_aging as ap_aging_report
from tallyspark.plans.ap_report_sql import create_ap_aging
from tallyspark.sources import loads
from tallyspark.sources.adapter import adapter_tables
from tallyspark.sources.purge import replace_batches_in_files
from tallyspark.sources.sinks import bulk_append as append_rows
from tallyspark.sources.sinks import bulk_append_path, write_period
from tallyspark.sources.staging import staged, staging_path
from tallyspark.sources.tables import LedgerTables, bucketed, drop_bucketed

AS_OF = date(2001, 6, 30)
TODAY = date(2001, 7, 15)
# Metadata rows as a loader would find them, over the columns of ``customer`` records.
CUSTOMER_META = [
    {"ColumnName": "c_custkey", "DataType": "System.Int64", "AllowDBNull": False, "IsKey": True},
    {"ColumnName": "c_name", "DataType": "System.String"},
    {"ColumnName": "c_nationkey", "DataType": "System.Int16"},
    {"ColumnName": "c_acctbal", "DataType": "System.Decimal"},
    {"ColumnName": "c_mktsegment", "DataType": "System.String", "IsHidden": True},
]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _money(df: DataFrame) -> DataFrame:
    amounts = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("decimal(38,2)") for c in amounts})


def _query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _money(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def _ledger_query(build: Callable[[LedgerTables], DataFrame]) -> Callable[[LedgerTables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _money(build(adapter_tables(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def _base(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _new_table(spark: SparkSession) -> tuple[str, str]:
    """A new name in the catalog and a folder of this run for it."""
    return f"query_{uuid.uuid4().hex}", staging_path(spark, "table")


def _read_once(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table, which then leaves the catalog again."""
    rows = staged(spark.table(table), "read_back")
    spark.sql(f"DROP TABLE {table}")
    return rows


# Accounts payable


@_ledger_query
def ap_billed(t: LedgerTables) -> DataFrame:
    return aging.billed(t.bills, t.details, AS_OF)


@_ledger_query
def ap_account_fallback(t: LedgerTables) -> DataFrame:
    return aging.ap_account(t.bills, t.details).select("VendorBillID", "APAccount")


@_ledger_query
def ap_payments(t: LedgerTables) -> DataFrame:
    return aging.payments(t.employees, t.bills, t.details, t.txns, t.checks, AS_OF)


@_ledger_query
def ap_discounts(t: LedgerTables) -> DataFrame:
    return aging.discounts(t.employees, t.bills, t.details, t.txns, t.checks, AS_OF)


@_ledger_query
def ap_bill_balance(t: LedgerTables) -> DataFrame:
    return aging.bill_positions(t.employees, t.bills, t.details, t.txns, t.checks, AS_OF)


@_ledger_query
def ap_bill_balance_steps(t: LedgerTables) -> DataFrame:
    paid = aging.payments(t.employees, t.bills, t.details, t.txns, t.checks, AS_OF)
    discounts = aging.discounts(t.employees, t.bills, t.details, t.txns, t.checks, AS_OF)
    return aging.bill_balance(aging.billed(t.bills, t.details, AS_OF), paid, discounts)


@_ledger_query
def ap_credit_used(t: LedgerTables) -> DataFrame:
    return aging.credit_used(t.txns, t.details, t.credit_uses, AS_OF)


@_ledger_query
def ap_vendor_credit(t: LedgerTables) -> DataFrame:
    return aging.vendor_credit(t.txns, t.details, t.credit_uses, AS_OF)


@_ledger_query
def ap_journal_balance(t: LedgerTables) -> DataFrame:
    return aging.journal_balance(t.txns, t.details, t.accounts, AS_OF)


@_ledger_query
def ap_aging_buckets(t: LedgerTables) -> DataFrame:
    open_bills = aging.billed(t.bills, t.details, AS_OF).withColumnRenamed("Billed", "Balance")
    rows = aging.aging_buckets(open_bills.select("VendorBillID", "BillDate", "BillNumber", "Balance"), TODAY)
    return rows.drop("BillNumber")


@_ledger_query
def ap_aging(t: LedgerTables) -> DataFrame:
    return ap_aging_report(t, AS_OF, TODAY)


@_ledger_query
def ap_aging_sql(t: LedgerTables) -> DataFrame:
    spark, name = t.bills.sparkSession, "ap_aging_of_query"
    create_ap_aging(spark, t, name)
    return spark.sql(f"SELECT * FROM {name}(DATE '{AS_OF}', DATE '{TODAY}')")


# Trial balances


def _accrual(t: LedgerTables) -> DataFrame:
    return trial_balance.trial_balance_accrual(t.accounts, t.account_types, t.summary, AS_OF)


def _cash(t: LedgerTables) -> DataFrame:
    return trial_balance.trial_balance_cash(t.accounts, t.account_types, t.cash_details, AS_OF)


@_ledger_query
def tb_accrual(t: LedgerTables) -> DataFrame:
    return _accrual(t)


@_ledger_query
def tb_cash(t: LedgerTables) -> DataFrame:
    return _cash(t)


@_ledger_query
def tb_plug(t: LedgerTables) -> DataFrame:
    present = trial_balance.with_plug(_accrual(t).select("AccountID", "Balance"), "A39")
    absent = trial_balance.with_plug(_cash(t))
    return reconcile.by_basis(present, absent)


@_ledger_query
def tb_zero_check(t: LedgerTables) -> DataFrame:
    accrual, cash = _accrual(t).select("AccountID", "Balance"), _cash(t)
    before = reconcile.by_basis(accrual, cash).withColumn("plugged", F.lit(False))
    after = reconcile.by_basis(trial_balance.with_plug(accrual), trial_balance.with_plug(cash))
    both = before.unionByName(after.withColumn("plugged", F.lit(True)))
    return trial_balance.zero_check(both, "basis", "plugged")


@_ledger_query
def tb_period(t: LedgerTables) -> DataFrame:
    """Both bases stored, one of them rebuilt empty and then again, read back."""
    spark = t.accounts.sparkSession
    path = staging_path(spark, "periods")
    accrual = _accrual(t).select("AccountID", "Balance")
    write_period(trial_balance.in_period(accrual, AS_OF, "A"), path, "200106", "A")
    write_period(trial_balance.in_period(_cash(t), AS_OF, "C", "yearly"), path, "2001", "C")
    write_period(accrual.limit(0), path, "200106", "A")
    write_period(trial_balance.in_period(accrual, AS_OF, "A"), path, "200106", "A")
    return spark.read.parquet(path).withColumn("period", F.col("period").cast("string"))


@_ledger_query
def tb_switch(t: LedgerTables) -> DataFrame:
    """As ``tb_period``, in a catalog table whose partitions are switched."""
    spark, (name, path) = t.accounts.sparkSession, _new_table(t.accounts.sparkSession)
    accrual = trial_balance.in_period(_accrual(t).select("AccountID", "Balance"), AS_OF, "A")
    cash = trial_balance.in_period(_cash(t), AS_OF, "C", "yearly")
    loads.create_partitioned(spark, name, accrual.schema, ["period", "basis"], path)
    loads.switch_period(accrual.withColumn("Balance", -F.col("Balance")), name, "200106", "A")
    loads.switch_period(cash, name, "2001", "C")
    loads.switch_period(accrual.limit(0), name, "200106", "A")
    loads.switch_period(accrual, name, "200106", "A")
    return _read_once(spark, name)


# Reconciliation


def _extract(t: LedgerTables) -> DataFrame:
    return reconcile.by_basis(t.extract_accrual, t.extract_cash)


def _mapped(t: LedgerTables) -> DataFrame:
    labelled = reconcile.drop_blank_rows(_extract(t))
    return reconcile.with_balance(reconcile.map_accounts(labelled, t.qb_accounts, t.accounts))


def _stored_tb(t: LedgerTables) -> DataFrame:
    return staged(month.trial_balances(t, AS_OF), "trial_balance")


def _compared(t: LedgerTables) -> DataFrame:
    return month.reconciled_extract(t, _stored_tb(t))


def _reconciled(t: LedgerTables) -> DataFrame:
    flagged = reconcile.hybrid_flag(staged(_compared(t), "compared"))
    return staged(flagged, "reconciled")


@_ledger_query
def ensure_columns(t: LedgerTables) -> DataFrame:
    fresh = reconcile.ensure_columns(_extract(t), {"qblinkid": "string", "Accountid": "string"})
    return reconcile.ensure_columns(fresh, {"debit": "decimal(19,4)"}, 0).select(
        "basis", "F2", F.col("debit").alias("Debit"), "Credit", "qblinkid", F.col("Accountid").alias("AccountID")
    )


@_ledger_query
def drop_blank_rows(t: LedgerTables) -> DataFrame:
    return reconcile.drop_blank_rows(_extract(t))


@_ledger_query
def clean_label(t: LedgerTables) -> DataFrame:
    return _extract(t).select("basis", "F2", labels.clean_label("F2").alias("label"))


@_ledger_query
def map_accounts(t: LedgerTables) -> DataFrame:
    return _mapped(t).select("basis", "F2", "qblinkid", "AccountID")


@_ledger_query
def unmapped_rows(t: LedgerTables) -> DataFrame:
    return reconcile.unmapped(_mapped(t)).select("basis", "F2", "Debit", "Credit", "qblinkid")


@_ledger_query
def control_totals(t: LedgerTables) -> DataFrame:
    return reconcile.control_totals(_compared(t), "basis")


@_ledger_query
def signed_balance(t: LedgerTables) -> DataFrame:
    return reconcile.with_balance(_extract(t))


@_ledger_query
def final_balance(t: LedgerTables) -> DataFrame:
    return _compared(t)


@_ledger_query
def extract_runs(t: LedgerTables) -> DataFrame:
    """An extract that is stored once and reconciled twice, each run a step from what the one before has left."""
    spark, (name, path) = t.accounts.sparkSession, _new_table(t.accounts.sparkSession)
    runs.create_extract(spark, name, path)
    runs.store_extract(_extract(t), name, "0")
    tb = _stored_tb(t)
    for before, run in (("0", "1"), ("1", "2")):
        runs.reconcile_run(t, name, tb, before, run)
    return _read_once(spark, name).select("run", "basis", "F2", "AccountID", "FinalBalance", "JournalType")


@_ledger_query
def duplicate_accounts(t: LedgerTables) -> DataFrame:
    return reconcile.duplicates(_mapped(t), "basis", "AccountID")


@_ledger_query
def hybrid_flag(t: LedgerTables) -> DataFrame:
    return reconcile.hybrid_flag(staged(_compared(t), "compared")).select(
        "basis", "F2", "AccountID", "FinalBalance", "JournalType"
    )


@_ledger_query
def suspect_links(t: LedgerTables) -> DataFrame:
    # A ledger in which the accounts of one type were keyed in under their external link.
    wrong = F.col("AccountTypeID") == 3
    accounts = t.accounts.withColumn("AccountID", F.when(wrong, F.col("QBLinkID")).otherwise(F.col("AccountID")))
    mapped = reconcile.map_accounts(_extract(t), t.qb_accounts, accounts)
    return reconcile.suspect_links(mapped).select("basis", "F2", "qblinkid", "AccountID")


# Journals


LINE_COLUMNS = [
    "LastUpdatedBy",
    "TransactionType",
    "TransactionDate",
    "CreditAccountID",
    "CreditAmount",
    "DebitAccountID",
    "DebitAmount",
    "ThisAccountID",
]
HEADER_COLUMNS = ["LastUpdatedBy", "TransactionType", "TransactionDate", "TransactionAmount", "ParentAccountID"]


def _raw_journals(t: LedgerTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Headers and lines before the last two steps, from the single operators, and the facts."""
    rows = journals.journal_rows(_reconciled(t))
    facts = journals.journal_facts(rows)
    lines = (
        journals.journal_lines(rows, facts, journals.CREDIT, AS_OF)
        .unionByName(journals.journal_lines(rows, facts, journals.DEBIT, AS_OF))
        .unionByName(journals.journal_zero_lines(facts, AS_OF))
        .unionByName(journals.journal_adjustment(facts, AS_OF))
    )
    return journals.journal_headers(facts, AS_OF), lines, facts


def _journals(t: LedgerTables) -> journals.Journals:
    return journals.generate_journals(_reconciled(t), AS_OF)


def _rows_and_facts(t: LedgerTables) -> tuple[DataFrame, DataFrame]:
    rows = journals.journal_rows(_reconciled(t))
    return rows, journals.journal_facts(rows)


@_ledger_query
def journal_purge(t: LedgerTables) -> DataFrame:
    earlier = F.when(F.col("TransactionType") == 11, F.lit("CJ200106HYB")).when(
        F.col("TransactionType") == 5, F.lit("CJ200105HYB")
    )
    existing = t.details.withColumn("LastUpdatedBy", earlier)
    replaced = journals.replace_batch(existing, _journals(t).details, journals.batch_tags(AS_OF))
    return replaced.select(*LINE_COLUMNS)


@_ledger_query
def journal_switch(t: LedgerTables) -> DataFrame:
    """As ``journal_purge``, in a stored table whose batches are switched."""
    earlier = F.when(F.col("TransactionType") == 11, F.lit("CJ200106HYB")).when(
        F.col("TransactionType") == 5, F.lit("CJ200105HYB")
    )
    new = _journals(t).details.select(*LINE_COLUMNS)
    existing = t.details.withColumn("LastUpdatedBy", earlier).select(*[F.col(f.name).cast(f.dataType) for f in new.schema])
    spark, (name, path) = t.details.sparkSession, _new_table(t.details.sparkSession)
    loads.create_partitioned(spark, name, new.schema, ["LastUpdatedBy"], path)
    append_rows(existing, name)
    loads.switch_batches(new, name, [f"CJ200106{s.suffix}" for s in journals.SPECS])
    return _read_once(spark, name).select(*LINE_COLUMNS)


@_ledger_query
def journal_purge_files(t: LedgerTables) -> DataFrame:
    """As ``journal_purge``, in a folder of files of which only those with an earlier batch are written anew."""
    earlier = F.when(F.col("TransactionType") == 11, F.lit("CJ200106HYB")).when(
        F.col("TransactionType") == 5, F.lit("CJ200105HYB")
    )
    new = _journals(t).details.select(*LINE_COLUMNS)
    existing = t.details.withColumn("LastUpdatedBy", earlier).select(*[F.col(f.name).cast(f.dataType) for f in new.schema])
    path = staging_path(t.details.sparkSession, "lines")
    existing.write.parquet(path)
    replace_batches_in_files(new, path, [f"CJ200106{s.suffix}" for s in journals.SPECS])
    return t.details.sparkSession.read.parquet(path).select(*LINE_COLUMNS)


@_ledger_query
def journal_header(t: LedgerTables) -> DataFrame:
    _, facts = _rows_and_facts(t)
    return journals.journal_headers(facts, AS_OF).select(*HEADER_COLUMNS)


@_ledger_query
def journal_credit_lines(t: LedgerTables) -> DataFrame:
    rows, facts = _rows_and_facts(t)
    return journals.journal_lines(rows, facts, journals.CREDIT, AS_OF).select(*LINE_COLUMNS)


@_ledger_query
def journal_debit_lines(t: LedgerTables) -> DataFrame:
    rows, facts = _rows_and_facts(t)
    return journals.journal_lines(rows, facts, journals.DEBIT, AS_OF).select(*LINE_COLUMNS)


@_ledger_query
def journal_zero_lines(t: LedgerTables) -> DataFrame:
    # The same amounts all on one side: credits in the hybrid batch, debits in the two others.
    size = F.abs("FinalBalance")
    one_sided = _reconciled(t).withColumn("FinalBalance", F.when(F.col("JournalType").isNotNull(), -size).otherwise(size))
    rows = journals.journal_rows(one_sided)
    return journals.journal_zero_lines(journals.journal_facts(rows), AS_OF).select(*LINE_COLUMNS)


@_ledger_query
def journal_adjustment(t: LedgerTables) -> DataFrame:
    _, facts = _rows_and_facts(t)
    return journals.journal_adjustment(facts, AS_OF).select(*LINE_COLUMNS)


@_ledger_query
def journal_header_amount(t: LedgerTables) -> DataFrame:
    headers, lines, _ = _raw_journals(t)
    return journals.with_header_amount(headers, lines).select(*HEADER_COLUMNS)


@_ledger_query
def journal_retype(t: LedgerTables) -> DataFrame:
    return _journals(t).details.select(*LINE_COLUMNS)


@_ledger_query
def journal_retype_steps(t: LedgerTables) -> DataFrame:
    headers, lines, _ = _raw_journals(t)
    return journals.retype_lines(lines, headers).select(*LINE_COLUMNS)


@_ledger_query
def journal_line_ids(t: LedgerTables) -> DataFrame:
    """Lines and distinct line ids from an extract in which every row stands twice."""
    final = _reconciled(t)
    made = journals.generate_journals(staged(final.unionByName(final), "doubled"), AS_OF).details
    per_id = made.groupBy("LastUpdatedBy", "APTransDetailID").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("LastUpdatedBy").agg(F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_ids"))


# Checks


@_ledger_query
def chk_one_parent_line(t: LedgerTables) -> DataFrame:
    tags = [f"CJ200106{s.suffix}" for s in journals.SPECS]
    return validation.parent_lines_per_batch(_journals(t).details, tags)


@_ledger_query
def chk_dup_parent_line(t: LedgerTables) -> DataFrame:
    return validation.duplicate_parent_lines(t.details)


@_ledger_query
def chk_total_balanced(t: LedgerTables) -> DataFrame:
    return validation.total_balanced(t.details)


@_ledger_query
def chk_total_balanced_nulls(t: LedgerTables) -> DataFrame:
    # Amounts on one side only, so that the other has no total.
    one_sided = t.details.withColumn("CreditAmount", F.lit(None).cast("decimal(18,2)"))
    return validation.total_balanced(one_sided, nulls_as_zero=True)


@_ledger_query
def chk_txn_balanced(t: LedgerTables) -> DataFrame:
    return validation.unbalanced_transactions(t.details)


@_ledger_query
def chk_header_amount(t: LedgerTables) -> DataFrame:
    return validation.header_amounts(t.txns, t.details).select(
        "APTransactionID", "TransactionType", "TransactionAmount", "amt"
    )


@_ledger_query
def chk_header_amount_credit(t: LedgerTables) -> DataFrame:
    return validation.header_amounts(t.txns, t.details, side="credit").select(
        "APTransactionID", "TransactionType", "TransactionAmount", "amt"
    )


CHECKED_LINE = [
    "ApTransactionID",
    "TransactionType",
    "ThisAccountID",
    "CreditAccountID",
    "DebitAccountID",
    "CreditAmount",
    "DebitAmount",
]


@_ledger_query
def chk_account_missing(t: LedgerTables) -> DataFrame:
    return validation.missing_account(t.details).select(*CHECKED_LINE)


@_ledger_query
def chk_credit_account(t: LedgerTables) -> DataFrame:
    return validation.other_credit_account(t.details).select(*CHECKED_LINE)


@_ledger_query
def chk_debit_account(t: LedgerTables) -> DataFrame:
    return validation.other_debit_account(t.details).select(*CHECKED_LINE)


@_ledger_query
def chk_account_known(t: LedgerTables) -> DataFrame:
    return validation.unknown_account(t.details, t.accounts).select(*CHECKED_LINE)


@_ledger_query
def chk_parent_missing(t: LedgerTables) -> DataFrame:
    return validation.missing_parent(t.txns).select("APTransactionID", "TransactionType", "TransactionAmount")


@_ledger_query
def chk_parent_known(t: LedgerTables) -> DataFrame:
    return validation.unknown_parent(t.txns, t.accounts).select("APTransactionID", "TransactionType", "ParentAccountID")


@_ledger_query
def chk_all(t: LedgerTables) -> DataFrame:
    return validation.check_ledger(t.details, t.txns, t.accounts).results


@_ledger_query
def chk_violations(t: LedgerTables) -> DataFrame:
    return validation.check_ledger(t.details, t.txns, t.accounts).violations.drop("batch")


@_ledger_query
def chk_violations_bucketed(t: LedgerTables) -> DataFrame:
    """The same from lines and headers that are stored by transaction."""
    spark, (name, path) = t.details.sparkSession, _new_table(t.details.sparkSession)
    stored = bucketed(t, spark, name, path, int(spark.conf.get("spark.sql.shuffle.partitions")), ("details", "txns"))
    found = validation.check_ledger(stored.details, stored.txns, t.accounts).violations.drop("batch")
    drop_bucketed(spark, name)
    return found


# After the migration


@_ledger_query
def mig_mismatch(t: LedgerTables) -> DataFrame:
    tb = _stored_tb(t)
    return recheck.mismatch(_mapped(t), tb).select("basis", "AccountID", "Balance", "ledger_balance")


@_ledger_query
def mig_missing_in_ledger(t: LedgerTables) -> DataFrame:
    # Each extract against the ledger of the other basis, in which some of its accounts are missing.
    other = F.when(F.col("basis") == "A", F.lit("C")).otherwise(F.lit("A"))
    tb = _stored_tb(t).withColumn("basis", other)
    return recheck.missing(_mapped(t), tb, trim=True).select("basis", "AccountID", "Balance")


@_ledger_query
def mig_missing_in_extract(t: LedgerTables) -> DataFrame:
    return recheck.missing(_stored_tb(t), _mapped(t)).select("basis", "AccountID", "Balance")


@_ledger_query
def mig_unbalanced(t: LedgerTables) -> DataFrame:
    return recheck.unbalanced(t.details)


@_ledger_query
def month_end(t: LedgerTables) -> DataFrame:
    return month.month_end(t, AS_OF).rebuilt


@_ledger_query
def month_end_checks(t: LedgerTables) -> DataFrame:
    return month.month_end(t, AS_OF).checks


@_ledger_query
def month_end_left_over(t: LedgerTables) -> DataFrame:
    return month.comparison(month.month_end(t, AS_OF))


# Loading


@_query
def conform_to_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.conform_to_metadata(_base(spark, folder, "customer"), CUSTOMER_META)


@_query
def null_violations(spark: SparkSession, folder: str) -> DataFrame:
    # Every eleventh customer came without a name.
    name = F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).alias("c_name")
    meta = [*CUSTOMER_META[:1], {**CUSTOMER_META[1], "AllowDBNull": False}]
    return ingest.null_violations(_base(spark, folder, "customer").select("c_custkey", name), meta)


@_query
def key_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = _base(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return ingest.key_violations(lines, ["l_orderkey", "l_linenumber"])


@_query
def key_violations_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the columns marked as key, of the first two columns, of two given places, and of no key at all."""
    customers = _base(spark, folder, "customer")
    parts = []
    for label, keys in (
        ("marked", ingest.key_columns(CUSTOMER_META)),
        ("first", ingest.key_columns(CUSTOMER_META[1:], 2)),
        ("places", ingest.key_columns(CUSTOMER_META, [4, 2])),
        ("none", ingest.key_columns(CUSTOMER_META[1:])),
    ):
        found = ingest.key_violations(customers, keys)
        parts.append(found.agg(F.lit(label).alias("keys"), F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)


@_query
def conform_frame(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.conform_frame(_base(spark, folder, "orders"))


@_query
def staging_table(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.to_staging(_base(spark, folder, "conversations"), 6, ["conv_id", "turn"])


@_query
def bulk_append(spark: SparkSession, folder: str) -> DataFrame:
    customers = _base(spark, folder, "customer")
    path = staging_path(spark, "customers")
    bulk_append_path(customers, path)
    bulk_append_path(customers.withColumn("c_acctbal", -F.col("c_acctbal")), path)
    return spark.read.parquet(path)


@_query
def load_once(spark: SparkSession, folder: str) -> DataFrame:
    """A load, the same again, one that fails half-way and is run again: each row is there once."""
    customers = _base(spark, folder, "customer")
    name, path = _new_table(spark)
    loads.create_partitioned(spark, name, customers.withColumn(loads.LOAD, F.lit("")).schema, [loads.LOAD], path)
    outcomes = [loads.append_once(customers, name, "first"), loads.append_once(customers, name, "first")]
    second = customers.withColumn("c_acctbal", -F.col("c_acctbal"))
    cut_off = F.when(F.col("c_custkey") % 50 == 7, F.raise_error(F.lit("source cut off")).cast("double"))
    try:
        loads.append_once(second.withColumn("c_acctbal", cut_off.otherwise(F.col("c_acctbal"))), name, "second")
    except PySparkException:
        outcomes.append(False)
    outcomes.append(loads.append_once(second, name, "second"))
    n_added = F.lit(sum(outcomes)).cast("int").alias("n_added")
    return _read_once(spark, name).select("*", F.lit(len(outcomes)).alias("n_tried"), n_added)


@_query
def load_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Loads with a key: the rows of those that were taken, and the clashing keys of those that were refused."""
    customers = _base(spark, folder, "customer")
    name, path = _new_table(spark)
    keys, nation = ["c_custkey"], F.col("c_nationkey")
    loads.create_keyed(spark, name, customers.schema, keys, path)
    east = customers.filter(nation >= 15)
    refused = []
    for load, rows in (
        ("west", customers.filter(nation < 15)),
        ("twice", east.unionByName(east)),
        ("over", customers.filter(nation >= 10)),
        ("east", east),
    ):
        try:
            loads.append_keyed(rows, name, load, keys)
        except loads.KeyClash as clash:
            for kind, found in (("inside", clash.inside), ("stored", clash.stored)):
                refused.append(staged(found.select(F.lit(load).alias(loads.LOAD), F.lit(kind).alias("kind"), *keys), "clashes"))
    taken = _read_once(spark, name).select(loads.LOAD, F.lit("row").alias("kind"), *keys)
    spark.sql(f"DROP TABLE {name}_keys")
    return reduce(DataFrame.unionByName, refused, taken)


@_query
def json_records(spark: SparkSession, folder: str) -> DataFrame:
    # Some messages got lost, came empty or blank, were cut, or had something after them.
    broken = (
        F.when(F.col("event_id") % 9 == 1, F.lit(None))
        .when(F.col("event_id") % 9 == 2, F.lit(""))
        .when(F.col("event_id") % 9 == 3, F.lit("  "))
        .when(F.col("event_id") % 9 == 4, F.replace("props", F.lit("}")))
        .when(F.col("event_id") % 9 == 5, F.concat("props", F.lit(" junk")))
        .otherwise(F.col("props"))
    )
    events = _base(spark, folder, "events").select("event_id", broken.alias("props"))
    parsed = ingest.json_records(events, "props", "k int")
    records = parsed.records.withColumn("is_record", F.lit(True))
    return records.unionByName(parsed.rejects.withColumn("is_record", F.lit(False)), allowMissingColumns=True)
