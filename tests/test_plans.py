"""Plans: what is pushed down, what is broadcast, and whether hot keys are split."""

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import aging, reconcile, trial_balance, validation
from tallyspark.plans import month_end
from tallyspark.plans.ap_report import ap_aging
from tallyspark.plans.ap_report_sql import create_ap_aging
from tallyspark.queries import QUERIES
from tallyspark.sources.adapter import adapter_tables
from tallyspark.sources.staging import staged
from tallyspark.sources.tables import bucketed, drop_bucketed

FOLDER = "/root/testdata/sf0.001"
AS_OF = date(2001, 6, 30)
DAY = date(2001, 1, 1)


def plan(df, run=False):
    if run:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text.split("== Initial Plan ==")[0] if run else text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_unchecked_broadcast_no_window_over_data(spark, settings, name):
    """With size-checked broadcasts off, those left are hints: journal facts and one row per partition."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text
    if "Window" in text:
        # Over one row per partition, or over journal lines alike in all their parts.
        assert name == "staging_table" or text.count("windowspecdefinition(") == text.count("windowspecdefinition(suffix#")
    if "BroadcastHashJoin" in text:
        assert name.startswith(("journal_", "chk_one_parent_line", "staging_table"))


def test_trial_balance_moves_accounts_not_entries(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__maxMetadataStringLength="10000")
    t = adapter_tables(spark, FOLDER)
    text = plan(trial_balance.trial_balance_accrual(t.accounts, t.account_types, t.summary, AS_OF))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert len(set(re.findall(r"l_\w+#", scan))) == 5
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "l_shipdate" in pushed
    # The entries are summed per account in the scan's own stage.
    above = text[: text.index("lineitem.parquet")]
    assert above.rindex("partial_sum") > above.rindex("Exchange hashpartitioning")


def test_plug_scans_the_entries_once(spark):
    t = adapter_tables(spark, FOLDER)
    tb = trial_balance.trial_balance_cash(t.accounts, t.account_types, t.cash_details, AS_OF)
    text = plan(trial_balance.with_plug(tb), run=True)
    assert "ReusedExchange" in text


def test_month_end_reads_stored_frames(spark):
    t = adapter_tables(spark, FOLDER)
    result = month_end.month_end(t, AS_OF)
    for frame in (result.trial_balance, result.reconciled, result.headers, result.details, result.rebuilt):
        assert "lineitem" not in plan(frame) and "Exchange" not in plan(frame)
    assert sorted(r.check_no for r in result.checks.collect()) == list(range(1, 12))


N, KEYS = 200_000, 5_000


def text_id(prefix, column):
    return F.concat(F.lit(prefix), column.cast("string"))


@pytest.fixture()
def hot(spark, settings):
    """Rows of which a third share one key, and settings small enough to call that skewed."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % KEYS)
    return spark.range(0, N, 1, 16).select("id", key.alias("key"))


@pytest.fixture()
def keys(spark):
    return spark.range(0, KEYS, 1, 8)


MONEY = "decimal(18,2)"


def headers(keys, kind):
    return keys.select(
        text_id("T", F.col("id")).alias("APTransactionID"),
        F.lit(kind).alias("TransactionType"),
        F.lit(DAY).alias("TransactionDate"),
        F.lit(1).cast(MONEY).alias("TransactionAmount"),
        F.lit("V1").alias("PayeeID"),
    )


def lines(hot, kind, txn="key", bill="id"):
    return hot.select(
        text_id("T", F.col(txn)).alias("ApTransactionID"),
        text_id("B", F.col(bill)).alias("VendorBillID"),
        F.lit(kind).alias("TransactionType"),
        F.lit(DAY).alias("TransactionDate"),
        F.lit("A1").alias("CreditAccountID"),
        F.lit(1).cast(MONEY).alias("CreditAmount"),
        F.lit("A1").alias("DebitAccountID"),
        F.col("id").cast(MONEY).alias("DebitAmount"),
        text_id("A", F.when(F.col("id") % 3 == 1, F.lit(5)).otherwise(F.col("id") % KEYS)).alias("ThisAccountID"),
        F.lit(None).cast("string").alias("AccountLineID"),
        F.lit(None).cast("string").alias("Ref"),
    )


def test_hot_transaction_and_vendor_are_split(hot, keys):
    bills = hot.select(
        text_id("B", F.col("id")).alias("VendorBillID"),
        text_id("V", F.col("key")).alias("VendorID"),
        F.lit("A1").alias("APAccountID"),
        *[F.lit(DAY).alias(c) for c in ("BillDate", "BillDueDate")],
        F.lit("x").alias("BillNumber"),
    )
    vendors = keys.select(text_id("V", F.col("id")).alias("EmployeeID"))
    checks = keys.select(text_id("T", F.col("id")).alias("APTransactionID"), F.lit(DAY).alias("CheckDate"))
    result = aging.bill_positions(vendors, bills, lines(hot, 4), headers(keys, 4), checks, AS_OF)
    assert plan(result, run=True).count("skew=true") == 2
    assert result.agg(F.sum("Paid")).first()[0] == N * (N - 1) // 2


def test_hot_credit_is_split(hot, keys):
    uses = hot.select(
        text_id("T", F.col("key")).alias("BillCreditTransactionID"),
        text_id("B", F.col("id")).alias("VendorBillID"),
        F.lit(DAY).alias("TransactionDate"),
        F.lit(1).cast(MONEY).alias("Amount"),
    )
    details = lines(keys.select("id", F.col("id").alias("key")), 20)
    result = aging.applied_credit(headers(keys, 7), details, uses, AS_OF)
    assert "skew=true" in plan(result, run=True)
    assert result.agg(F.sum("_drawn")).first()[0] == N


def test_hot_account_and_journal_are_split(hot, keys):
    accounts = keys.select(text_id("A", F.col("id")).alias("AccountID"), F.lit(0).alias("AccountTypeID"))
    result = aging.journal_balance(headers(keys, 5), lines(hot, 5), accounts, AS_OF)
    assert plan(result, run=True).count("skew=true") == 2
    assert result.agg(F.sum("Balance")).first()[0] == N - N * (N - 1) // 2


def test_hot_label_account_and_balance_are_split(hot, keys):
    extract = hot.select(
        F.lit("A").alias("basis"),
        F.concat(F.lit("1 · n"), F.col("key").cast("string")).alias("F2"),
        F.lit(5).cast(MONEY).alias("Debit"),
        F.lit(None).cast(MONEY).alias("Credit"),
        "id",
    )
    extract = extract.unionByName(extract.withColumn("basis", F.lit("C")))
    qb = keys.select(text_id("Q", F.col("id")).alias("ListID"), text_id("n", F.col("id")).alias("FullName"))
    accounts = keys.select(text_id("Q", F.col("id")).alias("QBLinkID"), text_id("A", F.col("id")).alias("AccountID"))
    mapped = reconcile.map_accounts(extract, qb, accounts)
    assert "skew=true" in plan(mapped, run=True)

    stored = staged(reconcile.with_balance(mapped), "mapped")
    tb = keys.select(text_id("A", F.col("id")).alias("AccountID"), F.lit(3).cast(MONEY).alias("Balance"))
    both = tb.withColumn("basis", F.lit("A")).unionByName(tb.withColumn("basis", F.lit("C")))
    final = reconcile.final_balance(stored, both)
    assert "skew=true" in plan(final, run=True)

    flagged = reconcile.hybrid_flag(staged(final, "final"))
    assert "skew=true" in plan(flagged, run=True)
    assert flagged.filter("JournalType = 'Hybrid'").count() == 2 * N


def _line_scans(monkeypatch, module, run):
    """How often the lines' file is scanned in all that ``run`` stores and returns."""
    texts, store = [], module.staged

    def seen(df, name):
        texts.append(plan(df))
        return store(df, name)

    monkeypatch.setattr(module, "staged", seen)
    texts.append(plan(run()))
    return sum(text.count("lineitem.parquet") for text in texts)


def test_report_scans_lines_four_times_and_uses_once(spark, monkeypatch):
    t = adapter_tables(spark, FOLDER)
    assert _line_scans(monkeypatch, aging, lambda: ap_aging(t, AS_OF, DAY)) == 5


def test_checks_scan_lines_once(spark, monkeypatch):
    t = adapter_tables(spark, FOLDER)
    run = lambda: validation.check_ledger(t.details, t.txns, t.accounts, ["b"]).violations
    assert _line_scans(monkeypatch, validation, run) == 1


def test_results_of_checks_store_no_violations(spark, monkeypatch):
    t = adapter_tables(spark, FOLDER)
    names, store = [], validation.staged
    monkeypatch.setattr(validation, "staged", lambda df, name: names.append(name) or store(df, name))
    checked = validation.check_ledger(t.details, t.txns, t.accounts, ["b"])
    assert checked.results.count() == 11 and "violations" not in names
    before = sorted(map(tuple, checked.results.collect()))
    assert checked.violations.groupBy().sum("n_rows").first()[0] == sum(r[3] for r in before) and "violations" in names


def test_checks_of_the_month_end_book_nothing(spark, monkeypatch):
    monkeypatch.setattr(month_end, "book", lambda *args: pytest.fail("booked"))
    assert month_end.month_end(adapter_tables(spark, FOLDER), AS_OF).checks.count() == 11


def test_extracts_sum_entries_before_accounts_are_joined(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    t = adapter_tables(spark, FOLDER)
    for extract in (t.extract_accrual, t.extract_cash):
        text = plan(extract)
        above = text[: text.index("lineitem.parquet")]
        assert "partial_sum" in above and above.rindex("partial_sum") > above.rindex("Join")


def test_sql_report_filters_by_its_dates_in_the_scan(spark, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    create_ap_aging(spark, adapter_tables(spark, FOLDER), "ap_aging_of_test")
    text = plan(spark.sql("SELECT * FROM ap_aging_of_test(DATE '2001-06-30', DATE '2001-07-15')"))
    # Up to the last day, as the scan's type has it.
    assert "l_shipdate,2001-07-01T00:00" in " ".join(re.findall(r"PushedFilters: \[(.*?)\]", text)) and "NestedLoop" not in text


def test_bucketed_lines_are_not_shuffled_by_transaction(spark, settings, tmp_path):
    t = adapter_tables(spark, FOLDER)
    stored = bucketed(t, spark, "bucketed_test", str(tmp_path), 8)
    try:
        # The lists of accounts are small enough to be sent; the ledger isn't.
        for df in (
            validation.unbalanced_transactions(stored.details),
            validation.duplicate_parent_lines(stored.details),
            validation.header_amounts(stored.txns, stored.details),
        ):
            settings(spark__sql__autoBroadcastJoinThreshold="-1")
            text = plan(df)
            assert "Exchange" not in text and "Bucketed: true" in text, text
        found, expected = (
            sorted(map(tuple, validation.check_ledger(b.details, b.txns, b.accounts).violations.collect()), key=repr) for b in (stored, t)
        )
        assert found == expected
    finally:
        drop_bucketed(spark, "bucketed_test")
