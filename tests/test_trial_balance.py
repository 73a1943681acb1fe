from datetime import date, datetime

import pytest
from conftest import AS_OF, rows

from tallyspark.functions.dates import period_key
from tallyspark.operators import trial_balance as tb
from tallyspark.sources.sinks import write_period
from tallyspark.sources.staging import staging_path

LAST_YEAR, THIS_YEAR = datetime(2000, 6, 1), datetime(2001, 2, 1)


def entry(account="A1", day=THIS_YEAR, debit=None, credit=None, kind=1):
    return {
        "ThisAccountID": account,
        "TransactionDate": day,
        "DebitAmount": debit,
        "CreditAmount": credit,
        "MasterTransactionType": kind,
    }


def account(id="A1", kind=1):
    return {"AccountID": id, "AccountTypeID": kind}


TYPES = [{"AccountTypeID": t} for t in (1, 8)]


def accrual(frames, accounts, entries):
    return tb.trial_balance_accrual(frames.accounts(*accounts), frames.types(*TYPES), frames.summary(*entries), AS_OF)


def test_profit_and_loss_starts_with_the_year(frames):
    entries = [entry("A1", LAST_YEAR, debit=5), entry("A1", debit=2, credit=1)]
    entries += [entry("A8", LAST_YEAR, debit=5), entry("A8", credit=3), entry("A9", LAST_YEAR, debit=1)]
    result = accrual(frames, [account(), account("A8", 8), account("A9", 8)], entries)
    assert rows(result) == [("A1", 7.0, 1.0, 6.0), ("A8", 0.0, 3.0, -3.0)]


def test_what_does_not_count(frames):
    entries = [
        entry(debit=1),
        entry(debit=10, kind=46),
        entry(debit=100, kind=None),
        entry(debit=1000, day=datetime(1969, 12, 31)),
        entry("A2", debit=1),
        entry("A7", debit=1),
        entry(None, debit=1),
    ]
    # A2 has a type that is not listed and A7 is no account.
    assert rows(accrual(frames, [account(), account("A2", 99)], entries)) == [("A1", 1.0, 0.0, 1.0)]


def test_midnight_bound_excludes_later_that_day(frames):
    entries = [entry(debit=1, day=datetime(2001, 6, 30)), entry(debit=10, day=datetime(2001, 6, 30, 8))]
    assert rows(accrual(frames, [account()], entries), "Balance") == [(1.0,)]


def test_account_under_two_types_has_two_rows(frames):
    entries = [entry(day=LAST_YEAR, debit=5), entry(debit=2)]
    result = accrual(frames, [account(), account(kind=8)], entries)
    assert rows(result, "AccountID", "Balance") == [("A1", 2.0), ("A1", 7.0)]


def test_cash_keeps_every_type(frames):
    entries = [{"AccountID": "A1", "Date": date(2001, 2, 1), "DebitAmount": 4}]
    result = tb.trial_balance_cash(
        frames.accounts(account()), frames.types(*TYPES), frames.cash(*entries), "06/30/2001"
    )
    assert rows(result) == [("A1", 4.0)]


def test_history_before_1970_as_of(frames):
    """With an as-of year before the fixed start, profit-and-loss accounts still count from that year's January."""
    entries = [entry("A8", datetime(1969, 3, 1), debit=2), entry("A1", datetime(1969, 3, 1), debit=2)]
    result = tb.trial_balance_accrual(
        frames.accounts(account(), account("A8", 8)), frames.types(*TYPES), frames.summary(*entries), date(1969, 12, 31)
    )
    assert rows(result, "AccountID", "Balance") == [("A8", 2.0)]


@pytest.mark.parametrize("plug, others", [("A1", {"A2": -2.0}), ("3900", {"A1": 5.0, "A2": -2.0})])
def test_plug_brings_the_total_to_zero(frames, plug, others):
    base = frames.spark.createDataFrame(
        [("A1", 5, 0, 5), ("A2", 0, 2, -2)], "AccountID string, DebitAmount long, CreditAmount long, Balance long"
    )
    result = {r.AccountID: r for r in tb.with_plug(base, plug).collect()}
    assert set(result) == {"A1", "A2", plug}
    assert sum(r.Balance for r in result.values()) == 0
    assert {a: r.Balance for a, r in result.items() if a != plug} == others
    assert result["A1"].DebitAmount == 5
    assert rows(tb.zero_check(tb.with_plug(base, plug))) == [(0,)]


def test_plug_of_an_empty_table(frames):
    empty = frames.tb().select("AccountID", "Balance")
    assert rows(tb.with_plug(empty)) == [("3900", 0.0)]


def test_period_keys(spark):
    keys = spark.range(1).select(
        period_key(AS_OF), period_key("01/31/2019"), period_key(AS_OF, "yearly")
    )
    assert rows(keys) == [("200106", "201901", "2001")]
    with pytest.raises(ValueError):
        period_key(AS_OF, "weekly")


def test_rebuilding_a_period_leaves_the_others(frames):
    path = staging_path(frames.spark, "periods")
    one = frames.tb({"AccountID": "A1", "Balance": 1}).select("AccountID", "Balance")
    two = frames.tb({"AccountID": "A2", "Balance": 2}).select("AccountID", "Balance")
    write_period(tb.in_period(one, AS_OF, "A"), path, "200106", "A")
    write_period(tb.in_period(one, AS_OF, "C"), path, "200106", "C")
    write_period(tb.in_period(two, AS_OF, "A"), path, "200106", "A")
    stored = frames.spark.read.option("inferSchema", False).parquet(path)
    assert rows(stored, "basis", "AccountID", "Balance") == [("A", "A2", 2.0), ("C", "A1", 1.0)]
    write_period(one.limit(0), path, "200106", "A")
    stored = frames.spark.read.option("inferSchema", False).parquet(path)
    assert rows(stored, "basis", "AccountID", "Balance") == [("C", "A1", 1.0)]
    with pytest.raises(Exception, match="row of another basis than A"):
        write_period(tb.in_period(one, AS_OF, "C"), path, "200106", "A")
