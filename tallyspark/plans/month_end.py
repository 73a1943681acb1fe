"""The month-end job: trial balances, reconciliation, journals, checks and the comparison afterwards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import AsOf
from tallyspark.operators import journals, recheck, reconcile, trial_balance, validation
from tallyspark.operators.trial_balance import ACCRUAL, CASH, PLUG_ACCOUNT
from tallyspark.sources.staging import staged
from tallyspark.sources.tables import LedgerTables


@dataclass(frozen=True)
class MonthEnd:
    trial_balance: DataFrame
    reconciled: DataFrame
    headers: DataFrame
    details: DataFrame
    run_rebuild: Callable[[], DataFrame]
    run_checks: Callable[[], validation.Checked]

    @cached_property
    def rebuilt(self) -> DataFrame:
        """The trial balances with the journals booked, summed and stored when first asked for."""
        return self.run_rebuild()

    @cached_property
    def _checked(self) -> validation.Checked:
        return self.run_checks()

    @property
    def checks(self) -> DataFrame:
        """The result of each check; the checks run when this or ``violations`` is first asked for."""
        return self._checked.results

    @property
    def violations(self) -> DataFrame:
        """What breaks the checks."""
        return self._checked.violations


def trial_balances(tables: LedgerTables, as_of: AsOf, plug: str | None = PLUG_ACCOUNT) -> DataFrame:
    """Both bases as (basis, AccountID, Balance); with the plug unless ``plug`` is None."""
    by_basis = {
        ACCRUAL: trial_balance.trial_balance_accrual(tables.accounts, tables.account_types, tables.summary, as_of),
        CASH: trial_balance.trial_balance_cash(tables.accounts, tables.account_types, tables.cash_details, as_of),
    }
    parts = [
        (trial_balance.with_plug(tb, plug) if plug else tb).select(F.lit(basis).alias("basis"), "AccountID", "Balance")
        for basis, tb in by_basis.items()
    ]
    return parts[0].unionByName(parts[1])


def reconciled_extract(tables: LedgerTables, tb: DataFrame, extract: DataFrame | None = None) -> DataFrame:
    """Both extracts, or one frame of both with ``basis``, mapped to accounts, with balance and final balance."""
    if extract is None:
        extract = reconcile.by_basis(tables.extract_accrual, tables.extract_cash)
    extract = reconcile.drop_blank_rows(extract)
    mapped = reconcile.map_accounts(extract, tables.qb_accounts, tables.accounts)
    # Compared with the ledger and listed as seen, so stored once instead of mapped twice.
    return reconcile.final_balance(staged(reconcile.with_balance(mapped), "mapped"), tb)


def book(tables: LedgerTables, made: journals.Journals) -> LedgerTables:
    """The ledger with journal lines added to the sources of its trial balances.

    Hybrid and accrual lines enter the accrual source, hybrid and cash lines the cash source.
    """
    base = {s.suffix: s.base_code for s in journals.SPECS}
    header = made.headers.select(
        F.col("APTransactionID").alias("ApTransactionID"), F.col("TransactionType").alias("MasterTransactionType")
    )
    # At most one header per journal rule.
    lines = made.details.join(F.broadcast(header), "ApTransactionID")
    accrual = lines.filter(F.col("MasterTransactionType") != base["C"]).select(
        "ThisAccountID", "TransactionDate", "MasterTransactionType", "DebitAmount", "CreditAmount"
    )
    cash = lines.filter(F.col("MasterTransactionType") != base["A"]).select(
        F.col("ThisAccountID").alias("AccountID"),
        F.col("TransactionDate").alias("Date"),
        "DebitAmount",
        "CreditAmount",
    )
    return tables.replacing(
        summary=tables.summary.unionByName(accrual), cash_details=tables.cash_details.unionByName(cash)
    )


def month_end(
    tables: LedgerTables, as_of: AsOf, kind: str = "monthly", updated: AsOf = None, plug: str | None = PLUG_ACCOUNT
) -> MonthEnd:
    """Run the whole job. Frames read by several later steps are stored in the shared checkpoint folder.

    The returned frames are not yet in the ledger: write ``headers`` and ``details`` with ``sinks.replace_batches``.
    ``checks`` and ``violations`` are for the ledger as it is with them; a batch that has no rows is not among those checked.
    ``rebuilt``, ``checks`` and ``violations`` are each worked out when first asked for.
    The moment that ``as_of`` and ``updated`` stand for when they are None is read from the clock once.
    """
    now = datetime.now(timezone.utc)
    as_of, updated = now if as_of is None else as_of, now if updated is None else updated
    tb = staged(trial_balances(tables, as_of, plug), "trial_balance")
    compared = staged(reconciled_extract(tables, tb), "compared")
    final = staged(reconcile.hybrid_flag(compared), "reconciled")
    made = journals.generate_journals(final, as_of, kind, updated)
    made = journals.Journals(staged(made.headers, "headers"), staged(made.details, "details"))
    return MonthEnd(
        tb,
        final,
        made.headers,
        made.details,
        lambda: staged(trial_balances(book(tables, made), as_of, plug), "rebuilt"),
        lambda: ledger_checks(tables, made, as_of, kind),
    )


def comparison(result: MonthEnd) -> DataFrame:
    """What still differs after booking, as (issue, basis, AccountID, extract_balance, ledger_balance)."""
    extract, rebuilt = result.reconciled, result.rebuilt
    none = F.lit(None).cast("decimal(38,4)")

    def rows(df: DataFrame, issue: str, ours: str | None, theirs: str | None) -> DataFrame:
        return df.select(
            F.lit(issue).alias("issue"),
            "basis",
            "AccountID",
            (F.col(ours).cast("decimal(38,4)") if ours else none).alias("extract_balance"),
            (F.col(theirs).cast("decimal(38,4)") if theirs else none).alias("ledger_balance"),
        )

    return (
        rows(recheck.mismatch(extract, rebuilt), "mismatch", "Balance", "ledger_balance")
        .unionByName(rows(recheck.missing(extract, rebuilt, trim=True), "missing in ledger", "Balance", None))
        .unionByName(rows(recheck.missing(rebuilt, extract), "missing in extract", None, "Balance"))
    )


def ledger_checks(tables: LedgerTables, made: journals.Journals, as_of: AsOf, kind: str = "monthly") -> validation.Checked:
    """All eleven checks of the ledger with the period's batches replaced by new ones."""
    tags = journals.batch_tags(as_of, kind)
    details = journals.replace_batch(tables.details, made.details, tags)
    txns = journals.replace_batch(tables.txns, made.headers, tags)
    batches = made.headers.select("LastUpdatedBy")
    return validation.check_ledger(details, txns, tables.accounts, batches)
