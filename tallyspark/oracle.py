"""SQL for an independent engine, one statement per query, over the same base tables.

Written from the meaning of each operator with plain joins and windows, without the rewrites the Spark side uses.
"""

from __future__ import annotations

from tallyspark.operators.trial_balance import PROFIT_AND_LOSS_TYPES
from tallyspark.sources.adapter import adapter_ctes

AS_OF = "date '2001-06-30'"
TODAY = "date '2001-07-15'"
YEAR_START = "date '2001-01-01'"
HISTORY = "date '1970-01-01'"
PL = f"({', '.join(map(str, PROFIT_AND_LOSS_TYPES))})"


def _m(expression: str) -> str:
    return f"cast({expression} as decimal(38,2))"


def _buckets(balance: str, number: str, date: str) -> str:
    bounds = {"current": "<= 30", "31-60": "between 31 and 60", "61-90": "between 61 and 90", ">90": "> 90"}
    return ",\n".join(
        f"""{_m(f"case when {number} not in ('Vendor Credit', 'GeneralJournalBalance')"
                f" and date_diff('day', {date}, {TODAY}) {test} then {balance} else 0 end")} as "{name}" """
        for name, test in bounds.items()
    )


def _settled(name: str, types: str, amount: str, extra: str) -> str:
    return f"""
{name} as (
    select b.VendorBillID, max(b.VendorID) PayeeID, sum({amount}) Paid
    from ap_transaction_details d
    join vendor_bill b on b.VendorBillID = d.VendorBillID
    join employee e on e.EmployeeID = b.VendorID
    join ap_transaction_table t on t.APTransactionID = d.ApTransactionID
    left join check_details c on c.APTransactionID = d.ApTransactionID and c.CheckDate <= {AS_OF}
    where d.TransactionType in ({types}) and d.TransactionDate <= {AS_OF} {extra}
    group by b.VendorBillID
)"""


AGING = f"""
line_accounts as (
    select VendorBillID, max(CreditAccountID) line_account
    from ap_transaction_details where TransactionType = 20 group by VendorBillID
),
bill_accounts as (
    select b.*, coalesce(b.APAccountID, l.line_account) APAccount
    from vendor_bill b left join line_accounts l using (VendorBillID)
),
billed_rows as (
    select b.VendorBillID, b.APAccount, b.VendorID PayeeID, b.BillDate, b.BillDueDate, b.BillNumber,
        sum(d.CreditAmount) Billed
    from bill_accounts b
    join ap_transaction_details d on d.VendorBillID = b.VendorBillID and d.TransactionType = 20
    where b.BillDate <= {AS_OF}
    group by all
),
{_settled("paid_rows", "4, -4", "coalesce(d.DebitAmount, 0)", "").strip()},
{_settled("discount_rows", "11", "d.DebitAmount", "and d.DebitAccountID is not null").strip()},
bill_sources as (
    select VendorBillID, APAccount, PayeeID, BillDate, BillDueDate, BillNumber, Billed, 0 Paid from billed_rows
    union all by name select VendorBillID, PayeeID, Paid from paid_rows
    union all by name select VendorBillID, PayeeID, Paid from discount_rows
),
bill_totals as (
    select VendorBillID, max(APAccount) APAccount, max(PayeeID) PayeeID, max(BillDate) BillDate,
        max(BillDueDate) BillDueDate, max(BillNumber) BillNumber, sum(coalesce(Billed, 0)) Billed, sum(Paid) Paid
    from bill_sources group by VendorBillID
),
drawn_credit as (
    select u.VendorBillID, h.PayeeID, d.TransactionDate, d.Ref, h.TransactionAmount, u.Amount
    from ap_transaction_table h
    join ap_transaction_details d
        on d.ApTransactionID = h.APTransactionID and d.TransactionType = 20 and d.TransactionDate <= {AS_OF}
    left join ap_credit_used u
        on u.BillCreditTransactionID = h.APTransactionID and u.TransactionDate <= {AS_OF}
    where h.TransactionType = 7
),
credit_by_bill as (
    select VendorBillID, PayeeID, max(TransactionDate) TransactionDate, max(Ref) Ref,
        sum(TransactionAmount) VendorCreditAmount, sum(Amount) creditused,
        sum(TransactionAmount - coalesce(Amount, 0)) CreditBalance
    from drawn_credit group by VendorBillID, PayeeID
),
credit_moves as (
    select PayeeID, ParentAccountID, TransactionDate, coalesce(TransactionAmount, 0) given, 0 used
    from ap_transaction_table where TransactionType = 7 and TransactionDate <= {AS_OF}
    union all
    select h.PayeeID, h.ParentAccountID, null, 0, coalesce(u.Amount, 0)
    from ap_transaction_table h
    join ap_transaction_details d on d.ApTransactionID = h.APTransactionID and d.TransactionType = 20
    join ap_credit_used u on u.BillCreditTransactionID = h.APTransactionID and u.TransactionDate <= {AS_OF}
    where h.TransactionType = 7
),
credit_rows as (
    select PayeeID, ParentAccountID APAccount, max(TransactionDate) BillDate, sum(used) - sum(given) Balance
    from credit_moves group by PayeeID, ParentAccountID
),
journal_rows as (
    select d.ThisAccountID APAccount, coalesce(d.AccountLineID, 'ZZZZ') PayeeID,
        sum(coalesce(d.CreditAmount, 0) - coalesce(d.DebitAmount, 0)) Balance
    from ap_transaction_details d
    join ap_transaction_table t on t.APTransactionID = d.ApTransactionID
    where t.TransactionType in (0, 5, 45) and t.TransactionDate <= {AS_OF}
        and exists (select 1 from account_list a where a.AccountID = d.ThisAccountID and a.AccountTypeID = 0)
    group by 1, 2
),
report_rows as (
    select b.VendorBillID, b.APAccount, b.PayeeID, b.BillDate, b.BillDueDate, b.BillNumber, b.Billed, b.Paid,
        coalesce(c.creditused, 0) CreditUsed, b.Paid + coalesce(c.creditused, 0) totalPaid,
        b.Billed - b.Paid - coalesce(c.creditused, 0) Balance
    from bill_totals b left join credit_by_bill c on c.VendorBillID = b.VendorBillID and c.PayeeID = b.PayeeID
    union all
    select null, APAccount, PayeeID, BillDate, null, 'Vendor Credit', 0, 0, 0, 0, Balance from credit_rows
    union all
    select null, APAccount, PayeeID, null, null, 'GeneralJournalBalance', 0, 0, 0, 0, Balance from journal_rows
)"""

_EXTRA_COLUMNS = f"""cast(null as string) VendorBillID, cast(null as date) BillDueDate,
    {_m("0")} Billed, {_m("0")} Paid, {_m("0")} CreditUsed, {_m("0")} totalPaid"""


def _balances(name: str, table: str, account: str, date: str, extra: str) -> str:
    return f"""
{name} as (
    select AccountID, sum(debit) DebitAmount, sum(credit) CreditAmount, sum(debit) - sum(credit) Balance
    from (
        select a.AccountID, a.AccountTypeID in {PL} pl, coalesce(s.DebitAmount, 0) debit,
            coalesce(s.CreditAmount, 0) credit, s.{date} d
        from {table} s
        join account_list a on a.AccountID = s.{account}
        join account_type_list k on k.AccountTypeID = a.AccountTypeID
        where s.{date} <= {AS_OF} {extra}
    )
    where d >= case when pl then {YEAR_START} else {HISTORY} end
    group by AccountID, pl
)"""


def _plugged(name: str, source: str, account: str) -> str:
    return f"""
{name} as (
    select AccountID, Balance - case when AccountID = '{account}' then (select sum(Balance) from {source}) else 0 end
        Balance
    from (
        select AccountID, Balance from {source}
        union all
        select '{account}', 0 where not exists (select 1 from {source} where AccountID = '{account}')
    )
)"""


BALANCES = ",".join(
    [
        _balances("accrual", "transaction_summary", "ThisAccountID", "TransactionDate", "and MasterTransactionType <> 46"),
        _balances("cash", "transaction_detail_cash", "AccountID", "Date", ""),
        _plugged("accrual_a39", "accrual", "A39"),
        _plugged("accrual_plugged", "accrual", "3900"),
        _plugged("cash_plugged", "cash", "3900"),
        """
tb as (
    select 'A' basis, AccountID, Balance from accrual_plugged
    union all select 'C', AccountID, Balance from cash_plugged
)""",
    ]
)


def _mapping(name: str, accounts: str) -> str:
    return f"""
{name} as (
    select x.basis, x.F2, x.Debit, x.Credit, q.ListID qblinkid, a.AccountID,
        coalesce(case when Debit <> 0 then Debit when Credit <> 0 then -Credit end, 0) Balance
    from extract x
    left join (select FullName, min(ListID) ListID from qb_account group by 1) q on q.FullName = x.label
    left join (select QBLinkID, min(AccountID) AccountID from {accounts} where QBLinkID is not null group by 1) a
        on a.QBLinkID = q.ListID
)"""


RECONCILE = ",".join(
    [
        """
extract as (
    select *, trim(substring(F2, strpos(F2, '·') + 1)) as label
    from (select 'A' basis, * from qb_tb_a union all select 'C', * from qb_tb_c)
)""",
        _mapping("mapped_all", "account_list"),
        """
mapped as (select * from mapped_all where F2 is not null),
compared as (
    select m.*, case when m.AccountID is null then 0 else m.Balance - coalesce(t.Balance, 0) end FinalBalance
    from mapped m left join tb t on t.basis = m.basis and t.AccountID = m.AccountID
    union all by name
    select basis, AccountID, -Balance FinalBalance
    from tb
    where Balance <> 0
        and not exists (select 1 from mapped m where m.basis = tb.basis and m.AccountID = tb.AccountID)
),
reconciled as (
    select c.*, case when FinalBalance <> 0 and exists (
        select 1 from compared o
        where o.basis <> c.basis and o.AccountID = c.AccountID and o.FinalBalance = c.FinalBalance
    ) then 'Hybrid' end JournalType
    from compared c
)""",
    ]
)


def _batch(suffix: str, basis: str, kind: str, base: int, first: str) -> str:
    """Bookings of one batch with its parent account, and the header amount before totalling."""
    credit_first = first == "credit"
    side = "FinalBalance < 0" if credit_first else "FinalBalance > 0"
    other = "FinalBalance > 0" if credit_first else "FinalBalance < 0"
    # Total of the parent side; the cash batch shows it positive, the others negated.
    on_first = f"sum(FinalBalance) filter ({side})"
    on_other = f"sum(FinalBalance) filter ({other})"
    amounts = {"HYB": ("-", "-"), "A": ("-", "-"), "C": ("", "-")}[suffix]
    return f"""
select 'CJ200106{suffix}' batch, {base} base,
    case when count(*) filter ({side}) > 0 then '{first}' else '{"debit" if credit_first else "credit"}' end parent_side,
    coalesce(max(trim(AccountID)) filter ({side}), max(trim(AccountID)) filter ({other})) parent,
    coalesce({amounts[0]}{on_first}, {amounts[1]}{on_other}) first_amount,
    count(*) filter (FinalBalance < 0) n_credit, count(*) filter (FinalBalance > 0) n_debit,
    coalesce(sum(FinalBalance), 0) difference
from reconciled where FinalBalance <> 0 and basis = '{basis}' and JournalType {kind}
having count(*) > 0"""


JOURNALS = f"""
batches as (
    {_batch("HYB", "C", "= 'Hybrid'", 5, "credit")}
    union all {_batch("A", "A", "is null", 45, "debit")}
    union all {_batch("C", "C", "is null", 46, "debit")}
),
bookings as (
    select b.*, trim(r.AccountID) account, r.FinalBalance
    from reconciled r
    join batches b on b.batch = case
        when r.basis = 'C' and r.JournalType = 'Hybrid' then 'CJ200106HYB'
        when r.basis = 'A' and r.JournalType is null then 'CJ200106A'
        when r.basis = 'C' and r.JournalType is null then 'CJ200106C' end
    where r.FinalBalance <> 0
),
codes as (
    select *,
        case when base = 5 or parent_side = 'credit' then 20 else base end credit_code,
        case when base = 5 or parent_side = 'credit' then base else 20 end debit_code
    from batches
),
credit_lines as (
    select k.batch, c.credit_code code, account, -FinalBalance credit, null debit
    from bookings k join codes c using (batch) where FinalBalance < 0
),
debit_lines as (
    select k.batch, c.debit_code code, account, null credit, FinalBalance debit
    from bookings k join codes c using (batch) where FinalBalance > 0
),
zero_lines as (
    select batch, debit_code code, 'BQ101' account, null credit, 0 debit from codes where base = 5 and n_debit = 0
    union all
    select batch, credit_code, 'BQ101', 0, null from codes where base <> 5 and n_credit = 0
),
adjustment_lines as (
    select batch, credit_code code, 'BQ101' account, difference credit, null debit from codes where difference <> 0
),
raw_lines as (
    select * from credit_lines union all select * from debit_lines
    union all select * from zero_lines union all select * from adjustment_lines
),
final_lines as (
    select l.batch, case when b.parent <> l.account then b.base else l.code end code, l.account, l.credit, l.debit, b.base
    from raw_lines l join batches b using (batch)
),
booked_summary as (
    select ThisAccountID, TransactionDate, MasterTransactionType, DebitAmount, CreditAmount from transaction_summary
    union all select account, {AS_OF}, base, debit, credit from final_lines where base <> 46
),
booked_cash as (
    select AccountID, Date, DebitAmount, CreditAmount from transaction_detail_cash
    union all select account, {AS_OF}, debit, credit from final_lines where base <> 45
),
{_balances("accrual_after", "booked_summary", "ThisAccountID", "TransactionDate", "and MasterTransactionType <> 46").strip()},
{_balances("cash_after", "booked_cash", "AccountID", "Date", "").strip()},
{_plugged("accrual_rebuilt", "accrual_after", "3900").strip()},
{_plugged("cash_rebuilt", "cash_after", "3900").strip()},
rebuilt as (
    select 'A' basis, AccountID, Balance from accrual_rebuilt
    union all select 'C', AccountID, Balance from cash_rebuilt
)"""


def _line(source: str, where: str = "") -> str:
    return f"""select batch LastUpdatedBy, code TransactionType, {AS_OF} TransactionDate,
    case when credit is not null then account end CreditAccountID, {_m("credit")} CreditAmount,
    case when debit is not null then account end DebitAccountID, {_m("debit")} DebitAmount,
    account ThisAccountID from {source} {where}"""


def _header(amount: str) -> str:
    return f"""select batch LastUpdatedBy, base TransactionType, {AS_OF} TransactionDate,
    {_m(amount)} TransactionAmount, parent ParentAccountID from batches"""


CHECKED_LINE = f"""ApTransactionID, TransactionType, ThisAccountID, CreditAccountID, DebitAccountID,
    {_m("CreditAmount")} CreditAmount, {_m("DebitAmount")} DebitAmount"""

_BROKEN = {
    2: "select 1 from ap_transaction_details where TransactionType = 20 group by ApTransactionID having count(*) > 1",
    3: "select 1 from ap_transaction_details having coalesce(sum(DebitAmount) - sum(CreditAmount) <> 0, true)",
    4: "select 1 from ap_transaction_details group by ApTransactionID having sum(DebitAmount) <> sum(CreditAmount)",
    5: """select 1 from ap_transaction_table t join (
        select ApTransactionID id, sum(DebitAmount) amt from ap_transaction_details group by 1
    ) d on d.id = t.APTransactionID where t.TransactionAmount <> d.amt and t.TransactionType <> 4""",
    6: "select 1 from ap_transaction_details where ThisAccountID is null",
    7: "select 1 from ap_transaction_details where ThisAccountID <> CreditAccountID",
    8: "select 1 from ap_transaction_details where ThisAccountID <> DebitAccountID",
    9: "select 1 from ap_transaction_details where ThisAccountID not in (select AccountID from account_list)",
    10: "select 1 from ap_transaction_table where ParentAccountID is null",
    11: "select 1 from ap_transaction_table where ParentAccountID not in (select AccountID from account_list)",
}
_CHECK_NAMES = {
    2: "chk_dup_parent_line",
    3: "chk_total_balanced",
    4: "chk_txn_balanced",
    5: "chk_header_amount",
    6: "chk_account_missing",
    7: "chk_credit_account",
    8: "chk_debit_account",
    9: "chk_account_known",
    10: "chk_parent_missing",
    11: "chk_parent_known",
}
_ALL_CHECKS = "\nunion all ".join(
    f"""select {n} check_no, '{_CHECK_NAMES[n]}' "check", case when count(*) = 0 then 'pass' else 'fail' end status,
    count(*) n_violations from ({sql}) v"""
    for n, sql in _BROKEN.items()
)

_TOTAL_COLUMNS = f"{_m('DebitAmount')} DebitAmount, {_m('CreditAmount')} CreditAmount, {_m('Balance')} Balance"
_BILL_TEXT = "VendorBillID, APAccount, PayeeID, BillDate, BillDueDate, BillNumber"
_COMPARED = f"basis, F2, {_m('Debit')} Debit, {_m('Credit')} Credit, {_m('Balance')} Balance, qblinkid, AccountID"


_LINE_RULES = {
    6: "ThisAccountID is null",
    7: "ThisAccountID <> CreditAccountID",
    8: "ThisAccountID <> DebitAccountID",
    9: "ThisAccountID not in (select AccountID from account_list)",
}
_TXN_RULES = {2: "count(*) filter (TransactionType = 20) > 1", 4: "sum(DebitAmount) <> sum(CreditAmount)"}
_HEADER_RULES = {
    5: """TransactionType <> 4 and TransactionAmount <> (
        select sum(DebitAmount) from ap_transaction_details d where d.ApTransactionID = t.APTransactionID)""",
    10: "ParentAccountID is null",
    11: "ParentAccountID not in (select AccountID from account_list)",
}
_VIOLATIONS = "select v.*, c.check from (" + "\nunion all ".join(
    [
        *(
            f"""select {n} check_no, ApTransactionID, ThisAccountID AccountID, count(*) n_rows
            from ap_transaction_details where {rule} group by all"""
            for n, rule in _LINE_RULES.items()
        ),
        *(
            f"select {n}, ApTransactionID, null, 1 from ap_transaction_details group by ApTransactionID having {rule}"
            for n, rule in _TXN_RULES.items()
        ),
        *(
            f"""select {n}, APTransactionID, ParentAccountID, count(*) from ap_transaction_table t where {rule}
            group by all"""
            for n, rule in _HEADER_RULES.items()
        ),
        """select 3, null, null, 1 where not coalesce(
            (select sum(DebitAmount) = sum(CreditAmount) from ap_transaction_details), false)""",
    ]
) + ") v join (values " + ", ".join(f"({n}, '{name}')" for n, name in _CHECK_NAMES.items()) + ") c(n, \"check\") on c.n = v.check_no"


def _left_over(extract: str, after: str) -> str:
    return f"""
select 'mismatch' issue, x.basis, x.AccountID, {_m("x.Balance")} extract_balance, {_m("t.Balance")} ledger_balance
from {extract} x join {after} t on t.basis = x.basis and t.AccountID = x.AccountID where x.Balance <> t.Balance
union all
select 'missing in ledger', basis, AccountID, {_m("Balance")}, null from {extract} x
where Balance <> 0 and AccountID is not null
    and not exists (select 1 from {after} t where t.basis = x.basis and trim(t.AccountID) = trim(x.AccountID))
union all
select 'missing in extract', basis, AccountID, null, {_m("Balance")} from {after} t
where Balance <> 0 and not exists (select 1 from {extract} x where x.basis = t.basis and x.AccountID = t.AccountID)"""


# Common table expressions a statement needs, and the statement itself.
# The ledger with the booked batches in it; a batch is its own transaction.
_BOOKED = """
booked_details as (
    select ApTransactionID, TransactionType, ThisAccountID, CreditAccountID, DebitAccountID, CreditAmount, DebitAmount
    from ap_transaction_details
    union all select batch, code, account, case when credit is not null then account end,
        case when debit is not null then account end, credit, debit from final_lines
),
booked_txns as (
    select APTransactionID, TransactionType, TransactionAmount, ParentAccountID from ap_transaction_table
    union all select batch, base, (select sum(debit) from final_lines l where l.batch = b.batch), parent from batches b
)"""

_MONTH_END_CHECKS = (
    _ALL_CHECKS.replace("ap_transaction_details", "booked_details").replace("ap_transaction_table", "booked_txns")
    + """
    union all select 1, 'chk_one_parent_line', case when count(*) = 0 then 'pass' else 'fail' end, count(*)
    from (select batch from batches left join final_lines l using (batch) group by batch having count(*) filter (l.code = 20) <> 1) x"""
)

_LEDGER: dict[str, tuple[list[str], str]] = {
    "ap_billed": ([AGING], f"select {_BILL_TEXT}, {_m('Billed')} Billed, {_m('0')} Paid from billed_rows"),
    "ap_account_fallback": ([AGING], "select VendorBillID, APAccount from bill_accounts"),
    "ap_payments": ([AGING], f"select VendorBillID, PayeeID, {_m('Paid')} Paid from paid_rows"),
    "ap_discounts": ([AGING], f"select VendorBillID, PayeeID, {_m('Paid')} Paid from discount_rows"),
    "ap_bill_balance": (
        [AGING],
        f"select {_BILL_TEXT}, {_m('Billed')} Billed, {_m('Paid')} Paid from bill_totals",
    ),
    "ap_bill_balance_steps": (
        [AGING],
        f"select {_BILL_TEXT}, {_m('Billed')} Billed, {_m('Paid')} Paid from bill_totals",
    ),
    "ap_credit_used": (
        [AGING],
        f"""select VendorBillID, PayeeID, TransactionDate, Ref, {_m("VendorCreditAmount")} VendorCreditAmount,
        {_m("creditused")} creditused, 'CreditBalance' "TYPE", {_m("CreditBalance")} CreditBalance
        from credit_by_bill""",
    ),
    "ap_vendor_credit": (
        [AGING],
        f"""select APAccount, PayeeID, BillDate, 'Vendor Credit' BillNumber, {_m("Balance")} Balance,
        {_EXTRA_COLUMNS} from credit_rows""",
    ),
    "ap_journal_balance": (
        [AGING],
        f"""select APAccount, PayeeID, cast(null as date) BillDate, 'GeneralJournalBalance' BillNumber,
        {_m("Balance")} Balance, {_EXTRA_COLUMNS} from journal_rows""",
    ),
    "ap_aging_buckets": (
        [AGING],
        f"""select VendorBillID, BillDate, {_m("Billed")} Balance, {_buckets("Billed", "BillNumber", "BillDate")}
        from billed_rows""",
    ),
    "ap_aging": (
        [AGING],
        f"""select r.VendorBillID, r.APAccount, a.AccountName, r.PayeeID, e.EmpFName, e.EmpMI, e.EmpLName,
        e.EmpCompany, e.IsSub, r.BillDate, r.BillDueDate, r.BillNumber, {_m("r.Billed")} Billed, {_m("r.Paid")} Paid,
        {_m("r.CreditUsed")} CreditUsed, {_m("r.totalPaid")} totalPaid, {_m("r.Balance")} Balance,
        {_buckets("r.Balance", "r.BillNumber", "r.BillDate")}
        from report_rows r
        left join employee e on e.EmployeeID = r.PayeeID
        left join account_list a on a.AccountID = r.APAccount
        where r.Balance <> 0
        order by r.PayeeID, r.VendorBillID, r.BillDate""",
    ),
    "tb_accrual": ([BALANCES], f"select AccountID, {_TOTAL_COLUMNS} from accrual"),
    "tb_cash": ([BALANCES], f"select AccountID, {_m('Balance')} Balance from cash"),
    "tb_plug": (
        [BALANCES],
        f"""select 'A' basis, AccountID, {_m("Balance")} Balance from accrual_a39
        union all select 'C', AccountID, {_m("Balance")} from cash_plugged""",
    ),
    "tb_zero_check": (
        [BALANCES],
        f"""select 'A' basis, false plugged, {_m("sum(Balance)")} TotalBalance from accrual
        union all select 'C', false, {_m("sum(Balance)")} from cash
        union all select basis, true, {_m("sum(Balance)")} from tb group by basis""",
    ),
    "tb_period": (
        [BALANCES],
        f"""select AccountID, {_m("Balance")} Balance, '200106' period, 'A' basis from accrual
        union all select AccountID, {_m("Balance")}, '2001', 'C' from cash""",
    ),
    "ensure_columns": (
        [BALANCES, RECONCILE],
        f"""select basis, F2, {_m("0")} Debit, {_m("Credit")} Credit, cast(null as string) qblinkid,
        cast(null as string) AccountID from extract""",
    ),
    "drop_blank_rows": (
        [BALANCES, RECONCILE],
        f"select basis, F2, {_m('Debit')} Debit, {_m('Credit')} Credit from extract where F2 is not null",
    ),
    "clean_label": ([BALANCES, RECONCILE], "select basis, F2, label from extract"),
    "map_accounts": ([BALANCES, RECONCILE], "select basis, F2, qblinkid, AccountID from mapped"),
    "unmapped_rows": (
        [BALANCES, RECONCILE],
        f"""select basis, F2, {_m("Debit")} Debit, {_m("Credit")} Credit, qblinkid
        from mapped where AccountID is null""",
    ),
    "control_totals": (
        [BALANCES, RECONCILE],
        f"""select basis, {_m("sum(Debit)")} Debit, {_m("sum(Credit)")} Credit,
        {_m("sum(FinalBalance)")} FinalBalance from compared group by basis""",
    ),
    "signed_balance": (
        [BALANCES, RECONCILE],
        f"""select basis, F2, {_m("Debit")} Debit, {_m("Credit")} Credit, {_m("Balance")} Balance
        from mapped_all""",
    ),
    "final_balance": (
        [BALANCES, RECONCILE],
        f"select {_COMPARED}, {_m('FinalBalance')} FinalBalance from compared",
    ),
    "extract_runs": (
        [BALANCES, RECONCILE],
        f"""select '0' run, basis, F2, null AccountID, {_m("null")} FinalBalance, null JournalType from extract
        union all select run, basis, F2, AccountID, {_m("FinalBalance")}, JournalType
        from reconciled, (values ('1'), ('2')) r(run)""",
    ),
    "duplicate_accounts": (
        [BALANCES, RECONCILE],
        "select basis, AccountID, count(*) n_rows from mapped group by all having count(*) > 1",
    ),
    "hybrid_flag": (
        [BALANCES, RECONCILE],
        f"select basis, F2, AccountID, {_m('FinalBalance')} FinalBalance, JournalType from reconciled",
    ),
    "suspect_links": (
        [
            BALANCES,
            RECONCILE,
            """
mistyped as (
    select * replace (
        case when AccountTypeID = 3 then QBLinkID else AccountID end as AccountID
    ) from account_list
)""",
            _mapping("mapped_mistyped", "mistyped"),
        ],
        "select basis, F2, qblinkid, AccountID from mapped_mistyped where qblinkid = AccountID",
    ),
    "journal_purge": (
        [BALANCES, RECONCILE, JOURNALS],
        f"""select case TransactionType when 5 then 'CJ200105HYB' end LastUpdatedBy, TransactionType, TransactionDate,
        CreditAccountID, {_m("CreditAmount")} CreditAmount, DebitAccountID, {_m("DebitAmount")} DebitAmount,
        ThisAccountID from ap_transaction_details where TransactionType <> 11
        union all {_line("final_lines")}""",
    ),
    "journal_header": ([BALANCES, RECONCILE, JOURNALS], _header("first_amount")),
    "journal_credit_lines": ([BALANCES, RECONCILE, JOURNALS], _line("credit_lines")),
    "journal_debit_lines": ([BALANCES, RECONCILE, JOURNALS], _line("debit_lines")),
    "journal_zero_lines": (
        [
            BALANCES,
            RECONCILE.replace("reconciled as (", "reconciled_both as (")
            + """,
reconciled as (
    select * replace (case when JournalType is null then abs(FinalBalance) else -abs(FinalBalance) end as FinalBalance)
    from reconciled_both
)""",
            JOURNALS,
        ],
        _line("zero_lines"),
    ),
    "journal_adjustment": ([BALANCES, RECONCILE, JOURNALS], _line("adjustment_lines")),
    "journal_header_amount": (
        [BALANCES, RECONCILE, JOURNALS],
        _header("(select sum(credit) from raw_lines l where l.batch = batches.batch)"),
    ),
    "journal_retype": ([BALANCES, RECONCILE, JOURNALS], _line("final_lines")),
    "journal_retype_steps": ([BALANCES, RECONCILE, JOURNALS], _line("final_lines")),
    "journal_line_ids": (
        [BALANCES, RECONCILE, JOURNALS],
        """select batch LastUpdatedBy, n_lines, n_lines n_ids from (
            select batch, 2 * (n_credit + n_debit) + case when difference <> 0 then 1 else 0 end
                + case when case when base = 5 then n_debit else n_credit end = 0 then 1 else 0 end n_lines from batches
        ) x""",
    ),
    "chk_one_parent_line": (
        [BALANCES, RECONCILE, JOURNALS],
        """select batch, count(*) filter (code = 20) n_lines, count(*) filter (code = 20) = 1 passed
        from final_lines group by batch""",
    ),
    "chk_dup_parent_line": (
        [],
        """select ApTransactionID, TransactionType, count(*) n_lines from ap_transaction_details
        where TransactionType = 20 group by all having count(*) > 1""",
    ),
    "chk_total_balanced": (
        [],
        f"""select {_m("sum(DebitAmount) - sum(CreditAmount)")} difference,
        coalesce(sum(DebitAmount) = sum(CreditAmount), false) passed from ap_transaction_details""",
    ),
    "chk_total_balanced_nulls": (
        [],
        f"""select {_m("sum(DebitAmount)")} difference, coalesce(sum(DebitAmount) = 0, false) passed
        from ap_transaction_details""",
    ),
    "chk_header_amount_credit": (
        [],
        f"""select t.APTransactionID, t.TransactionType, {_m("t.TransactionAmount")} TransactionAmount,
        {_m("d.amt")} amt from ap_transaction_table t
        join (select ApTransactionID id, sum(CreditAmount) amt from ap_transaction_details group by 1) d
            on d.id = t.APTransactionID
        where t.TransactionAmount <> d.amt and t.TransactionType <> 4""",
    ),
    "chk_txn_balanced": (
        [],
        f"""select ApTransactionID, {_m("sum(DebitAmount)")} DebitAmount, {_m("sum(CreditAmount)")} CreditAmount
        from ap_transaction_details group by ApTransactionID having sum(DebitAmount) <> sum(CreditAmount)""",
    ),
    "chk_header_amount": (
        [],
        f"""select t.APTransactionID, t.TransactionType, {_m("t.TransactionAmount")} TransactionAmount,
        {_m("d.amt")} amt from ap_transaction_table t
        join (select ApTransactionID id, sum(DebitAmount) amt from ap_transaction_details group by 1) d
            on d.id = t.APTransactionID
        where t.TransactionAmount <> d.amt and t.TransactionType <> 4""",
    ),
    "chk_account_missing": (
        [],
        f"select {CHECKED_LINE} from ap_transaction_details where ThisAccountID is null",
    ),
    "chk_credit_account": (
        [],
        f"select {CHECKED_LINE} from ap_transaction_details where ThisAccountID <> CreditAccountID",
    ),
    "chk_debit_account": (
        [],
        f"select {CHECKED_LINE} from ap_transaction_details where ThisAccountID <> DebitAccountID",
    ),
    "chk_account_known": (
        [],
        f"""select {CHECKED_LINE} from ap_transaction_details
        where ThisAccountID not in (select AccountID from account_list)""",
    ),
    "chk_parent_missing": (
        [],
        f"""select APTransactionID, TransactionType, {_m("TransactionAmount")} TransactionAmount
        from ap_transaction_table where ParentAccountID is null""",
    ),
    "chk_parent_known": (
        [],
        """select APTransactionID, TransactionType, ParentAccountID from ap_transaction_table
        where ParentAccountID not in (select AccountID from account_list)""",
    ),
    "chk_all": ([], _ALL_CHECKS),
    "chk_violations": ([], _VIOLATIONS),
    "mig_mismatch": (
        [BALANCES, RECONCILE],
        f"""select m.basis, m.AccountID, {_m("m.Balance")} Balance, {_m("t.Balance")} ledger_balance
        from mapped m join tb t on t.basis = m.basis and t.AccountID = m.AccountID where m.Balance <> t.Balance""",
    ),
    "mig_missing_in_ledger": (
        [BALANCES, RECONCILE],
        f"""select basis, AccountID, {_m("Balance")} Balance from mapped m
        where Balance <> 0 and AccountID is not null
            and not exists (select 1 from tb where tb.basis <> m.basis and tb.AccountID = m.AccountID)""",
    ),
    "mig_missing_in_extract": (
        [BALANCES, RECONCILE],
        f"""select basis, AccountID, {_m("Balance")} Balance from tb where Balance <> 0 and not exists (
            select 1 from mapped m where m.basis = tb.basis and m.AccountID = tb.AccountID
        )""",
    ),
    "mig_unbalanced": (
        [],
        f"""select {_m("sum(DebitAmount) - sum(CreditAmount)")} difference, ApTransactionID
        from ap_transaction_details group by ApTransactionID having sum(DebitAmount) - sum(CreditAmount) <> 0""",
    ),
    "month_end": (
        [BALANCES, RECONCILE, JOURNALS],
        f"select basis, AccountID, {_m('Balance')} Balance from rebuilt",
    ),
    "month_end_checks": ([BALANCES, RECONCILE, JOURNALS, _BOOKED], _MONTH_END_CHECKS),
    "month_end_left_over": ([BALANCES, RECONCILE, JOURNALS], _left_over("reconciled", "rebuilt")),
}

# The same results by other ways: an SQL function, tables in the catalog, files.
_LEDGER |= {
    "ap_aging_sql": _LEDGER["ap_aging"],
    "chk_violations_bucketed": _LEDGER["chk_violations"],
    "tb_switch": _LEDGER["tb_period"],
    "journal_switch": _LEDGER["journal_purge"],
    "journal_purge_files": _LEDGER["journal_purge"],
}

_LOADING = {
    "conform_to_metadata": """select c_custkey, c_name, c_nationkey,
        cast(cast(c_acctbal as decimal(13,2)) as decimal(38,2)) c_acctbal from customer""",
    "null_violations": """select 'c_custkey' "column", count(*) filter (c_custkey is null) n_nulls from customer
        union all select 'c_name', count(*) filter (c_name is null or c_custkey % 11 = 0) from customer""",
    "key_violations_chosen": """select 'marked' keys, count(*) n_keys, sum(n)::bigint n_rows
            from (select count(*) n from customer group by c_custkey having count(*) > 1 or c_custkey is null)
        union all select 'first', count(*), sum(n)::bigint
            from (select count(*) n from customer group by c_name, c_nationkey having count(*) > 1 or c_name is null or c_nationkey is null)
        union all select 'places', count(*), sum(n)::bigint
            from (select count(*) n from customer group by c_mktsegment, c_nationkey having count(*) > 1 or c_mktsegment is null or c_nationkey is null)
        union all select 'none', 0, null""",
    "key_violations": """select l_orderkey, l_linenumber, count(*) n_rows from lineitem group by all
        having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
    "conform_frame": """select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as real) o_totalprice,
        cast(o_orderdate as timestamp) o_orderdate, o_orderpriority from orders""",
    "staging_table": """select row_number() over (order by conv_id, turn) rowID, cast(conv_id as string) column1,
        cast(turn as string) column2, role column3, "text" column4, cast(null as string) column5, cast(null as string) column6
        from conversations""",
    "bulk_append": "select * from customer union all select * replace (-c_acctbal as c_acctbal) from customer",
    "load_once": """select *, 'first' load_id, 4 n_tried, 2 n_added from customer
        union all select * replace (-c_acctbal as c_acctbal), 'second', 4, 2 from customer""",
    "load_keys": """select case when c_nationkey < 15 then 'west' else 'east' end load_id, 'row' kind, c_custkey from customer
        union all select 'twice', 'inside', c_custkey from customer where c_nationkey >= 15
        union all select 'over', 'stored', c_custkey from customer where c_nationkey between 10 and 14""",
    "json_records": """select event_id, is_record, case when is_record then cast(regexp_extract(props, '\\d+') as int) end k,
        case when not is_record then raw end raw
        from (
            select event_id, props, event_id % 9 not between 1 and 5 is_record, case event_id % 9 when 1 then null when 2 then ''
                when 3 then '  ' when 4 then replace(props, '}', '') when 5 then props || ' junk' end raw from events
        ) x""",
}

ORACLES: dict[str, str] = {
    name: ",\n".join([adapter_ctes(), *(part.strip() for part in ctes)]) + "\n" + statement
    for name, (ctes, statement) in _LEDGER.items()
} | _LOADING
