"""Ledger tables derived from a star schema (parts, suppliers, orders and line items), for trials without a ledger.

Each table is one SQL query in words both Spark and other engines read the same way. Names in braces are other tables.
On Spark the two trial balances come from the library instead of their queries, which join every entry with its account.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.trial_balance import trial_balance_accrual, trial_balance_cash
from tallyspark.sources.tables import LedgerTables

BASE_TABLES = ("part", "supplier", "orders", "lineitem")

_BALANCE = "cast(sum(coalesce(DebitAmount,0))-sum(coalesce(CreditAmount,0)) as decimal(18,2))"
_PL = "a.AccountTypeID in (8,6,15,14,3)"
_START = f"case when {_PL} then date '2001-01-01' else date '1970-01-01' end"


def _extract(table: str, divisor: int, change: int) -> str:
    return f"""
        select F2, case when b>0 then b end Debit, case when b<0 then -b end Credit
        from (
            select
                case when k % 97 <> 0 then cast(k as string)||' · '||nm||' ' end F2,
                Balance + case when k % 13=0 then 100 else 0 end + case when k % {divisor}=0 then {change} else 0 end b
            from (
                select cast(substring(t.AccountID,2) as int) k, Balance, p_name||' '||cast(p_partkey as string) nm
                from {{{table}}} t join {{part}} on 'A'||cast(p_partkey as string)=t.AccountID
            ) x
            where k % 11 <> 0
        ) y"""


VIEWS = {
    "account_list": """
        select
            'A'||cast(p_partkey as string) AccountID,
            p_name AccountName,
            p_size % 16 AccountTypeID,
            case when p_partkey % 40 <> 7 then 'Q'||cast(p_partkey as string) end QBLinkID
        from {part}""",
    "account_type_list": """
        select distinct p_size % 16 AccountTypeID from {part} where p_size % 16 <> 9""",
    "employee": """
        select
            'V'||cast(s_suppkey as string) EmployeeID,
            'F'||cast(s_suppkey as string) EmpFName,
            cast(null as string) EmpMI,
            s_name EmpLName,
            s_name EmpCompany,
            s_nationkey % 2 = 0 IsSub
        from {supplier}
        where s_suppkey % 20 <> 3""",
    "vendor_bill": """
        select
            'B'||cast(o_orderkey as string) VendorBillID,
            'V'||cast(o_custkey % (select count(*) from {supplier}) as string) VendorID,
            case when o_orderkey % 10 <> 0 then 'A'||cast(o_orderkey % 50 as string) end APAccountID,
            cast(o_orderdate as date) BillDate,
            cast(cast(o_orderdate as date) + interval '30' day as date) BillDueDate,
            'INV-'||cast(o_orderkey as string) BillNumber
        from {orders}""",
    "ap_transaction_table": """
        select
            'T'||cast(o_orderkey as string) APTransactionID,
            case o_orderkey % 8 when 0 then 7 when 1 then 5 when 2 then 0 when 3 then 45 when 4 then 46 else 4
                end TransactionType,
            cast(o_orderdate as date) TransactionDate,
            cast(o_totalprice as decimal(18,2)) TransactionAmount,
            'V'||cast(o_custkey % (select count(*) from {supplier}) as string) PayeeID,
            case when o_orderkey % 100 = 98 then 'X1'
                when o_orderkey % 100 <> 99 then 'A'||cast(o_orderkey % 50 as string) end ParentAccountID,
            cast(null as string) LastUpdatedBy
        from {orders}""",
    "ap_transaction_details": """
        select
            ApTransactionID,
            VendorBillID,
            ty TransactionType,
            TransactionDate,
            case when is_cr then acct end CreditAccountID,
            case when is_cr then amt end CreditAmount,
            case when not is_cr and not (ty = 11 and l_returnflag = 'N') then acct end DebitAccountID,
            case when not is_cr then amt end DebitAmount,
            case when l_quantity=50 then null when l_quantity=49 then 'X0' else acct end ThisAccountID,
            case when l_returnflag='A' then 'V'||cast(l_suppkey as string) end AccountLineID,
            cast(null as string) Ref,
            cast(null as string) LastUpdatedBy
        from (
            select *, ty = 20 or (ty in (5,45) and l_returnflag='R') is_cr
            from (
                select
                    'T'||cast(l_orderkey as string) ApTransactionID,
                    'B'||cast(l_orderkey as string) VendorBillID,
                    case l_linenumber when 1 then 20 when 5 then 20 when 2 then 4 when 3 then -4 when 4 then 11
                        when 6 then 5 else 45 end ty,
                    cast(l_shipdate as date) TransactionDate,
                    cast(l_extendedprice as decimal(18,2)) amt,
                    'A'||cast(l_partkey % 50 as string) acct,
                    l_returnflag, l_suppkey, l_quantity
                from {lineitem}
            ) a
        ) b""",
    "check_details": """
        select 'T'||cast(o_orderkey as string) APTransactionID, cast(o_orderdate as date) CheckDate
        from {orders} where o_orderkey % 3 = 0
        union all
        select 'T'||cast(o_orderkey as string), cast(o_orderdate as date)
        from {orders} where o_orderkey % 9 = 0""",
    "ap_credit_used": """
        select
            'T'||cast(l_orderkey as string) BillCreditTransactionID,
            'B'||cast(l_orderkey as string) VendorBillID,
            cast(l_shipdate as date) TransactionDate,
            cast(l_quantity as decimal(18,2)) Amount
        from {lineitem}""",
    "transaction_summary": """
        select
            'A'||cast(l_partkey as string) ThisAccountID,
            cast(l_shipdate as date) TransactionDate,
            case when l_linenumber=7 then 46 when l_linenumber<>6 then l_linenumber end MasterTransactionType,
            case when l_returnflag='A' then cast(l_extendedprice as decimal(18,2)) end DebitAmount,
            case when l_returnflag<>'A' then cast(l_extendedprice as decimal(18,2)) end CreditAmount
        from {lineitem}""",
    "transaction_detail_cash": """
        select
            'A'||cast(l_partkey as string) AccountID,
            cast(l_shipdate as date) Date,
            case when l_returnflag='A' then cast(l_extendedprice as decimal(18,2)) end DebitAmount,
            case when l_returnflag<>'A' then cast(l_extendedprice as decimal(18,2)) end CreditAmount
        from {lineitem}
        where l_linestatus='F'""",
    "qb_account": """
        select 'Q'||cast(p_partkey as string) ListID, p_name||' '||cast(p_partkey as string) FullName
        from {part}
        where p_partkey % 60 <> 5""",
    "tb_accrual": f"""
        select a.AccountID, {_BALANCE} Balance
        from {{account_list}} a
        join {{transaction_summary}} s on a.AccountID=s.ThisAccountID
        join {{account_type_list}} t on a.AccountTypeID=t.AccountTypeID
        where TransactionDate >= {_START} and TransactionDate <= date '2001-06-30' and MasterTransactionType <> 46
        group by a.AccountID, {_PL}""",
    "tb_cash": f"""
        select a.AccountID, {_BALANCE} Balance
        from {{account_list}} a
        join {{transaction_detail_cash}} s on a.AccountID=s.AccountID
        join {{account_type_list}} t on a.AccountTypeID=t.AccountTypeID
        where Date >= {_START} and Date <= date '2001-06-30'
        group by a.AccountID, {_PL}""",
    "qb_tb_a": _extract("tb_accrual", 17, 50),
    "qb_tb_c": _extract("tb_cash", 19, -70),
}


# Fixed value: the day up to which the queries of the trial balances sum.
_AS_OF = date(2001, 6, 30)
# Trial balances by operators that sum entries per account before any join: builder and entries.
_SUMMED = {
    "tb_accrual": (trial_balance_accrual, "transaction_summary"),
    "tb_cash": (trial_balance_cash, "transaction_detail_cash"),
}


class StarLedger:
    """The derived tables over the Parquet files ``<folder>/<base table>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in BASE_TABLES:
                self._built[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            elif name in _SUMMED:
                build, entries = _SUMMED[name]
                summed = build(self.table("account_list"), self.table("account_type_list"), self.table(entries), _AS_OF)
                self._built[name] = summed.select("AccountID", F.col("Balance").cast("decimal(18,2)").alias("Balance"))
            else:
                used = [n for n in (*BASE_TABLES, *VIEWS) if f"{{{n}}}" in VIEWS[name]]
                self._built[name] = self._spark.sql(VIEWS[name], **{n: self.table(n) for n in used})
        return self._built[name]


def adapter_tables(spark: SparkSession, folder: str) -> LedgerTables:
    return LedgerTables(StarLedger(spark, folder).table)


def adapter_ctes() -> str:
    """The derived tables as common table expressions, for another engine holding the base tables."""
    names = {n: n for n in (*BASE_TABLES, *VIEWS)}
    return "with " + ",\n".join(f"{name} as ({text.format_map(names)})" for name, text in VIEWS.items())
