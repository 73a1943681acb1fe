import tempfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

AS_OF = date(2001, 6, 30)


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="tallyspark-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{work}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


class Frames:
    """Small ledger tables: rows given as dicts, missing columns NULL."""

    COLUMNS = {
        "bills": "VendorBillID string, VendorID string, APAccountID string, BillDate date, BillDueDate date,"
        " BillNumber string",
        "details": "ApTransactionID string, VendorBillID string, TransactionType int, TransactionDate date,"
        " CreditAccountID string, CreditAmount decimal(18,2), DebitAccountID string, DebitAmount decimal(18,2),"
        " ThisAccountID string, AccountLineID string, Ref string, LastUpdatedBy string",
        "txns": "APTransactionID string, TransactionType int, TransactionDate date, TransactionAmount decimal(18,2),"
        " PayeeID string, ParentAccountID string, LastUpdatedBy string",
        "checks": "APTransactionID string, CheckDate date",
        "uses": "BillCreditTransactionID string, VendorBillID string, TransactionDate date, Amount decimal(18,2)",
        "employees": "EmployeeID string, EmpFName string, EmpMI string, EmpLName string, EmpCompany string,"
        " IsSub boolean",
        "accounts": "AccountID string, AccountName string, AccountTypeID int, QBLinkID string",
        "types": "AccountTypeID int",
        "summary": "ThisAccountID string, TransactionDate timestamp, MasterTransactionType int,"
        " DebitAmount decimal(18,2), CreditAmount decimal(18,2)",
        "cash": "AccountID string, Date date, DebitAmount decimal(18,2), CreditAmount decimal(18,2)",
        "qb": "ListID string, FullName string",
        "extract": "basis string, F2 string, Debit decimal(18,2), Credit decimal(18,2)",
        "mapped": "basis string, F2 string, Debit decimal(18,2), Credit decimal(18,2), qblinkid string,"
        " AccountID string, Balance decimal(19,4)",
        "tb": "basis string, AccountID string, Balance decimal(19,4)",
        "final": "basis string, F2 string, AccountID string, FinalBalance decimal(19,4), JournalType string",
    }

    def __init__(self, spark):
        self.spark = spark

    def __getattr__(self, table):
        schema = self.COLUMNS[table]
        names = [c.split()[0] for c in schema.replace("decimal(18,2)", "d").replace("decimal(19,4)", "d").split(",")]
        kinds = dict(zip(names, [c.split()[1] for c in schema.replace("(18,2)", "").replace("(19,4)", "").split(",")]))

        def value(row, name):
            v = row.get(name)
            return Decimal(str(v)) if v is not None and kinds[name] == "decimal" else v

        def make(*rows):
            for row in rows:
                assert set(row) <= set(names), set(row) - set(names)
            return self.spark.createDataFrame([tuple(value(r, n) for n in names) for r in rows], schema)

        return make


@pytest.fixture()
def frames(spark):
    return Frames(spark)


def rows(df, *columns):
    """Sorted rows as plain tuples, decimals as numbers."""
    names = columns or df.columns

    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    return sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
