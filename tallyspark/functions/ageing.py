"""Age buckets of open bills."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.dates import AsOf, as_of_column

# Bill numbers of the rows that carry a balance but no age, and the report's bucket names with their
# lowest and highest age in days.
CREDIT_ROW = "Vendor Credit"
JOURNAL_ROW = "GeneralJournalBalance"
BUCKETS = {
    "current": (None, 30),
    "31-60": (31, 60),
    "61-90": (61, 90),
    ">90": (91, None),
}


def bucket_columns(
    today: AsOf = None, date: str = "BillDate", number: str = "BillNumber", balance: str = "Balance"
) -> dict[str, Column]:
    """One column per bucket: the balance in the bucket of the bill's age, 0 in the others.

    A missing bill date or bill number has no bucket, since comparing it is unknown.
    """
    days = F.datediff(as_of_column(today), F.col(date))
    aged = ~F.col(number).isin(CREDIT_ROW, JOURNAL_ROW)
    columns = {}
    for name, (low, high) in BUCKETS.items():
        inside = aged
        if low is not None:
            inside = inside & (days >= low)
        if high is not None:
            inside = inside & (days <= high)
        columns[name] = F.when(inside, F.col(balance)).otherwise(F.lit(0))
    return columns
