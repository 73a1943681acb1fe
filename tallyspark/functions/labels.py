"""Text and balance expressions used on extracted trial balances, and key collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark between account number and account name in an extract label.
LABEL_SEPARATOR = "·"


def clean_label(label: Column | str) -> Column:
    """Text after the first separator, without outer spaces; the whole text if there is none."""
    col = F.col(label) if isinstance(label, str) else label
    start = F.instr(col, LABEL_SEPARATOR) + 1
    return F.trim(F.substring(col, start, F.length(col)))


def signed_balance(debit: Column | str = "Debit", credit: Column | str = "Credit") -> Column:
    """A non-zero debit, else a non-zero credit negated, else 0."""
    dr = F.col(debit) if isinstance(debit, str) else debit
    cr = F.col(credit) if isinstance(credit, str) else credit
    return F.coalesce(F.when(dr != 0, dr).when(cr != 0, -cr), F.lit(0))


def collate_keys(df: DataFrame, columns: list[str], collation: str = "UTF8_LCASE_RTRIM") -> DataFrame:
    """Give text keys a collation, by default one that ignores case and trailing spaces.

    Keys compare byte by byte unless this is applied to every frame that shares them.
    """
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})
