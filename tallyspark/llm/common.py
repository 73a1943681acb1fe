"""Words of a text as every operator here counts them, and small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that part words, U+0020 and U+0009 to U+000D. ``bytes.split()`` parts at the same ones.
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order, as an array; empty for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` doesn't have, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
