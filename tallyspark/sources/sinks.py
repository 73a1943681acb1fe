"""Writers: rebuildable period tables, appends and journal batches. None of them loses columns or rows unasked."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.staging import staged

# Whole numbers by width, with their decimal digits.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _safe(kind: T.DataType, target: T.DataType) -> bool:
    """Whether every value of one type has the same value in the other."""
    if kind == target or isinstance(kind, T.NullType):
        return True
    digits = _WHOLE.get(type(kind))
    if digits and type(target) in _WHOLE:
        return digits <= _WHOLE[type(target)]
    if isinstance(target, T.DecimalType):
        if isinstance(kind, T.DecimalType):
            return kind.scale <= target.scale and kind.precision - kind.scale <= target.precision - target.scale
        return bool(digits) and digits <= target.precision - target.scale
    return isinstance(kind, T.FloatType) and isinstance(target, T.DoubleType)


def aligned(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``target``, in its order.

    Both must have the same column names, and each type must fit into the target's without loss, else it is an error.
    """
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in target}
    if len(have) != len(df.columns) or set(have) != set(want):
        extra, missing = sorted(set(have) - set(want)), sorted(set(want) - set(have))
        raise ValueError(f"columns differ from the target's: extra {extra}, missing {missing}, of {df.columns}")
    if unsafe := [f"{n}: {have[n].simpleString()} to {want[n].simpleString()}" for n in want if not _safe(have[n], want[n])]:
        raise ValueError(f"columns would lose values: {', '.join(unsafe)}")
    return df.select(*[F.col(f"`{n}`").cast(kind).alias(n) for n, kind in want.items()])


def write_period(tb: DataFrame, path: str, period: str, basis: str) -> None:
    """Rebuild one period and basis of a stored trial balance: what was there goes, also if ``tb`` has no rows.

    ``tb`` may carry ``period`` and ``basis``; a row of another period or basis is an error.
    """
    for name, value in (("period", period), ("basis", basis)):
        if name in tb.columns:
            other = F.concat(F.lit(f"row of another {name} than {value}: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
            same = F.col(name).cast("string").eqNullSafe(F.lit(value))
            tb = tb.filter(F.when(same, True).otherwise(F.raise_error(other).cast("boolean")))
    rows = tb.select(*[f"`{c}`" for c in tb.columns if c not in ("period", "basis")])
    rows.write.mode("overwrite").parquet(f"{path}/period={quote(period, safe='')}/basis={quote(basis, safe='')}")


def bulk_append(df: DataFrame, table: str) -> None:
    """Append every row to an existing catalog table whose columns ``df`` has, neither more nor fewer."""
    aligned(df, df.sparkSession.table(table).schema).write.mode("append").insertInto(table)


def bulk_append_path(df: DataFrame, path: str) -> None:
    """Append every row to a Parquet folder; if it holds a table, ``df`` must have that table's columns."""
    try:
        schema = df.sparkSession.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        schema = df.schema
    aligned(df, schema).write.mode("append").parquet(path)


def replace_batches(new: DataFrame, table: str, tags: list[str]) -> None:
    """Drop the tagged batches of a table partitioned by ``LastUpdatedBy`` and append their new rows.

    Only the partitions of the batches are touched, so the rest of a large ledger is neither read nor rewritten. A
    batch that comes out empty is dropped all the same; a row with another tag is an error. The new rows are checked and
    stored first, so they may be computed from the table itself. Dropping and appending are two steps and not one
    transaction: if the second fails, run it again.
    """
    spark = new.sparkSession
    rows = staged(aligned(new, spark.table(table).schema), "new_batches")
    if not rows.filter(~F.coalesce(F.col("LastUpdatedBy").isin(tags), F.lit(False))).isEmpty():
        raise ValueError(f"rows of other batches than {tags}")
    for tag in tags:
        quoted = tag.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (LastUpdatedBy = '{quoted}')")
    rows.write.mode("append").insertInto(table)
