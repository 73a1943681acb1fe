"""Conforming frames to a described schema, checking keys, staging text rows and parsing JSON records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.types import column_type, runtime_name
from tallyspark.sources.staging import staged

_CORRUPT = "_corrupt_record"
# Columns of a reject's text, and of whether a row is a record or a reject.
RAW = "raw"
KIND = "kind"
# monotonically_increasing_id puts the partition number above this many bits of position.
_POSITION_BITS = 33

MetaRows = Iterable[Mapping[str, Any]]


def metadata_schema(meta_rows: MetaRows) -> T.StructType:
    """Schema from column descriptions, in their order.

    Each needs ``ColumnName`` and ``DataType``. ``IsHidden`` columns are left out, ``AllowDBNull`` false means not
    null; without these flags a column is visible and nullable.
    """
    return T.StructType(
        [
            T.StructField(row["ColumnName"], column_type(row["DataType"]), _flag(row, "AllowDBNull", True))
            for row in meta_rows
            if not _flag(row, "IsHidden", False)
        ]
    )


def _flag(row: Mapping[str, Any], name: str, default: bool) -> bool:
    value = row.get(name)
    return default if value is None else bool(value)


def conform_to_metadata(df: DataFrame, meta_rows: MetaRows) -> DataFrame:
    """The described columns of ``df``, cast to the described types in one projection."""
    schema = metadata_schema(meta_rows)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def null_violations(df: DataFrame, meta_rows: MetaRows) -> DataFrame:
    """Number of NULLs in each column described as not null, in one pass over the frame."""
    required = [f.name for f in metadata_schema(meta_rows) if not f.nullable]
    if not required:
        return df.sparkSession.createDataFrame([], "column string, n_nulls bigint")
    counts = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("n_nulls")) for c in required
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def key_columns(meta_rows: MetaRows, keys: int | Iterable[int] | None = None) -> list[str]:
    """Key column names: the first ``keys`` columns, the columns at the given places, or those marked ``IsKey``."""
    rows = list(meta_rows)
    places = range(keys) if isinstance(keys, int) else list(keys or [])
    if places:
        return [rows[i]["ColumnName"] for i in places]
    return [row["ColumnName"] for row in rows if _flag(row, "IsKey", False)]


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are repeated or have a NULL part, with their number of rows; none if no key is declared."""
    if not keys:
        return df.sparkSession.createDataFrame([], "n_rows bigint")
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(f"`{key}`").isNull()
    counted = df.groupBy(*[f"`{k}`" for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | has_null)


def conform_frame(df: DataFrame) -> DataFrame:
    """Every column of ``df`` cast to the type a load uses for it."""
    return df.select(
        *[F.col(f"`{f.name}`").cast(column_type(runtime_name(f.dataType))).alias(f.name) for f in df.schema]
    )


def _staged_text(column: Column, width: int | None) -> Column:
    text = column.cast("string")
    if width is None:
        return text
    message = F.concat(F.lit(f"text longer than {width}: "), text)
    return F.when(F.length(text) > width, F.raise_error(message)).otherwise(text)


def to_staging(df: DataFrame, n: int, order_by: list[str | Column], width: int | None = None) -> DataFrame:
    """``rowID`` from 1 without gaps in the given order, and text columns ``column1..n`` with the columns of ``df``.

    Whole texts are kept. With a ``width`` a longer text is an error, as in a load into columns of that width. Columns
    beyond those of ``df`` are NULL; fewer than it has is an error.

    Rows are range-sorted and stored once with their place inside their partition; a row's id is that place plus the
    sizes of the partitions before it. The stored copy keeps partition and place the same for counting and numbering,
    even if an executor is lost in between. The running total is over one row per partition, never over the data.

    Rows alike in ``order_by`` are further sorted by a hash of their text and the partition they come from, so that
    even a great many of them, copies included, spread over several ranges.
    """
    if n < len(df.columns):
        raise ValueError(f"{n} staging columns cannot hold the {len(df.columns)} columns {df.columns}")
    columns = [_staged_text(F.col(f"`{c}`"), width).alias(f"column{i}") for i, c in enumerate(df.columns, start=1)]
    columns += [F.lit(None).cast("string").alias(f"column{i}") for i in range(len(df.columns) + 1, n + 1)]
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    tied = df.withColumns({"_row": F.xxhash64(*columns), "_from": F.spark_partition_id()})
    stored = staged(
        tied.orderBy(*order_by, "_row", "_from").select(
            F.spark_partition_id().alias("_part"), position.alias("_place"), *columns
        ),
        "numbered_rows",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    row_id = F.col("_offset") + F.col("_place") + 1
    return stored.join(F.broadcast(offsets), "_part").select(
        row_id.alias("rowID"), *[f"column{i}" for i in range(1, len(columns) + 1)]
    )


class JsonRecords(NamedTuple):
    records: DataFrame
    rejects: DataFrame


def json_records(df: DataFrame, column: str, schema: T.StructType | str, split: bool = True) -> JsonRecords | DataFrame:
    """Typed records from a JSON text column, and the rows that could not be read as such, with their text as ``raw``.

    Each row is in exactly one of the two. A record is one JSON object with nothing after it whose fields have the given
    types; fields it lacks are NULL. NULL and blank texts, several objects, an array, text after the object and values
    of another type are rejected. Other columns are kept. Works on streaming frames too. Without ``split`` both are one
    frame, in which ``KIND`` says which is which, the fields of a reject are NULL, and so is ``RAW`` of a record.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col(f"`{column}`")
    parsed = df.withColumn(
        "_json", F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    )
    # The parser stops at the end of the first value; in brackets, whatever follows it breaks the list or lengthens it.
    alone = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1
    good = F.ltrim(text).startswith("{") & F.col(f"_json.{_CORRUPT}").isNull() & alone
    parsed = parsed.withColumn("_good", F.coalesce(good, F.lit(False)))
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    if not split:
        kind = F.when(F.col("_good"), F.lit("record")).otherwise(F.lit("reject"))
        of_record = [F.when(F.col("_good"), F.col(f"_json.`{f.name}`")).alias(f.name) for f in fields]
        return parsed.select(*others, *of_record, F.when(~F.col("_good"), text).alias(RAW), kind.alias(KIND))
    return JsonRecords(
        parsed.filter("_good").select(*others, *[F.col(f"_json.`{f.name}`") for f in fields]),
        parsed.filter("not _good").select(*others, text.alias(RAW)),
    )
