"""Loads into catalog tables that happen whole or not at all, and batches that are replaced without a gap.

New rows are written aside first, into a folder of their own below the table's, which no reader looks into. One change
in the catalog then names that folder as the location of a partition: a reader that lists the table before it sees the old
rows, one after it the new ones. If anything fails before, nothing has changed but a folder that nobody reads.

The catalog's partitions are the log of what has been committed, so a load that is repeated finds itself there and adds
nothing. Folders that were replaced stay for readers that still have them; remove them as your retention rules say.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.ingest import key_violations
from tallyspark.sources.sinks import aligned

# The partition column that names a row's load.
LOAD = "load_id"
# Buckets of a table of keys. A load's keys are dealt to as many tasks; the stored keys stay where they are.
KEY_BUCKETS = 64
_EXISTS = "PARTITIONS_ALREADY_EXIST"


class KeyClash(ValueError):
    """A load was refused: key values that it repeats or leaves NULL, and those that the table has already."""

    def __init__(self, table: str, load_id: str, inside: DataFrame, stored: DataFrame) -> None:
        super().__init__(f"load {load_id} refused: its keys clash in itself or with {table}")
        self.inside, self.stored = inside, stored


def _run(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(statement)


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(values: Mapping[str, str]) -> str:
    return f"PARTITION ({', '.join(f'`{name}` = {_literal(value)}' for name, value in values.items())})"


def create_partitioned(spark: SparkSession, table: str, schema: T.StructType, by: list[str], path: str | None = None) -> None:
    """An empty catalog table partitioned by ``by``, in ``path`` or where the warehouse puts it."""
    writer = spark.createDataFrame([], schema).write.format("parquet").partitionBy(*by)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def table_folder(spark: SparkSession, table: str) -> str:
    """Where the catalog has the table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"].rstrip("/")


def committed(spark: SparkSession, table: str, values: Mapping[str, str]) -> bool:
    """Whether the table has the partition."""
    return bool(_run(spark, f"SHOW PARTITIONS {table} {_partition(values)}").take(1))


def _columns(spark: SparkSession, table: str, values: Mapping[str, str]) -> T.StructType:
    return T.StructType([f for f in spark.table(table).schema if f.name not in values])


def _aside(spark: SparkSession, table: str) -> str:
    return f"{table_folder(spark, table)}/_aside/{uuid.uuid4().hex}"


def _show(spark: SparkSession, table: str, values: Mapping[str, str], path: str, replace: bool) -> None:
    """The one step that makes a folder part of the table. Without ``replace`` an error if the partition is there."""
    if replace and committed(spark, table, values):
        _run(spark, f"ALTER TABLE {table} {_partition(values)} SET LOCATION {_literal(path)}")
    else:
        _run(spark, f"ALTER TABLE {table} ADD {_partition(values)} LOCATION {_literal(path)}")
    spark.catalog.refreshTable(table)


def switch_partition(rows: DataFrame, table: str, values: Mapping[str, str]) -> None:
    """Replace one partition of a table by ``rows``, which may be none, in one step.

    ``rows`` has the table's other columns, neither more nor fewer, and may be computed from the table itself.
    """
    spark = rows.sparkSession
    path = _aside(spark, table)
    aligned(rows, _columns(spark, table, values)).write.parquet(path)
    _show(spark, table, values, path, replace=True)


def switch_period(tb: DataFrame, table: str, period: str, basis: str) -> None:
    """Rebuild one period and basis of a stored trial balance partitioned by both; readers never miss it.

    ``tb`` may carry ``period`` and ``basis``; a row of another period or basis is an error.
    """
    for name, value in (("period", period), ("basis", basis)):
        if name in tb.columns:
            other = F.concat(F.lit(f"row of another {name} than {value}: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
            same = F.col(name).cast("string").eqNullSafe(F.lit(value))
            tb = tb.filter(F.when(same, True).otherwise(F.raise_error(other).cast("boolean"))).drop(name)
    switch_partition(tb, table, {"period": period, "basis": basis})


def switch_batches(new: DataFrame, table: str, tags: list[str], column: str = "LastUpdatedBy") -> None:
    """Replace the tagged batches of a table partitioned by ``column``, each in one step and all after all are written.

    A batch without new rows becomes empty; a row with another tag is an error. The rest of the table is neither read nor
    written. ``new`` may be computed from the table itself.
    """
    spark = new.sparkSession
    rows = aligned(new, spark.table(table).schema)
    place = F.array_position(F.array(*map(F.lit, tags)), F.col(column))
    message = F.concat(F.lit("row of another batch: "), F.coalesce(F.col(column), F.lit("NULL")))
    path, batch = _aside(spark, table), "batch"
    while batch in rows.columns:
        batch += "_"
    known = F.when(F.coalesce(place, F.lit(0)) > 0, place).otherwise(F.raise_error(message).cast("long"))
    rows.withColumn(batch, known).drop(column).write.partitionBy(batch).parquet(path)
    written = {r[0] for r in spark.read.schema(f"`{batch}` long").parquet(path).distinct().collect()}
    nothing = spark.createDataFrame([], _columns(spark, table, {column: ""}))
    for k in range(1, len(tags) + 1):
        if k not in written:
            nothing.write.parquet(f"{path}/{batch}={k}")
    for k, tag in enumerate(tags, start=1):
        _show(spark, table, {column: tag}, f"{path}/{batch}={k}", replace=True)


def append_once(df: DataFrame, table: str, load_id: str) -> bool:
    """Add all rows of ``df`` as the load ``load_id``, or none: False if the table has that load already.

    The table is partitioned by ``LOAD``; ``df`` has its other columns, neither more nor fewer. If this fails the table is
    as before and the load can be run again.
    """
    spark, values = df.sparkSession, {LOAD: load_id}
    if committed(spark, table, values):
        return False
    path = _aside(spark, table)
    aligned(df, _columns(spark, table, values)).write.parquet(path)
    return _commit(spark, table, values, path)


def _commit(spark: SparkSession, table: str, values: Mapping[str, str], path: str) -> bool:
    try:
        _show(spark, table, values, path, replace=False)
    except AnalysisException as error:
        # The same load ran twice at once, and the other was first.
        if error.getCondition() != _EXISTS:
            raise
        return False
    return True


def ensure_stored_columns(spark: SparkSession, table: str, columns: Mapping[str, str], value: object = None) -> list[str]:
    """Add the columns that a table lacks, whatever their case, and return them; no file is written anew.

    Rows stored before read ``value`` there, as do rows that leave the column out later. A column that is there stays as
    it is: resetting it is a step to new rows, see ``plans.extract_runs``.
    """
    have = {c.lower() for c in spark.table(table).columns}
    missing = [name for name in columns if name.lower() not in have]
    if missing:
        default = "" if value is None else f" DEFAULT {_literal(value) if isinstance(value, str) else value}"
        listed = ", ".join(f"`{name}` {columns[name]}{default}" for name in missing)
        _run(spark, f"ALTER TABLE {table} ADD COLUMNS ({listed})")
        spark.catalog.refreshTable(table)
    return missing


def committed_loads(spark: SparkSession, table: str) -> list[str]:
    """The loads that a table has, as its partitions in the catalog say."""
    return [unquote(r["partition"].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _key_table(table: str) -> str:
    return f"{table}_keys"


def create_keyed(
    spark: SparkSession, table: str, schema: T.StructType, keys: list[str], path: str | None = None, buckets: int = KEY_BUCKETS
) -> None:
    """A table for loads whose key columns must be unique, and beside it a table of its keys, bucketed by them."""
    create_partitioned(spark, table, T.StructType([*schema, T.StructField(LOAD, T.StringType())]), [LOAD], path)
    empty = spark.createDataFrame([], schema).select(*[f"`{k}`" for k in keys]).withColumn(LOAD, F.lit(None).cast("string"))
    writer = empty.write.format("parquet").partitionBy(LOAD).bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", f"{path.rstrip('/')}_keys")).saveAsTable(_key_table(table))


def stored_clashes(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """The key values of ``rows`` that committed loads have.

    The stored keys lie in buckets, so only the load's own keys are shuffled to them. Keys of a load that never
    committed don't count: they lie in partitions that are not read.
    """
    spark = rows.sparkSession
    stored = spark.table(_key_table(table)).filter(F.col(LOAD).isin(committed_loads(spark, table)))
    return rows.select(*[f"`{k}`" for k in keys]).join(stored.drop(LOAD), keys, "left_semi").distinct()


def append_keyed(df: DataFrame, table: str, load_id: str, keys: list[str]) -> bool:
    """``append_once`` into a table made by ``create_keyed``: a load that breaks the key is refused whole by ``KeyClash``.

    Its keys must be there, differ among each other and from those of the table. Run one load at a time into a table:
    two at once don't see each other's keys.
    """
    spark, values = df.sparkSession, {LOAD: load_id}
    if committed(spark, table, values):
        return False
    path, columns = _aside(spark, table), _columns(spark, table, values)
    aligned(df, columns).write.parquet(path)
    rows = spark.read.schema(columns).parquet(path)
    inside, stored = key_violations(rows, keys), stored_clashes(rows, table, keys)
    if not inside.isEmpty() or not stored.isEmpty():
        raise KeyClash(table, load_id, inside, stored)
    bucketing = spark.sql(f"DESCRIBE TABLE EXTENDED {_key_table(table)}").filter("col_name = 'Num Buckets'")
    buckets = int(bucketing.first()["data_type"])
    listed = rows.select(*[f"`{k}`" for k in keys]).repartition(buckets, *keys).withColumn(LOAD, F.lit(load_id))
    # Appended before the rows are shown: a key too many of a failed load doesn't count, one too few would.
    writer = listed.write.format("parquet").mode("append").partitionBy(LOAD).bucketBy(buckets, *keys).sortBy(*keys)
    folder = table_folder(spark, _key_table(table))
    writer.option("path", folder).saveAsTable(_key_table(table))
    return _commit(spark, table, values, path)
