"""Saving JSON messages as they arrive."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.ingest import KIND, RAW, JsonRecords, json_records

# The column, and folder, of a batch of messages.
BATCH = "batch_id"


class Saving(NamedTuple):
    """The two running queries."""

    records: StreamingQuery
    rejects: StreamingQuery

    def await_termination(self) -> None:
        self.records.awaitTermination()
        self.rejects.awaitTermination()


def save_messages(
    stream: DataFrame,
    column: str,
    schema: T.StructType | str,
    path: str,
    rejects: str,
    checkpoint: str,
    available_now: bool = False,
) -> Saving:
    """Start appending the typed records of a streaming text column to one Parquet folder and all other messages to another.

    Each folder has a query of its own with its own progress below ``checkpoint``, so that a restart goes on where it
    stopped and every message is saved once, in one of the two. The source is read twice for it.
    """
    parsed = json_records(stream, column, schema)

    def start(frame: DataFrame, folder: str, name: str) -> StreamingQuery:
        writer = (
            frame.writeStream.format("parquet")
            .outputMode("append")
            .option("path", folder)
            .option("checkpointLocation", f"{checkpoint}/{name}")
        )
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    return Saving(start(parsed.records, path, "records"), start(parsed.rejects, rejects, "rejects"))


def store_batch(batch: DataFrame, batch_id: int, column: str, schema: T.StructType | str, folder: str) -> None:
    """One batch of messages, read once: records and rejects below ``folder`` under the batch's id.

    A batch that is stored again replaces itself, so whatever failed before it counted leaves nothing behind.
    """
    parsed = json_records(batch, column, schema, split=False)
    parsed.write.mode("overwrite").partitionBy(KIND).parquet(f"{folder}/{BATCH}={batch_id}")


def save_batches(
    stream: DataFrame, column: str, schema: T.StructType | str, folder: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Start storing a streaming text column's records and rejects from a single read of its source.

    A restart goes on where it stopped, and a batch that is run again replaces what it had stored. ``saved`` reads both.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: store_batch(batch, batch_id, column, schema, folder)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def saved(spark: SparkSession, folder: str, fields: T.StructType) -> JsonRecords:
    """Records and rejects of all stored batches with the columns ``fields``, those of the record and of its message."""
    own = [f for f in fields if f.name not in (KIND, BATCH, RAW)]
    full = T.StructType([*own, T.StructField(RAW, T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField(KIND, T.StringType())])
    rows = spark.read.schema(full).option("basePath", folder).parquet(folder)
    return JsonRecords(rows.filter(F.col(KIND) == "record").drop(KIND, RAW), rows.filter(F.col(KIND) == "reject").drop(KIND))
