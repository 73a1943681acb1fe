"""Taking rows out of a Parquet folder that isn't partitioned by what tells them, without rewriting the rest.

Only the files that hold such a row are written anew, each beside the folder's own files and then moved over the old one
in one step. A reader that opens a file finds it with the rows or without them, and all other files stay as they are. A
purge that broke off is run again: the files that are done hold none of the rows any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.sinks import bulk_append_path
from tallyspark.sources.staging import staged


def _path(spark: SparkSession, name: str) -> object:
    """A path from what ``_metadata.file_path`` gives, in which odd characters are escaped."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))


def _move_over(spark: SparkSession, new: object, old: object) -> None:
    """Moves a file over another in one step, on file systems whose renames are such."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context.rename(new, old, overwrite)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        names.append(name)
    return names


def holding_files(rows: DataFrame, condition: Column) -> DataFrame:
    """The files of a frame read from files that hold a row for which ``condition`` is true, as ``file``."""
    return rows.filter(condition).select(F.col("_metadata.file_path").alias("file")).distinct()


def purge_files(spark: SparkSession, path: str, condition: Column) -> int:
    """Remove the rows for which ``condition`` is true, not NULL, from a folder of Parquet files; the number of files written anew.

    The folder is not partitioned. The condition reaches the scan as a filter, so files whose statistics exclude it are
    not read at all. The driver sees the names of the files that hold such rows. On object stores a move is a copy, and
    a reader may find the old file a while longer.
    """
    rows = spark.read.parquet(path)
    names = sorted(r["file"] for r in holding_files(rows, condition).collect())
    if not names:
        return 0
    aside = f"{path.rstrip('/')}/_purge-{uuid.uuid4().hex}"
    own = spark.read.schema(rows.schema).parquet(*[_path(spark, n).toString() for n in names])
    kept = own.filter(~F.coalesce(condition, F.lit(False)))
    # A file's rows go to a task of their own and hence one new file, part k for file k. They are written as they come,
    # since neither the task nor the writer sorts them, so memory doesn't grow with the file.
    file, number = fresh(rows, "file", "number")
    numbers = spark.createDataFrame(list(zip(names, range(len(names)))), f"{file} string, {number} int")
    # As many rows as the driver has names.
    dealt = kept.withColumn(file, F.col("_metadata.file_path")).join(F.broadcast(numbers), file)
    dealt = dealt.repartitionById(len(names), F.col(number)).select(*[f"`{c}`" for c in rows.columns])
    dealt.write.option("maxRecordsPerFile", 0).parquet(aside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = [f.getPath() for f in files.listStatus(hadoop.Path(aside)) if f.getPath().getName().startswith("part-")]
    parts = {int(path.getName().split("-")[1]): path for path in new}
    for k, name in enumerate(names):
        if k not in parts:
            # No row is left of the file.
            folder = f"{aside}/empty-{k}"
            rows.limit(0).coalesce(1).write.parquet(folder)
            found = files.listStatus(hadoop.Path(folder))
            (parts[k],) = [f.getPath() for f in found if f.getPath().getName().startswith("part-")]
        _move_over(spark, parts[k], _path(spark, name))
    files.delete(hadoop.Path(aside), True)
    return len(names)


def replace_batches_in_files(new: DataFrame, path: str, tags: list[str], column: str = "LastUpdatedBy") -> int:
    """Take the tagged batches out of a folder and append their new rows; the number of files written anew.

    The new rows are stored first, so they may be computed from the folder itself. Taking out and appending are two
    steps: if this breaks off, run it again with the same rows.
    """
    rows = staged(new, "new_batches")
    n = purge_files(new.sparkSession, path, F.col(column).isin(tags))
    bulk_append_path(rows, path)
    return n
