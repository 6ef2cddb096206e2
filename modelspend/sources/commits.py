"""Appending each source exactly once to a tracking folder, whole batches at a time.

A batch is written below ``_batches`` in the table's folder, which Spark's own
listing skips, and becomes visible with one marker file below ``_commits``.  The
batch also holds the names of the sources its rows came from.  A later batch leaves
out the rows of sources that a committed batch has, so running a job again, losing a
stream's checkpoint or starting a new one neither repeats rows nor overwrites
any; an attempt that fails before its marker was never there.

One writer at a time may commit to a table; readers need no coordination.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
BATCHES = "_batches"
ROWS = "rows"
SOURCES = "sources"
#: The column that names the source of a row while a batch is written.
SOURCE = "_source"


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, one level deep; nothing if there is no such folder."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def committed(spark: SparkSession, table: str) -> list[str]:
    """Folders of the committed batches of a table."""
    table = table.rstrip("/")
    return [f"{table}/{BATCHES}/{name}" for name in _names(spark, f"{table}/{COMMITS}")]


def committed_rows(spark: SparkSession, table: str) -> DataFrame | None:
    """All rows of the committed batches as one scan; None without any."""
    folders = committed(spark, table)
    return spark.read.parquet(*[f"{f}/{ROWS}" for f in folders]).drop(SOURCE) if folders else None


def has_plain_files(spark: SparkSession, table: str) -> bool:
    """Does the folder hold anything that Spark's listing sees?"""
    return any(name[0] not in "_." for name in _names(spark, table))


def uncommitted(rows: DataFrame, table: str) -> DataFrame:
    """The rows whose source no committed batch has."""
    spark = rows.sparkSession
    folders = committed(spark, table)
    if not folders:
        return rows
    known = spark.read.parquet(*[f"{f}/{SOURCES}" for f in folders])
    return rows.join(known, SOURCE, "left_anti")


def commit_once(rows: DataFrame, table: str) -> str | None:
    """Append those rows whose source, in column ``_source``, is not committed yet.

    Returns the batch's folder, None if there was nothing to append.  Rows without a
    source are refused: they could not be recognised again.
    """
    spark, table = rows.sparkSession, table.rstrip("/")
    name = uuid.uuid4().hex
    batch = f"{table}/{BATCHES}/{name}"
    named = F.when(F.col(SOURCE).isNull(), F.raise_error(F.lit("a row has no source")).cast("string")).otherwise(F.col(SOURCE))
    uncommitted(rows.withColumn(SOURCE, named), table).write.parquet(f"{batch}/{ROWS}")
    written = spark.read.schema(rows.schema).parquet(f"{batch}/{ROWS}").select(SOURCE).distinct()
    if written.isEmpty():
        delete_folder(spark, batch)
        return None
    written.write.parquet(f"{batch}/{SOURCES}")
    marker, system = _folder(spark, f"{table}/{COMMITS}/{name}")
    system.create(marker, False).close()
    return batch


def append_once(rows: DataFrame, table: str, batch: str) -> str | None:
    """Append ``rows`` under a name of the caller's; a second call with that name appends nothing."""
    return commit_once(rows.withColumn(SOURCE, F.lit(batch)), table)


def drop_uncommitted(spark: SparkSession, table: str) -> int:
    """Delete what failed attempts left; run it while nothing writes.  Returns how many batches went."""
    table = table.rstrip("/")
    kept = {f.rsplit("/", 1)[1] for f in committed(spark, table)}
    left = [name for name in _names(spark, f"{table}/{BATCHES}") if name not in kept]
    for name in left:
        delete_folder(spark, f"{table}/{BATCHES}/{name}")
    return len(left)
