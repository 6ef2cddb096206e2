"""Upsert and versioned history of stored tables, which write only the parts that change.

Tables are Parquet folders in buckets of their key.  A run finds the buckets that its
source rows fall into, at most ``buckets`` numbers, reads those partitions of the stored table
only, and replaces them with dynamic partition overwrite from a stored copy of their new
content.  All other files stay as they are.

A run that failed may be repeated with the same source: what it did before is found done.  The
upsert's high-water mark is stored last, so a repeated run sees the same fresh rows;
closed versions are committed once under the run's name.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.operators.history import VALID_TO, snapshot_by_check, snapshot_by_timestamp
from modelspend.sources.commits import append_once, committed_rows, has_plain_files

BUCKET = "bucket"
BUCKETS = 64
MARK = "_mark"

Stage = Callable[[DataFrame], DataFrame]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows with their ``bucket``; None before the first run."""
    return spark.read.parquet(path) if has_plain_files(spark, path) else None


def touched(rows: DataFrame) -> list[int]:
    """The buckets that ``rows`` fall into: at most as many numbers as there are buckets."""
    return sorted(r[BUCKET] for r in rows.select(BUCKET).distinct().collect())


def replace_buckets(rows: DataFrame, path: str, stage: Stage) -> None:
    """Write ``rows``, the whole new content of their buckets, from a stored copy; other buckets keep their files."""
    stored = stage(rows)
    stored.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _read_text(spark: SparkSession, path: str) -> str | None:
    rows = spark.read.text(path).collect() if has_plain_files(spark, path) else []
    return rows[0][0] if rows else None


def upsert_stored(
    spark: SparkSession, path: str, source: DataFrame, key: str, ts: str, stage: Stage, buckets: int = BUCKETS
) -> list[int]:
    """Insert the source rows above the stored mark of ``ts``, or replace their key; returns the buckets written.

    The first run, and any run on a table without a mark, takes all rows.  Rows
    without ``ts`` are never fresh after the first run.
    """
    mark = _read_text(spark, f"{path}/{MARK}/value")
    fresh = source.withColumn(BUCKET, bucket_of([key], buckets))
    if mark is not None:
        fresh = fresh.filter(F.col(ts) > F.lit(json.loads(mark)).cast(source.schema[ts].dataType))
    fresh = stage(fresh)
    written = touched(fresh)
    if not written:
        return []
    target = read_buckets(spark, path)
    rows = fresh
    if target is not None:
        kept = target.filter(F.col(BUCKET).isin(written)).join(fresh.select(key), key, "left_anti")
        rows = kept.select(*fresh.columns).unionByName(fresh)
    replace_buckets(rows, path, stage)
    highest = fresh.agg(F.max(F.col(ts)).cast("string").alias("value")).first()[0]
    if highest is not None:
        value = spark.createDataFrame([(json.dumps(highest),)], "value string")
        value.coalesce(1).write.mode("overwrite").text(f"{path}/{MARK}/value")
    return written


def history_paths(path: str) -> tuple[str, str]:
    """Where open and closed versions are stored."""
    return f"{path.rstrip('/')}/open", f"{path.rstrip('/')}/closed"


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions of a stored history; None before the first run."""
    opened, closed = history_paths(path)
    current, past = read_buckets(spark, opened), committed_rows(spark, closed)
    if current is None:
        return past
    current = current.drop(BUCKET)
    return current if past is None else current.unionByName(past)


def _snapshot_stored(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    run: str,
    versions: Callable[[DataFrame, DataFrame], DataFrame],
    valid_type: str,
    stage: Stage,
    buckets: int,
) -> list[int]:
    opened, closed = history_paths(path)
    source = stage(source.withColumn(BUCKET, bucket_of(keys, buckets)))
    columns = [c for c in source.columns if c != BUCKET]
    written = touched(source)
    if not written:
        return []
    current = read_buckets(spark, opened)
    if current is None:
        empty = source.limit(0).drop(BUCKET)
        mine = empty.select(*columns, *[F.lit(None).cast(valid_type).alias(c) for c in ("valid_from", VALID_TO)])
    else:
        mine = current.filter(F.col(BUCKET).isin(written)).select(*columns, "valid_from", VALID_TO)
    after = stage(versions(mine, source.drop(BUCKET)))
    append_once(after.filter(F.col(VALID_TO).isNotNull()), closed, run)
    now_open = after.filter(F.col(VALID_TO).isNull()).withColumn(BUCKET, bucket_of(keys, buckets))
    replace_buckets(now_open, opened, stage)
    return written


def snapshot_stored_by_timestamp(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str | Sequence[str],
    updated_at: str,
    run: str,
    stage: Stage,
    buckets: int = BUCKETS,
) -> list[int]:
    """:func:`~modelspend.operators.history.snapshot_by_timestamp` of a stored history; returns the buckets written.

    Closed versions are appended under the name ``run`` and never read again by later runs.  A
    failed run is repeated with the same name and source.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kind = source.schema[updated_at].dataType.simpleString()
    step = lambda history, rows: snapshot_by_timestamp(history, rows, keys, updated_at)
    return _snapshot_stored(spark, path, source, keys, run, step, kind, stage, buckets)


def snapshot_stored_by_check(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str | Sequence[str],
    check_columns: Sequence[str],
    now: datetime,
    run: str,
    stage: Stage,
    buckets: int = BUCKETS,
) -> list[int]:
    """:func:`~modelspend.operators.history.snapshot_by_check` of a stored history, as by timestamp."""
    keys = [key] if isinstance(key, str) else list(key)
    step = lambda history, rows: snapshot_by_check(history, rows, keys, check_columns, now)
    return _snapshot_stored(spark, path, source, keys, run, step, "timestamp_ntz", stage, buckets)
