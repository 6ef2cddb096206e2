"""Recording runs as they finish: the batch ingest over a stream of arriving result files.

Each micro-batch is projected exactly as in :mod:`modelspend.plans.ingest` and
committed as one batch that knows the files it came from
(:mod:`modelspend.sources.commits`).  A micro-batch that is run again, or a stream that
starts anew without its checkpoint, finds its files committed and adds nothing, so every
file is recorded once; rows appended by batch jobs stay readable beside it.
Nothing is aggregated, so the stream keeps no state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from modelspend import schemas as S
from modelspend.plans.ingest import ingest_executions, ingest_job_runs
from modelspend.sources.commits import SOURCE, commit_once


def _append_stream(
    spark: SparkSession,
    schema: T.StructType,
    project: Callable[[DataFrame], DataFrame],
    arriving: str,
    table: str,
    checkpoint: str,
) -> StreamingQuery:
    results = spark.readStream.schema(schema).json(arriving).select("*", F.col("_metadata.file_path").alias(SOURCE))

    def write(batch: DataFrame, number: int) -> None:
        commit_once(project(batch), table)

    return (
        results.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def record_executions(
    spark: SparkSession,
    arriving: str,
    table: str,
    checkpoint: str,
    schema: T.StructType = S.RUN_RESULTS,
    insert_timestamp: datetime | None = None,
) -> StreamingQuery:
    """Append the executions in new run result files (JSON lines) and stop when caught up."""
    project = partial(ingest_executions, insert_timestamp=insert_timestamp, carried=(SOURCE,))
    return _append_stream(spark, schema, project, arriving, table, checkpoint)


def record_job_runs(
    spark: SparkSession, arriving: str, table: str, checkpoint: str, schema: T.StructType = S.RUN_ENV
) -> StreamingQuery:
    """Append the job runs in new run environment files (JSON lines) and stop when caught up."""
    return _append_stream(spark, schema, partial(ingest_job_runs, carried=(SOURCE,)), arriving, table, checkpoint)
