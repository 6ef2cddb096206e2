"""Ids of a run, derived once for what is recorded and for what is written into its statements.

A run outside the hosted scheduler has neither a run nor a job id.  Its run id is then
its start to the millisecond and its job id its invocation id, in the tracking rows
and in the statements' comments alike, or the two would never meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend import schemas as S

RUN_ID_FORMAT = "yyyyMMdd_HHmmss_SSS"  # fixed value: run start, to the millisecond


def run_id(given: Column, run_started_at: Column) -> Column:
    return F.coalesce(given, F.date_format(run_started_at, RUN_ID_FORMAT))


def job_id(given: Column, invocation_id: Column) -> Column:
    return F.coalesce(given, invocation_id)


def with_run_ids(df: DataFrame) -> DataFrame:
    """Fill the run and job id of rows that have ``run_started_at`` and ``invocation_id``."""
    return df.withColumns(
        {
            S.RUN_ID: run_id(F.col(S.RUN_ID), F.col("run_started_at")),
            S.JOB_ID: job_id(F.col(S.JOB_ID), F.col("invocation_id")),
        }
    )
