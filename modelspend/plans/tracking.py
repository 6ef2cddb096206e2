"""The two tracking relations every report starts from."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.sources.tables import reconciled


def tracking_union(tables: Iterable[DataFrame]) -> DataFrame:
    """All execution logs as one relation; duplicates are kept.

    Older logs may lack columns, which are NULL then, and hold narrower types; a
    type that does not fit raises an error instead of losing values in the union.
    """
    return reduce(DataFrame.unionByName, [reconciled(table, S.EXECUTIONS, S.EXECUTION_KEYS) for table in tables])


def dedup_job_runs(job_runs: DataFrame) -> DataFrame:
    """One row per run, environment and project."""
    return job_runs.select(S.RUN_ID, S.ENVIRONMENT_ID, S.PROJECT_ID).distinct()


def eligible_executions(executions: DataFrame, id_column: str) -> DataFrame:
    """Executions that a fact may use: they have a real id and are not the tracker's own model."""
    return executions.filter(
        F.col(id_column).isNotNull()
        & (F.col(id_column) != S.NONE_MARKER)
        & (F.col("model_name") != S.IGNORED_MODEL)
    )
