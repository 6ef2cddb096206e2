"""Recording runs: from run results and run environments to tracking rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.functions.expressions import lit_timestamp
from modelspend.functions.run_ids import with_run_ids
from modelspend.functions.tracking_json import node_config_json, run_context_json

OWN_PACKAGES = ("modelspend",)


def or_null(value: Column) -> Column:
    """The text marker for a missing id as a real NULL."""
    return F.nullif(value, F.lit(S.NONE_MARKER))


def ingest_executions(
    results: DataFrame,
    insert_timestamp: datetime | None = None,
    own_packages: tuple[str, ...] = OWN_PACKAGES,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Tracking rows for run results: tracked commands and node types, own packages left out.

    Columns in ``carried`` are passed on as they are.
    """
    node = F.col("node")
    is_model = node["resource_type"] == "model"
    stamp = (
        lit_timestamp(insert_timestamp)
        if insert_timestamp is not None
        else F.current_timestamp().cast("timestamp_ntz")
    )
    kept = (
        F.col("command").isin(*S.TRACKED_COMMANDS)
        & node["resource_type"].isin(*S.TRACKED_RESOURCE_TYPES)
        & ~node["package_name"].isin(*own_packages)
    )
    return with_run_ids(results.filter(kept)).select(
        node["name"].alias("model_name"),
        node["unique_id"].alias("relation_name"),
        node["package_name"].alias("model_package"),
        F.when(is_model, node["config"]["materialized"]).otherwise(node["resource_type"]).alias("model_type"),
        "status",
        F.col("execution_time").cast("double").alias("execution_time"),
        "invocation_id",
        F.coalesce(F.col("adapter_response")["query_id"], F.lit(S.NONE_MARKER)).alias("query_id"),
        stamp.alias("insert_timestamp"),
        S.RUN_ID,
        S.JOB_ID,
        or_null(F.col(S.PROJECT_ID)).alias(S.PROJECT_ID),
        S.VERSION,
        "run_started_at",
        node_config_json(node, results.schema["node"].dataType).alias("node_config"),
        *carried,
    )


def ingest_job_runs(environments: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One tracking row per run environment, with its context as JSON; ``carried`` columns are passed on."""
    context = {key: F.col(key) for key in S.RUN_CONTEXT_KEYS}
    return with_run_ids(environments.filter(F.col("command").isin(*S.TRACKED_COMMANDS))).select(
        S.RUN_ID,
        S.JOB_ID,
        or_null(F.col(S.ENVIRONMENT_ID)).alias(S.ENVIRONMENT_ID),
        or_null(F.col(S.PROJECT_ID)).alias(S.PROJECT_ID),
        run_context_json(context).alias(S.RUN_CONTEXT),
        *carried,
    )
