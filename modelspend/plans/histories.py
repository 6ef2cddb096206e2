"""Scans of the query histories: filters first, then only the columns a fact uses.

Filters are plain column comparisons, so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelspend.config import Settings
from modelspend.functions.expressions import (
    lit_timestamp,
    mentions,
    ms_to_hours,
    ms_to_seconds,
    preview,
    second_boundaries_between,
    to_naive_utc,
)

# How statements start that node-time costs leave out (any letter case).
UTILITY_STATEMENTS = ("COMMIT", "BEGIN", "FETCH", "SET", "INSERT INTO ")
LAST_SYSTEM_USER = 1


def usage_history(history: DataFrame, settings: Settings) -> DataFrame:
    """Finished statements with their compute resource and duration."""
    return history.filter(
        (F.col("start_time") >= lit_timestamp(settings.monitor_start))
        & (F.col("execution_status") == "FINISHED")
    ).select(
        "statement_id",
        "executed_by",
        "client_application",
        "start_time",
        "end_time",
        "execution_duration_ms",
        ms_to_seconds(F.col("execution_duration_ms")).alias("execution_seconds"),
        ms_to_hours(F.col("execution_duration_ms")).alias("execution_hours"),
        F.col("compute.cluster_id").alias("cluster_id"),
        F.col("compute.warehouse_id").alias("warehouse_id"),
        F.col("compute.type").alias("compute_type"),
        "workspace_id",
        "read_rows",
        "read_bytes",
        "produced_rows",
        "written_bytes",
        preview(F.col("statement_text")).alias("query_preview"),
        F.col("statement_text").alias("query_text"),
    )


def billing_usage(usage: DataFrame, settings: Settings) -> DataFrame:
    return usage.filter(F.col("usage_start_time") >= lit_timestamp(settings.monitor_start))


def credit_history(history: DataFrame, settings: Settings) -> DataFrame:
    """Statements of the tracked database, except those that touch the tracking table."""
    return history.filter(
        (F.col("start_time") >= lit_timestamp(settings.monitor_start))
        & (F.col("database_name") == F.upper(F.lit(settings.database)))
        & ~mentions(F.col("query_text"), settings.tracking_table)
    ).withColumn("start_time", to_naive_utc(F.col("start_time"), history.schema["start_time"].dataType))


def jobs(history: DataFrame, settings: Settings) -> DataFrame:
    """Query jobs of the tracked project that do not write the tracking table."""
    return history.filter(
        (F.col("job_type") == "QUERY")
        & (F.col("creation_time") >= lit_timestamp(settings.monitor_start))
        & (F.col("destination_table.table_id") != settings.tracking_table)
        & (F.col("project_id") == settings.database)
    )


def rpu_history(history: DataFrame, settings: Settings) -> DataFrame:
    return history.filter(
        (F.col("start_time") >= lit_timestamp(settings.monitor_start))
        & (F.col("database_name") == settings.database)
    )


def node_history(history: DataFrame, settings: Settings) -> DataFrame:
    """User statements of the tracked database, utility statements left out."""
    is_utility = F.col("query_text").rlike(f"(?i)^(?:{'|'.join(UTILITY_STATEMENTS)})")
    return history.filter(
        (F.col("user_id") > LAST_SYSTEM_USER)
        & (F.col("start_time") >= lit_timestamp(settings.monitor_start))
        & (F.col("database_name") == settings.database)
        & ~is_utility
    ).withColumn(
        "duration_seconds", second_boundaries_between(F.col("start_time"), F.col("end_time"))
    )
