"""Cost facts: one row per execution and statement, priced.

Every function takes the session, the sources and the settings and returns a
DataFrame.  Statement text is read once, and leaves the plan as soon as its
metadata has been parsed unless the fact shows it.  Where a fact reads an
intermediate result twice, ``stage`` stores it in the session's shared folder;
nothing is stored by default.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.config import Settings, Sources
from modelspend.functions import costs
from modelspend.functions.expressions import gib, lit_timestamp, mentions, ms_to_minutes
from modelspend.functions.metadata import (
    COMMENT_PATTERN,
    OBJECT_COMMENT_PATTERN,
    SPACED_OBJECT_COMMENT_PATTERN,
)
from modelspend.operators.allocation import (
    allocate_usage,
    charged_seconds_per_query,
    price_usage,
    query_spans,
    usage_periods,
)
from modelspend.operators.matching import (
    AT,
    BY_JOB,
    BY_JOB_AND_RUN,
    BY_RUN_AND_INVOCATION,
    META,
    Matches,
    match_executions,
    with_metadata,
    within_runs,
)
from modelspend.plans import histories
from modelspend.plans.tracking import eligible_executions, tracking_union
from modelspend.sources.staging import unstaged

Stage = Callable[[DataFrame], DataFrame]

USAGE_STATEMENT_COLUMNS = (
    "compute_type",
    "cluster_id",
    "warehouse_id",
    "workspace_id",
    "execution_duration_ms",
    "execution_seconds",
    "execution_hours",
    "read_rows",
    "read_bytes",
    "produced_rows",
    "written_bytes",
)


def _executions(spark: SparkSession, sources: Sources, id_column: str) -> DataFrame:
    return eligible_executions(tracking_union(sources.load_executions(spark)), id_column)


def _statements(history: DataFrame, at: str, *outputs) -> DataFrame:
    """Output columns, start time and parsed metadata, as ``match_executions`` takes them."""
    meta = [c for c in history.columns if c.startswith(META)]
    return history.select(*outputs, F.col(at).alias(AT), *meta)


def usage_matches(
    spark: SparkSession, sources: Sources, settings: Settings, stage: Stage = unstaged
) -> Matches:
    """Executions and their finished statements, by run and invocation."""
    executions = _executions(spark, sources, S.RUN_ID)
    history = histories.usage_history(sources.load(spark, "usage_history", settings.monitor_start), settings)
    history = within_runs(history, "start_time", executions)
    tagged = with_metadata(
        history.filter(~mentions(F.col("query_text"), settings.tracking_table)),
        "query_text",
        BY_RUN_AND_INVOCATION,
        COMMENT_PATTERN,
        settings.metadata_mode,
    )
    statements = _statements(
        tagged, "start_time", F.col("statement_id").alias("query_id"), *USAGE_STATEMENT_COLUMNS
    )
    return match_executions(
        executions, statements, BY_RUN_AND_INVOCATION, stage
    )


def credit_matches(spark: SparkSession, sources: Sources, settings: Settings) -> Matches:
    """Executions and their statements, by job and run."""
    executions = _executions(spark, sources, S.JOB_ID)
    history = histories.credit_history(sources.load(spark, "credit_history", settings.monitor_start), settings)
    history = within_runs(history, "start_time", executions)
    tagged = with_metadata(
        history, "query_text", BY_JOB_AND_RUN, OBJECT_COMMENT_PATTERN, settings.metadata_mode
    )
    statements = _statements(
        tagged,
        "start_time",
        "query_id",
        "warehouse_name",
        "warehouse_size",
        "credits_used_cloud_services",
        "bytes_scanned",
        "total_elapsed_time",
        F.col("execution_time").alias(S.CREDIT_EXECUTION_TIME),
        F.col("start_time").alias("query_start_time"),
    )
    return match_executions(executions, statements, BY_JOB_AND_RUN)


def job_matches(spark: SparkSession, sources: Sources, settings: Settings) -> Matches:
    """Executions and their query jobs, by run and invocation, at creation time."""
    executions = _executions(spark, sources, S.JOB_ID)
    history = histories.jobs(sources.load(spark, "jobs", settings.monitor_start), settings)
    history = within_runs(history, "creation_time", executions)
    tagged = with_metadata(
        history, "query", BY_RUN_AND_INVOCATION, COMMENT_PATTERN, settings.metadata_mode
    )
    statements = _statements(
        tagged,
        "creation_time",
        F.col("job_id").alias("query_id"),
        "reservation_id",
        "total_bytes_billed",
        "total_slot_ms",
        "total_bytes_processed",
        "cache_hit",
        F.col("creation_time").alias("query_creation_time"),
        F.col("start_time").alias("query_start_time"),
        F.col("end_time").alias("query_end_time"),
    )
    return match_executions(executions, statements, BY_RUN_AND_INVOCATION)


def rpu_matches(spark: SparkSession, sources: Sources, settings: Settings) -> Matches:
    """Executions and serverless statements, by job alone; the run's time range keeps them apart."""
    executions = _executions(spark, sources, S.JOB_ID)
    history = histories.rpu_history(sources.load(spark, "rpu_history", settings.monitor_start), settings)
    history = within_runs(history, "start_time", executions)
    tagged = with_metadata(
        history, "query_text", BY_JOB, SPACED_OBJECT_COMMENT_PATTERN, settings.metadata_mode, guarded=True
    )
    statements = _statements(
        tagged,
        "start_time",
        "query_id",
        "query_text",
        "elapsed_time",
        F.col("execution_time").alias("query_execution_time"),
        "queue_time",
    )
    return match_executions(executions, statements, BY_JOB)


def node_matches(spark: SparkSession, sources: Sources, settings: Settings) -> Matches:
    """Executions and statements of a provisioned cluster, by job alone."""
    executions = _executions(spark, sources, S.JOB_ID)
    history = histories.node_history(sources.load(spark, "node_history", settings.monitor_start), settings)
    history = within_runs(history, "start_time", executions)
    tagged = with_metadata(
        history, "query_text", BY_JOB, SPACED_OBJECT_COMMENT_PATTERN, settings.metadata_mode, guarded=True
    )
    statements = _statements(
        tagged,
        "start_time",
        "query_id",
        "user_id",
        "query_text",
        "start_time",
        "end_time",
        "duration_seconds",
    )
    return match_executions(executions, statements, BY_JOB)


def usage_costs(
    spark: SparkSession,
    sources: Sources,
    settings: Settings,
    stage: Stage = unstaged,
    only: DataFrame | None = None,
) -> DataFrame:
    """Allocated and priced usage per finished query and usage period.

    All queries count in the totals; ``only`` (one ``query_id`` column, no
    duplicates) restricts the result to those queries.  The price joins the
    periods, of which there are far fewer than shares.
    """
    history = histories.usage_history(sources.load(spark, "usage_history", settings.monitor_start), settings)
    usage = histories.billing_usage(sources.load(spark, "billing_usage", settings.monitor_start), settings)
    prices = sources.load(spark, "list_prices")

    def price(charges: DataFrame) -> DataFrame:
        return price_usage(charges, prices, settings.as_of)

    return allocate_usage(query_spans(history), usage_periods(usage), price, stage, only).select(
        "statement_id",
        "sku_name",
        "dbus_consumed",
        "dbu_unit_price",
        (F.col("dbus_consumed") * F.col("dbu_unit_price")).alias("estimated_cost_usd"),
    )


def fact_usage_split(
    spark: SparkSession, sources: Sources, settings: Settings, stage: Stage = unstaged
) -> DataFrame:
    """Usage-split fact: execution x statement x usage period x SKU x price.

    Executions without a statement keep one row.  A statement spanning several
    periods has a row for each, so its own metrics repeat.
    """
    matches = usage_matches(spark, sources, settings, stage)
    tracked = matches.matched.select("query_id").distinct()
    shares = usage_costs(spark, sources, settings, stage, only=tracked)
    # Every finished statement has shares, so a left join could only add the rows
    # without an id; an inner join lets both sides' hot partitions be split.
    costed = matches.matched.join(shares, F.col("query_id") == F.col("statement_id"), "inner")
    without_id = matches.matched.filter(F.col("query_id").isNull())
    joined = costed.unionByName(without_id, allowMissingColumns=True).unionByName(
        matches.unmatched, allowMissingColumns=True
    )
    cost = F.col("estimated_cost_usd")
    return joined.select(
        "query_id",
        *S.FACT_EXECUTION_COLUMNS,
        "compute_type",
        "cluster_id",
        "warehouse_id",
        "workspace_id",
        "dbus_consumed",
        "dbu_unit_price",
        "sku_name",
        "estimated_cost_usd",
        "execution_duration_ms",
        "execution_seconds",
        "execution_hours",
        "read_rows",
        "read_bytes",
        "produced_rows",
        "written_bytes",
        gib(F.col("read_bytes")).alias("gb_read"),
        gib(F.col("written_bytes")).alias("gb_written"),
        costs.cost_per_row(cost, F.col("produced_rows")).alias("cost_per_row_produced"),
        costs.cost_per_mib(cost, F.col("written_bytes")).alias("cost_per_mb_written"),
    )


def fact_credits(spark: SparkSession, sources: Sources, settings: Settings) -> DataFrame:
    """Credits fact: execution x statement, with the compute credits attributed to it."""
    pairs = credit_matches(spark, sources, settings).matched
    attribution = sources.load(spark, "query_attribution").select(
        F.col("query_id").alias("_attributed_id"), "credits_attributed_compute"
    )
    attributed_to = (F.col("_attributed_id") == F.col("query_id")) & (
        F.col("query_start_time") >= lit_timestamp(settings.monitor_start)
    )
    # a hot statement is on the left, where adaptive execution can split it
    joined = pairs.join(attribution, attributed_to, "left")
    rate = settings.rates.per_credit
    return joined.select(
        "query_id",
        *S.FACT_EXECUTION_COLUMNS,
        "warehouse_name",
        "warehouse_size",
        "credits_used_cloud_services",
        costs.credit_cost(F.col("credits_used_cloud_services"), rate).alias("cloud_services_cost"),
        gib(F.col("bytes_scanned")).alias("gb_scanned"),
        "credits_attributed_compute",
        costs.credit_cost(F.col("credits_attributed_compute"), rate).alias("attributed_compute_cost"),
        "total_elapsed_time",
        S.CREDIT_EXECUTION_TIME,
    )


def fact_bytes_slots(spark: SparkSession, sources: Sources, settings: Settings) -> DataFrame:
    """Bytes and slots fact: execution x job."""
    slot_ms = F.col("total_slot_ms")
    return job_matches(spark, sources, settings).matched.select(
        "query_id",
        *S.FACT_EXECUTION_COLUMNS,
        "reservation_id",
        ms_to_minutes(slot_ms).alias("slot_minutes"),
        costs.avg_slots(slot_ms, F.col("query_start_time"), F.col("query_end_time")).alias("job_avg_slots"),
        "total_bytes_billed",
        "total_slot_ms",
        "total_bytes_processed",
        "cache_hit",
        "query_creation_time",
        "query_start_time",
        "query_end_time",
    )


def _most_expensive_first(fact: DataFrame, then_by: str, stage: Stage) -> DataFrame:
    """Globally ordered fact.

    A global sort runs its input twice, to sample the ranges and to sort; a
    ``stage`` that stores the fact first lets the histories be read once.  The ids
    order statements of equal cost, so no range of the sort holds all of them.
    """
    ties = ("query_id", "invocation_id", "model_name")
    return stage(fact).orderBy(F.desc("estimated_cost_usd"), F.desc(then_by), *ties)


def fact_rpu(
    spark: SparkSession,
    sources: Sources,
    settings: Settings,
    ordered: bool = True,
    stage: Stage = unstaged,
) -> DataFrame:
    """Serverless fact: statements that ran inside a usage window, most expensive first.

    Pass ``ordered=False`` when the order is not needed: it costs a global sort.
    """
    history = histories.rpu_history(sources.load(spark, "rpu_history", settings.monitor_start), settings)
    charged = charged_seconds_per_query(sources.load(spark, "serverless_usage"), history)
    pairs = rpu_matches(spark, sources, settings).matched
    fact = pairs.join(charged, "query_id").select(
        "query_id",
        "query_text",
        *S.FACT_EXECUTION_COLUMNS,
        costs.rpu_cost(F.col("total_charged_seconds"), settings.rates.per_rpu_hour).alias(
            "estimated_cost_usd"
        ),
        "elapsed_time",
        "query_execution_time",
        "queue_time",
    )
    return _most_expensive_first(fact, "elapsed_time", stage) if ordered else fact


def fact_node_time(
    spark: SparkSession,
    sources: Sources,
    settings: Settings,
    ordered: bool = True,
    stage: Stage = unstaged,
) -> DataFrame:
    """Provisioned fact: statement time at the whole cluster's price, most expensive first."""
    rates = settings.rates
    seconds = F.col("duration_seconds")
    fact = node_matches(spark, sources, settings).matched.select(
        "query_id",
        *S.FACT_EXECUTION_COLUMNS,
        "user_id",
        "query_text",
        "start_time",
        "end_time",
        "duration_seconds",
        costs.node_cost_per_second(rates.per_node_hour, rates.node_count).alias("cluster_cost_per_second"),
        costs.node_time_cost(seconds, rates.per_node_hour, rates.node_count).alias("estimated_cost_usd"),
    )
    return _most_expensive_first(fact, "duration_seconds", stage) if ordered else fact
