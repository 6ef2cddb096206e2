"""The results under the view names their consumers query, for one kind of pricing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modelspend import schemas as S
from modelspend.config import Settings, Sources
from modelspend.plans import facts, reports
from modelspend.plans.tracking import tracking_union
from modelspend.sources.staging import unstaged
from modelspend.sources.tables import publish

USAGE_SPLIT = "usage_split"
CREDITS = "credits"
BYTES_SLOTS = "bytes_slots"
RPU = "rpu"
NODE_TIME = "node_time"
PRICINGS = (USAGE_SPLIT, CREDITS, BYTES_SLOTS, RPU, NODE_TIME)


def build_views(
    spark: SparkSession,
    sources: Sources,
    settings: Settings,
    pricing: str,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> dict[str, DataFrame]:
    """The fact, and where the pricing has them the daily report and the summary.

    The report reads the fact and the summary reads the report; ``stage`` may
    store the fact once for both.
    """
    if pricing not in PRICINGS:
        raise ValueError(f"pricing must be one of {PRICINGS}, not {pricing!r}")
    if pricing == RPU:
        return {S.FACT_VIEW: facts.fact_rpu(spark, sources, settings, stage=stage)}
    if pricing == NODE_TIME:
        return {S.FACT_VIEW: facts.fact_node_time(spark, sources, settings, stage=stage)}

    executions = tracking_union(sources.load_executions(spark))
    job_runs = sources.load(spark, "job_runs")
    if pricing == USAGE_SPLIT:
        fact = stage(facts.fact_usage_split(spark, sources, settings, stage))
        history = reports.model_cost_history_usage(fact)
        daily = reports.daily_savings_usage(reports.reuse_counts(executions, job_runs), history)
    elif pricing == BYTES_SLOTS:
        fact = stage(facts.fact_bytes_slots(spark, sources, settings))
        history = reports.model_cost_history_bytes(fact, settings.rates)
        daily = reports.daily_savings_bytes(reports.reuse_counts(executions, job_runs), history)
    else:
        fact = stage(facts.fact_credits(spark, sources, settings))
        history = reports.model_cost_history_credits(fact)
        daily = reports.daily_savings_credits(reports.reuse_execute_counts(executions, job_runs), history)

    views = {S.FACT_VIEW: fact, S.DAILY_SAVINGS_VIEW: daily}
    if pricing == CREDITS:
        views[S.SUMMARY_VIEW] = reports.savings_summary(daily, settings)
    return views


def publish_views(
    spark: SparkSession,
    sources: Sources,
    settings: Settings,
    pricing: str,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> dict[str, DataFrame]:
    """Build the results and expose each as a temporary view."""
    views = build_views(spark, sources, settings, pricing, stage)
    for name, df in views.items():
        publish(df, name)
    return views
