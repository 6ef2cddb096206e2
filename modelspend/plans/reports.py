"""Daily savings per model, and the one-row summary.

Counts and costs are aggregated before they are joined.  Distinct runs are counted
by grouping on the run first, which needs no separate distinct aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.config import Rates, Settings
from modelspend.functions import costs
from modelspend.functions.expressions import lit_date, or_zero
from modelspend.plans.tracking import dedup_job_runs

MODEL = ["model_name", "relation_name", "model_package"]
DAILY = [*MODEL, "reuse_date", S.ENVIRONMENT_ID, S.PROJECT_ID]

# Execution statuses that are counted.
REUSED = "reused"
EXECUTED = ("success", "error")


def _named(prefix_to_agg: dict[str, str], column: str, suffix: str) -> list[Column]:
    return [getattr(F, agg)(column).alias(f"{name}_{suffix}") for name, agg in prefix_to_agg.items()]


AVG_MAX_TOTAL = {"avg_run": "avg", "max_run": "max", "total_run": "sum"}
AVG_MAX = {"avg": "avg", "max": "max"}


# ------------------------------------------------------------------ cost history


def model_cost_history_usage(fact: DataFrame) -> DataFrame:
    """Usage and cost per model, over its runs."""
    runs = fact.groupBy(*MODEL, S.RUN_ID).agg(
        F.sum("dbus_consumed").alias("dbus"),
        F.sum("estimated_cost_usd").alias("cost"),
        F.avg("execution_time").alias("execution_time"),
        F.sum("gb_read").alias("gb_read"),
    )
    return runs.groupBy(*MODEL).agg(
        *_named(AVG_MAX_TOTAL, "dbus", "dbus"),
        *_named(AVG_MAX_TOTAL, "cost", "cost"),
        F.count(F.lit(1)).alias("total_query_count"),
        F.count(S.RUN_ID).alias("total_run_count"),
        *_named(AVG_MAX, "execution_time", "execution_time_seconds"),
        *_named(AVG_MAX, "gb_read", "gb_read"),
    )


CREDIT_SUMS = ("compute_credits", "credits", "compute_cost", "cost", "gb_scanned")


def _credit_values(fact: DataFrame) -> DataFrame:
    """Credits and cost of each row; missing parts of a credit count as 0."""

    def both(compute: str, services: str) -> Column:
        return or_zero(F.col(compute)) + or_zero(F.col(services))

    return fact.withColumns(
        {
            "compute_credits": F.col("credits_attributed_compute"),
            "credits": both("credits_attributed_compute", "credits_used_cloud_services"),
            "compute_cost": F.col("attributed_compute_cost"),
            "cost": both("attributed_compute_cost", "cloud_services_cost"),
        }
    )


def _over_credit_runs(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*MODEL).agg(
        *_named(AVG_MAX_TOTAL, "credits", "credits"),
        F.sum("compute_credits").alias("total_run_compute_credits"),
        *_named(AVG_MAX_TOTAL, "cost", "cost"),
        F.sum("compute_cost").alias("total_run_compute_cost"),
        F.count(F.lit(1)).alias("total_query_count"),
        F.count(S.RUN_ID).alias("total_run_count"),
        *_named(AVG_MAX, "execution_time", "execution_time_seconds"),
        *_named(AVG_MAX, "gb_scanned", "gb_scanned"),
    )


def model_cost_history_credits(fact: DataFrame) -> DataFrame:
    """Credits and cost per model, over its runs; missing parts of a credit count as 0."""
    runs = _credit_values(fact).groupBy(*MODEL, S.RUN_ID)
    return _over_credit_runs(runs.agg(*[F.sum(c).alias(c) for c in CREDIT_SUMS], F.avg("execution_time").alias("execution_time")))


def credit_parts(fact: DataFrame, *by: str) -> DataFrame:
    """What :func:`credit_history_of_parts` needs of the fact, per run and ``by``; parts of different rows add up."""
    return _credit_values(fact).groupBy(*by, *MODEL, S.RUN_ID).agg(
        *[F.sum(c).alias(c) for c in CREDIT_SUMS],
        F.sum("execution_time").alias("execution_time_sum"),
        F.count("execution_time").alias("execution_time_n"),
    )


def credit_history_of_parts(parts: DataFrame) -> DataFrame:
    """:func:`model_cost_history_credits` of all rows that the parts stand for."""
    runs = parts.groupBy(*MODEL, S.RUN_ID)
    return _over_credit_runs(runs.agg(*[F.sum(c).alias(c) for c in CREDIT_SUMS], _mean_of("execution_time")))


def _mean_of(column: str, alias: str | None = None) -> Column:
    return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n")).alias(alias or column)


def _byte_values(fact: DataFrame, rates: Rates, *also: str) -> DataFrame:
    return fact.select(
        *also,
        *MODEL,
        S.RUN_ID,
        costs.bytes_cost(F.col("total_bytes_billed"), rates.per_tib).alias("on_demand_cost"),
        costs.slot_cost(F.col("total_slot_ms"), rates.per_slot_hour).alias("capacity_cost"),
        "slot_minutes",
        "job_avg_slots",
        "total_bytes_billed",
        "total_bytes_processed",
        "execution_time",
    )


def model_cost_history_bytes(fact: DataFrame, rates: Rates) -> DataFrame:
    """On-demand and capacity cost per model, over its queries."""
    return _byte_values(fact, rates).groupBy(*MODEL).agg(
        *_named(AVG_MAX_TOTAL, "on_demand_cost", "on_demand_cost"),
        *_named(AVG_MAX_TOTAL, "capacity_cost", "capacity_cost"),
        *_named(AVG_MAX_TOTAL, "slot_minutes", "slot_minutes"),
        *_named(AVG_MAX, "job_avg_slots", "slots_per_query"),
        *_named(AVG_MAX, "total_bytes_billed", "bytes_billed"),
        F.sum("total_bytes_billed").alias("total_bytes_billed"),
        *_named(AVG_MAX, "total_bytes_processed", "bytes_processed"),
        F.count(F.lit(1)).alias("total_query_count"),
        F.countDistinct(S.RUN_ID).alias("total_run_count"),
        *_named(AVG_MAX, "execution_time", "execution_time_seconds"),
    )


# A value's column and its name in the report, with its total where the report has it.
BYTE_VALUES = {
    "on_demand_cost": ("run_on_demand_cost", "total_run_on_demand_cost"),
    "capacity_cost": ("run_capacity_cost", "total_run_capacity_cost"),
    "slot_minutes": ("run_slot_minutes", "total_run_slot_minutes"),
    "job_avg_slots": ("slots_per_query", None),
    "total_bytes_billed": ("bytes_billed", "total_bytes_billed"),
    "total_bytes_processed": ("bytes_processed", None),
    "execution_time": ("execution_time_seconds", None),
}


def byte_parts(fact: DataFrame, rates: Rates, *by: str) -> DataFrame:
    """What :func:`byte_history_of_parts` needs of the fact, per run and ``by``; parts of different rows add up."""
    return _byte_values(fact, rates, *by).groupBy(*by, *MODEL, S.RUN_ID).agg(
        F.count(F.lit(1)).alias("queries"),
        *[agg(c).alias(f"{c}_{part}") for c in BYTE_VALUES for part, agg in (("sum", F.sum), ("n", F.count), ("max", F.max))],
    )


def byte_history_of_parts(parts: DataFrame) -> DataFrame:
    """:func:`model_cost_history_bytes` of all rows that the parts stand for."""
    runs = parts.groupBy(*MODEL, S.RUN_ID).agg(
        F.sum("queries").alias("queries"),
        *[agg(f"{c}_{part}").alias(f"{c}_{part}") for c in BYTE_VALUES for part, agg in (("sum", F.sum), ("n", F.sum), ("max", F.max))],
    )
    values = []
    for column, (name, total) in BYTE_VALUES.items():
        values += [_mean_of(column, f"avg_{name}"), F.max(f"{column}_max").alias(f"max_{name}")]
        if total:
            values.append(F.sum(f"{column}_sum").alias(total))
    return runs.groupBy(*MODEL).agg(
        *values, F.sum("queries").alias("total_query_count"), F.count(S.RUN_ID).alias("total_run_count")
    )


# ------------------------------------------------------------------ reuse counts


def _with_environment(counts_per_run: DataFrame, job_runs: DataFrame) -> DataFrame:
    """Attach environment and project to rows already grouped by run."""
    runs = dedup_job_runs(job_runs).withColumnRenamed(S.RUN_ID, "_run")
    return counts_per_run.join(runs, F.col(S.RUN_ID) == F.col("_run"), "left").drop("_run")


def _per_run(executions: DataFrame, *counts: Column) -> DataFrame:
    day = F.to_date("run_started_at").alias("reuse_date")
    return executions.groupBy(*MODEL, day, S.RUN_ID).agg(*counts)


def reuse_counts(executions: DataFrame, job_runs: DataFrame) -> DataFrame:
    """Reused executions per model, day, environment and project, and the runs they came from."""
    reused = executions.filter(F.col("status") == REUSED)
    return reuse_counts_of_runs(_per_run(reused, F.count(F.lit(1)).alias("reuses")), job_runs)


def reuse_counts_of_runs(per_run: DataFrame, job_runs: DataFrame) -> DataFrame:
    """:func:`reuse_counts` from the reuses of each model, day and run."""
    return (
        _with_environment(per_run, job_runs)
        .groupBy(*DAILY)
        .agg(F.sum("reuses").alias("reuse_count"), F.count(S.RUN_ID).alias("unique_runs_reused"))
    )


def reuse_execute_counts(executions: DataFrame, job_runs: DataFrame) -> DataFrame:
    """Reused and executed counts per model, day, environment and project.

    Other statuses count for neither side but keep their row.
    """
    return reuse_execute_counts_of_runs(counts_per_run(executions), job_runs)


def counts_per_run(executions: DataFrame) -> DataFrame:
    """Reuses and executions of each model, day (``reuse_date``) and run."""
    status = F.col("status")
    return _per_run(
        executions,
        F.count(F.when(status == REUSED, 1)).alias("reuses"),
        F.count(F.when(status.isin(*EXECUTED), 1)).alias("executes"),
    )


def reuse_execute_counts_of_runs(per_run: DataFrame, job_runs: DataFrame) -> DataFrame:
    """:func:`reuse_execute_counts` from the counts of each model, day and run."""
    return (
        _with_environment(per_run, job_runs)
        .groupBy(*DAILY)
        .agg(F.sum("reuses").alias("reuse_count"), F.sum("executes").alias("execute_count"))
    )


# ----------------------------------------------------------------- daily reports


def _with_history(counts: DataFrame, history: DataFrame, null_relations_match: bool = False) -> DataFrame:
    """Left join on the model; a NULL relation matches only if asked to."""
    history = history.withColumnsRenamed({c: f"_h_{c}" for c in MODEL})
    same = F.lit(True)
    for column in MODEL:
        left, right = F.col(column), F.col(f"_h_{column}")
        if null_relations_match and column == "relation_name":
            same = same & (F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit("")))
        else:
            same = same & (left == right)
    return counts.join(history, same, "left").drop(*[f"_h_{c}" for c in MODEL])


def daily_savings_usage(counts: DataFrame, history: DataFrame) -> DataFrame:
    """Savings per model and day under usage-split pricing."""
    reused, runs = F.col("reuse_count"), F.col("total_run_count")
    return _with_history(counts, history).select(
        *DAILY,
        "reuse_count",
        "unique_runs_reused",
        *[f"{p}_{m}" for m in ("dbus", "cost") for p in AVG_MAX_TOTAL],
        "total_query_count",
        "total_run_count",
        "avg_execution_time_seconds",
        "max_execution_time_seconds",
        "avg_gb_read",
        "max_gb_read",
        costs.scaled_by_count(reused, F.col("avg_run_dbus")).alias("estimated_dbus_saved"),
        costs.scaled_by_count(reused, F.col("avg_run_cost")).alias("estimated_cost_saved_usd"),
        costs.reuse_rate(reused, runs).alias("reuse_rate_percent"),
        costs.saved_per_reuse(F.col("avg_run_cost"), reused).alias("avg_cost_saved_per_reuse_usd"),
    )


def daily_savings_credits(counts: DataFrame, history: DataFrame) -> DataFrame:
    """Savings and spend per model and day under credit pricing."""
    reused, executed = F.col("reuse_count"), F.col("execute_count")
    return _with_history(counts, history).select(
        *DAILY,
        "reuse_count",
        "execute_count",
        *[f"{p}_{m}" for m in ("credits", "cost") for p in AVG_MAX_TOTAL],
        "total_query_count",
        "total_run_count",
        "avg_execution_time_seconds",
        "max_execution_time_seconds",
        "avg_gb_scanned",
        "max_gb_scanned",
        costs.scaled_by_count(reused, F.col("avg_run_credits")).alias("estimated_credits_saved"),
        costs.scaled_by_count(reused, F.col("avg_run_cost")).alias("estimated_cost_saved_usd"),
        costs.scaled_by_count(executed, F.col("avg_run_credits")).alias("estimated_credits_used"),
        costs.scaled_by_count(executed, F.col("avg_run_cost")).alias("estimated_cost_spent_usd"),
        costs.reuse_rate(reused, executed).alias("reuse_rate_percent"),
        costs.saved_per_reuse(F.col("avg_run_cost"), reused).alias("avg_cost_saved_per_reuse_usd"),
    )


def daily_savings_bytes(counts: DataFrame, history: DataFrame) -> DataFrame:
    """Savings per model and day under on-demand and slot pricing."""
    reused, runs = F.col("reuse_count"), F.col("total_run_count")

    def saved(average: str) -> Column:
        return costs.scaled_by_count(reused, F.col(average))

    return _with_history(counts, history, null_relations_match=True).select(
        *DAILY,
        "reuse_count",
        "unique_runs_reused",
        *[f"{p}_{m}" for m in ("on_demand_cost", "capacity_cost", "slot_minutes") for p in AVG_MAX_TOTAL],
        "avg_slots_per_query",
        "max_slots_per_query",
        "avg_bytes_billed",
        "max_bytes_billed",
        "total_bytes_billed",
        "avg_bytes_processed",
        "max_bytes_processed",
        "total_query_count",
        "total_run_count",
        "avg_execution_time_seconds",
        "max_execution_time_seconds",
        saved("avg_run_on_demand_cost").alias("estimated_on_demand_cost_saved_usd"),
        saved("avg_run_slot_minutes").alias("estimated_slot_minutes_saved"),
        saved("avg_bytes_billed").alias("estimated_bytes_billed_saved"),
        saved("avg_execution_time_seconds").alias("estimated_execution_time_saved_seconds"),
        costs.reuse_rate(reused, runs).alias("reuse_rate_percent"),
        costs.saved_per_reuse(F.col("avg_run_on_demand_cost"), reused).alias(
            "avg_on_demand_cost_saved_per_reuse_usd"
        ),
        costs.saved_per_reuse(F.col("avg_run_slot_minutes"), reused).alias(
            "avg_slot_minutes_saved_per_reuse"
        ),
    )


# ----------------------------------------------------------------------- summary


def savings_summary(daily: DataFrame, settings: Settings) -> DataFrame:
    """One row over the summary dates, both included."""
    in_range = F.col("reuse_date").between(lit_date(settings.summary_start), lit_date(settings.summary_end))
    reused, executed = F.col("reuse_count"), F.col("execute_count")
    saved, spent = F.col("estimated_cost_saved_usd"), F.col("estimated_cost_spent_usd")
    return (
        daily.filter(in_range)
        .agg(
            F.min("reuse_date").alias("summary_start_date"),
            F.max("reuse_date").alias("summary_end_date"),
            F.sum(reused).alias("total_reused_models"),
            F.sum(executed).alias("total_executed_models"),
            F.sum(reused + executed).alias("total_attempted_models"),
            F.sum(saved).alias("_saved"),
            F.sum(spent).alias("_spent"),
            F.sum(saved + spent).alias("_both"),
        )
        .select(
            "summary_start_date",
            "summary_end_date",
            "total_reused_models",
            "total_executed_models",
            "total_attempted_models",
            costs.percent(F.col("total_reused_models"), F.col("total_attempted_models")).alias(
                "perc_reused_models"
            ),
            F.round("_saved", 2).alias("total_reused_cost_savings"),
            F.round("_spent", 2).alias("total_cost_spent"),
            costs.percent(F.col("_saved"), F.col("_both")).alias("perc_cost_savings"),
        )
    )
