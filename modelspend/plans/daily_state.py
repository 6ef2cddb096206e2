"""Reports from stored parts of days, so a daily run reads and writes its own days only.

Two Parquet tables in day folders hold, per model and run, mergeable parts of the cost history
(sums, counts, maxima) and the counts of reuses and executions.  The day is that of
the run's start.  A refresh computes the facts of some days anew and replaces their folders; all
other folders keep their files.  The reports add the parts up: they never read an execution
log or a statement.

Days to refresh are those of newly recorded executions (:func:`days_of`) and of the runs that
late statements may belong to (:func:`days_of_statements`).  A failed refresh is repeated with the
same days.  One state belongs to one ``Settings``: other rates, another database or an
earlier ``monitor_start`` need a new one.  The job runs are joined when a report is
read, so a run's environment may arrive late.

Usage-split pricing has no such state: one more statement changes the shares of all others in
its billing period, whatever the days of their runs.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.config import Settings, Sources
from modelspend.functions.expressions import lit_date, lit_timestamp
from modelspend.plans import facts, reports
from modelspend.plans.tracking import tracking_union
from modelspend.plans.views import BYTES_SLOTS, CREDITS
from modelspend.sources.commits import delete_folder, has_plain_files

DAY = "day"
COSTS = "costs"
COUNTS = "counts"
#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

Stage = Callable[[DataFrame], DataFrame]


def _day() -> Column:
    return F.to_date("run_started_at").alias(DAY)


def days_of(executions: DataFrame) -> list[date | None]:
    """The days on which the runs of these executions started: a number per day, not per row."""
    return [r[DAY] for r in executions.select(_day()).distinct().collect()]


def days_of_statements(executions: DataFrame, statements: DataFrame, at: str) -> list[date | None]:
    """Days of the runs that were open between the first and the last of these statements' times.

    A statement can only belong to such a run, so these days hold all that it may change.
    """
    bounds = statements.select(F.col(at).cast("timestamp_ntz").alias("at"))
    first, last = bounds.agg(F.min("at")), bounds.agg(F.max("at"))
    is_open = (F.col("insert_timestamp") >= first.scalar()) & (F.col("run_started_at") <= last.scalar())
    return days_of(executions.filter(is_open))


def on_days(executions: DataFrame, days: Collection[date | None]) -> DataFrame:
    """Executions whose runs started on these days; the bounds on the time reach the scan."""
    start = F.col("run_started_at")
    known = sorted(d for d in days if d is not None)
    chosen = start.isNull() if None in days else F.lit(False)
    if known:
        within = (start >= _midnight(known[0])) & (start < _midnight(known[-1] + timedelta(days=1)))
        chosen = chosen | (within & F.to_date(start).isin([lit_date(d) for d in known]))
    return executions.filter(chosen)


def _midnight(day: date) -> Column:
    return lit_timestamp(datetime.combine(day, time()))


def _cost_parts(spark: SparkSession, sources: Sources, settings: Settings, pricing: str) -> DataFrame:
    if pricing == CREDITS:
        return reports.credit_parts(facts.fact_credits(spark, sources, settings).withColumn(DAY, _day()), DAY)
    return reports.byte_parts(facts.fact_bytes_slots(spark, sources, settings).withColumn(DAY, _day()), settings.rates, DAY)


def _check(pricing: str) -> None:
    if pricing not in (CREDITS, BYTES_SLOTS):
        raise ValueError(f"a state of days exists for {CREDITS!r} and {BYTES_SLOTS!r}, not for {pricing!r}")


def replace_days(rows: DataFrame, path: str, days: Collection[date | None], stage: Stage) -> None:
    """Write ``rows``, the whole new content of ``days``; days without rows lose their folder, others keep their files."""
    spark, stored = rows.sparkSession, stage(rows)
    stored.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    filled = {r[DAY] for r in stored.select(DAY).distinct().collect()}
    for day in set(days) - filled:
        delete_folder(spark, f"{path}/{DAY}={NO_DAY if day is None else day.isoformat()}")


def refresh_days(
    spark: SparkSession,
    path: str,
    sources: Sources,
    settings: Settings,
    pricing: str,
    days: Collection[date | None],
    stage: Stage,
) -> None:
    """Compute the parts of these days from the sources, all of them, and store them instead of what was there.

    ``stage`` stores each table's new rows before the old ones go.  No statement before the first day can belong to a run of
    these days, so the histories are read from that day on.
    """
    _check(pricing)
    if not days:
        return
    executions = on_days(tracking_union(sources.load_executions(spark)), days)
    known = [d for d in days if d is not None]
    if known:
        first = datetime.combine(min(known), time())
        chosen = replace(settings, monitor_start=max(settings.monitor_start, first))
        costs = _cost_parts(spark, replace(sources, executions=executions, extra_executions=()), chosen, pricing)
        replace_days(costs, f"{path}/{COSTS}", known, stage)
    counts = reports.counts_per_run(executions).withColumnRenamed("reuse_date", DAY)
    replace_days(counts, f"{path}/{COUNTS}", days, stage)


def _stored(spark: SparkSession, path: str, kind: str, empty: DataFrame) -> DataFrame:
    """The stored table with the columns and types of ``empty``, which stands for it before any day has rows."""
    table = f"{path}/{kind}"
    return spark.read.schema(empty.schema).parquet(table) if has_plain_files(spark, table) else empty


def daily_savings(spark: SparkSession, path: str, sources: Sources, settings: Settings, pricing: str) -> DataFrame:
    """The daily report of the stored days, as :mod:`~modelspend.plans.reports` computes it from the facts.

    Of the sources only the job runs are read; the others give the columns their types.
    """
    _check(pricing)
    costs = _stored(spark, path, COSTS, _cost_parts(spark, sources, settings, pricing).limit(0))
    executions = tracking_union(sources.load_executions(spark)).limit(0)
    counts = _stored(spark, path, COUNTS, reports.counts_per_run(executions).withColumnRenamed("reuse_date", DAY))
    counts = counts.withColumnRenamed(DAY, "reuse_date")
    job_runs = sources.load(spark, "job_runs")
    if pricing == CREDITS:
        history = reports.credit_history_of_parts(costs)
        return reports.daily_savings_credits(reports.reuse_execute_counts_of_runs(counts, job_runs), history)
    reused = counts.filter(F.col("reuses") > 0).drop("executes")
    return reports.daily_savings_bytes(reports.reuse_counts_of_runs(reused, job_runs), reports.byte_history_of_parts(costs))


def savings_summary(spark: SparkSession, path: str, sources: Sources, settings: Settings) -> DataFrame:
    """The one-row summary of the stored days."""
    return reports.savings_summary(daily_savings(spark, path, sources, settings, CREDITS), settings)
