"""Settings: rates, time bounds and where the input tables are."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from modelspend import schemas as S
from modelspend.sources.tables import TableRef, load_table


@dataclass(frozen=True)
class Rates:
    """Prices in USD. All are doubles, so no decimal rounding enters a cost."""

    # Default prices.
    per_credit: float = 3.0
    per_tib: float = 6.25
    per_slot_hour: float = 0.04
    per_rpu_hour: float = 0.36
    per_node_hour: float = 0.543
    node_count: int = 1


@dataclass(frozen=True)
class Settings:
    """Everything the reference takes from the clock or from project variables."""

    monitor_start: datetime
    as_of: date
    summary_start: date
    summary_end: date
    database: str = "shop"
    tracking_table: str = S.EXECUTIONS_TABLE
    metadata_mode: str = "reference"
    rates: Rates = field(default_factory=Rates)

    @classmethod
    def at(cls, now: datetime, **overrides) -> "Settings":
        """Defaults relative to ``now``: 30 days of history, summary from 8 days to 1 day ago."""
        today = now.date()
        values = {
            "monitor_start": datetime.combine(today - timedelta(days=30), datetime.min.time()),
            "as_of": today,
            "summary_start": today - timedelta(days=8),
            "summary_end": today - timedelta(days=1),
        }
        return cls(**{**values, **overrides})


@dataclass(frozen=True)
class Sources:
    """Input tables by name; each is a DataFrame, a table name or a file path, or one of these as ``Dated``.

    Only the tables a plan needs have to be given.
    """

    executions: TableRef | None = None
    extra_executions: tuple[TableRef, ...] = ()
    job_runs: TableRef | None = None
    usage_history: TableRef | None = None
    billing_usage: TableRef | None = None
    list_prices: TableRef | None = None
    credit_history: TableRef | None = None
    query_attribution: TableRef | None = None
    jobs: TableRef | None = None
    rpu_history: TableRef | None = None
    serverless_usage: TableRef | None = None
    node_history: TableRef | None = None

    def load(self, spark: SparkSession, name: str, since: datetime | None = None) -> DataFrame:
        """The named table, checked against the columns the engine needs.

        ``since`` prunes the day folders of a :class:`~modelspend.sources.tables.Dated` table; the caller
        still filters by time.
        """
        ref = getattr(self, name)
        if ref is None:
            raise ValueError(f"source table '{name}' is not configured")
        return load_table(spark, ref, SOURCE_SCHEMAS[name], since)

    def load_executions(self, spark: SparkSession) -> list[DataFrame]:
        """The execution log and the extra ones, which may be older and narrower."""
        needed = T.StructType([S.EXECUTIONS[name] for name in S.EXECUTION_KEYS])
        return [self.load(spark, "executions")] + [load_table(spark, ref, needed) for ref in self.extra_executions]


SOURCE_SCHEMAS = {
    "executions": S.EXECUTIONS,
    "job_runs": S.JOB_RUNS,
    "usage_history": S.USAGE_HISTORY,
    "billing_usage": S.BILLING_USAGE,
    "list_prices": S.LIST_PRICES,
    "credit_history": S.CREDIT_HISTORY,
    "query_attribution": S.QUERY_ATTRIBUTION,
    "jobs": S.JOBS,
    "rpu_history": S.RPU_HISTORY,
    "serverless_usage": S.SERVERLESS_USAGE,
    "node_history": S.NODE_HISTORY,
}


def session_settings() -> dict[str, str]:
    """Spark settings the engine relies on; apply when building the session.

    Adaptive execution splits hot join partitions, merges small ones, and
    broadcasts a join side only when its measured size is under the threshold.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
