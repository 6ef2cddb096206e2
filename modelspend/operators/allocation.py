"""Sharing measured usage among the queries that ran while it accrued."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend.functions import costs
from modelspend.functions.expressions import compute_resource, lit_date, overlap_seconds, whole_seconds_between
from modelspend.operators.intervals import HOUR, MINUTE, Span, interval_join, without_match
from modelspend.sources.staging import unstaged

PERIOD_COLUMNS = [
    "record_id",
    "usage_workspace_id",
    "compute_resource_id",
    "usage_start_time",
    "usage_end_time",
    "usage_quantity",
    "sku_name",
    "billing_origin_product",
]
PERIOD_ID = "period_id"
PERIOD = Span("usage_start_time", "usage_end_time")
QUERY = Span("start_time", "end_time")
QUERY_COLUMNS = ["statement_id", "workspace_id", "resource_id", "start_time", "end_time"]

SAME_RESOURCE = [("compute_resource_id", "resource_id"), ("usage_workspace_id", "workspace_id")]


def _shared_seconds() -> Column:
    return overlap_seconds(
        F.col("start_time"), F.col("end_time"), F.col("usage_start_time"), F.col("usage_end_time")
    )


def _overlaps() -> Column:
    return (F.col("start_time") < F.col("usage_end_time")) & (F.col("end_time") > F.col("usage_start_time"))


def usage_periods(usage: DataFrame) -> DataFrame:
    """Usage rows as periods on one compute resource, equal rows counted in ``copies``."""
    meta = F.col("usage_metadata")
    return (
        usage.select(
            "record_id",
            F.col("workspace_id").alias("usage_workspace_id"),
            compute_resource(meta["cluster_id"], meta["warehouse_id"]).alias("compute_resource_id"),
            *PERIOD_COLUMNS[3:],
        )
        .groupBy(*PERIOD_COLUMNS)
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def query_spans(history: DataFrame) -> DataFrame:
    """What allocation needs of a query: its id, resource and time range."""
    return history.select(
        "statement_id",
        "workspace_id",
        compute_resource(F.col("cluster_id"), F.col("warehouse_id")).alias("resource_id"),
        "start_time",
        "end_time",
    )


def usage_overlap_pairs(periods: DataFrame, queries: DataFrame) -> DataFrame:
    """Every (usage period, query) pair on the same resource whose times overlap."""
    pairs = interval_join(
        periods,
        queries,
        small_span=PERIOD,
        large_span=QUERY,
        condition=_overlaps(),
        on=SAME_RESOURCE,
        width=HOUR,
    )
    return pairs.withColumn("overlap_seconds", _shared_seconds())


def usage_period_totals(periods: DataFrame, queries: DataFrame) -> DataFrame:
    """Periods with the query seconds that fall into each.

    A period in which nothing ran gets its own length.  The sum is partial on
    the map side, so a busy period costs no more than a quiet one.
    """
    own_length = F.greatest(
        whole_seconds_between(F.col("usage_start_time"), F.col("usage_end_time")), F.lit(0).cast("long")
    )
    none = F.lit(0).cast("long")
    overlaps = usage_overlap_pairs(periods, queries).select(
        *PERIOD_COLUMNS, F.col("overlap_seconds"), F.lit(1).alias("hits"), none.alias("copies")
    )
    rows = periods.select(*PERIOD_COLUMNS, none.alias("overlap_seconds"), F.lit(0).alias("hits"), "copies")
    return (
        overlaps.unionByName(rows)
        .groupBy(*PERIOD_COLUMNS)
        .agg(
            F.sum("overlap_seconds").alias("_seconds"),
            F.max("hits").alias("_hit"),
            F.sum("copies").alias("_copies"),
        )
        .select(
            *PERIOD_COLUMNS,
            (F.when(F.col("_hit") > 0, F.col("_seconds")).otherwise(own_length) * F.col("_copies")).alias(
                "total_query_execution_seconds"
            ),
        )
    )


def price_usage(usage: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Add ``dbu_unit_price``, the list price of each row's SKU valid on ``as_of``.

    Overlapping price rows each give a row; a SKU without price gives NULL.
    """
    day = lit_date(as_of)
    valid = prices.filter(
        (day >= F.to_date("price_start_time"))
        & (F.col("price_end_time").isNull() | (day < F.to_date("price_end_time")))
    ).select(
        F.col("sku_name").alias("_price_sku"),
        F.col("pricing.effective_list.default").alias("dbu_unit_price"),
    )
    return usage.join(valid, F.col("sku_name") == F.col("_price_sku"), "left").drop("_price_sku")


def with_period_id(periods: DataFrame) -> DataFrame:
    """Add ``period_id``, 128 bits that tell periods apart."""
    spelled = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in PERIOD_COLUMNS]), {"ignoreNullFields": "false"})
    return periods.withColumn(PERIOD_ID, F.unhex(F.md5(spelled)))


def allocate_usage(
    queries: DataFrame,
    periods: DataFrame,
    price: Callable[[DataFrame], DataFrame] = unstaged,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
    only: DataFrame | None = None,
) -> DataFrame:
    """Each query's share of every usage period it overlaps.

    The (period, query) pairs are found once, as a narrow table of period ids and
    query columns; the totals are added up from it and joined back by period.
    ``price`` may add columns to the periods, of which there are far fewer than shares.
    A query that overlaps no period keeps one row with zero usage.  All queries count in the
    totals; ``only`` (one ``query_id`` column, no duplicates) restricts the result to
    those queries.  The pairs are read three times; ``stage`` may store them.
    """
    identified = with_period_id(periods)
    pairs = stage(usage_overlap_pairs(identified, queries).select(PERIOD_ID, *QUERY_COLUMNS, "overlap_seconds"))
    totals = pairs.groupBy(PERIOD_ID).agg(F.sum("overlap_seconds").alias("_seconds"))
    charges = identified.join(totals, PERIOD_ID).select(
        PERIOD_ID, "sku_name", "usage_quantity", (F.col("_seconds") * F.col("copies")).alias("_total")
    )
    charges = price(charges)
    extra = [c for c in charges.columns if c not in (PERIOD_ID, "sku_name", "usage_quantity", "_total")]
    wanted, mine = pairs, queries
    if only is not None:
        wanted, mine = (df.join(only, F.col("statement_id") == F.col("query_id"), "left_semi") for df in (pairs, queries))
    shares = wanted.join(charges, PERIOD_ID).select(
        *QUERY_COLUMNS,
        "sku_name",
        *extra,
        costs.usage_share(F.col("usage_quantity"), F.col("overlap_seconds"), F.col("_total")).alias("dbus_consumed"),
    )
    unshared = without_match(
        mine, pairs, decided_by=["resource_id", "workspace_id", "start_time", "end_time"]
    ).withColumn("dbus_consumed", F.lit(0.0))
    return shares.unionByName(unshared, allowMissingColumns=True)


def window_containment(windows: DataFrame, queries: DataFrame) -> DataFrame:
    """(usage window, query) pairs where the query ran wholly inside the window.

    ``windows`` with equal bounds are added up first.
    """
    summed = windows.groupBy(
        F.col("start_time").alias("window_start"), F.col("end_time").alias("window_end")
    ).agg(F.sum("charged_seconds").alias("charged_seconds"))
    return interval_join(
        summed,
        queries.select("query_id", "start_time", "end_time"),
        small_span=Span("window_start", "window_end"),
        large_span=QUERY,
        condition=(F.col("start_time") >= F.col("window_start")) & (F.col("end_time") <= F.col("window_end")),
        width=MINUTE,
    )


def charged_seconds_per_query(windows: DataFrame, queries: DataFrame) -> DataFrame:
    """Seconds charged in the windows containing each query; each query gets all of them."""
    return (
        window_containment(windows, queries)
        .groupBy("query_id")
        .agg(F.sum("charged_seconds").alias("total_charged_seconds"))
    )
