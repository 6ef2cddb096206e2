"""Cost and savings formulas, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelspend.functions.expressions import MIB, TIB, double, ms_between, ms_to_hours, ratio_if_positive


def usage_share(quantity: Column, overlap: Column, total_overlap: Column) -> Column:
    """A query's part of a usage period, by overlap time; 0 when nothing ran in it."""
    share = quantity * double(overlap) / double(total_overlap)
    return F.when(total_overlap > 0, share).otherwise(F.lit(0.0))


def credit_cost(credits: Column, per_credit: float) -> Column:
    return credits * F.lit(float(per_credit))


def bytes_cost(bytes_billed: Column, per_tib: float) -> Column:
    return double(bytes_billed) / F.lit(TIB) * F.lit(float(per_tib))


def slot_cost(slot_ms: Column, per_slot_hour: float) -> Column:
    return ms_to_hours(slot_ms) * F.lit(float(per_slot_hour))


def avg_slots(slot_ms: Column, start: Column, end: Column) -> Column:
    """Slots held on average while running; NULL for a zero-length query."""
    return F.try_divide(double(slot_ms), double(ms_between(start, end)))


def node_cost_per_second(per_node_hour: float, node_count: int) -> Column:
    return F.lit(float(per_node_hour)) * F.lit(float(node_count)) / F.lit(3600.0)


def node_time_cost(seconds: Column, per_node_hour: float, node_count: int) -> Column:
    return double(seconds) * node_cost_per_second(per_node_hour, node_count)


def rpu_cost(charged_seconds: Column, per_rpu_hour: float) -> Column:
    return double(charged_seconds) / F.lit(3600.0) * F.lit(float(per_rpu_hour))


def cost_per_row(cost: Column, rows: Column) -> Column:
    return ratio_if_positive(cost, rows)


def cost_per_mib(cost: Column, size: Column) -> Column:
    return F.when(size > 0, cost / (double(size) / F.lit(MIB)))


def scaled_by_count(count: Column, average: Column) -> Column:
    """Estimated saving or spend: how often, times the average of one run."""
    return count * average


def reuse_rate(reused: Column, others: Column) -> Column:
    """Percentage reused, 2 decimals; 100 where there is nothing to compare with."""
    rate = F.round(double(reused) * F.lit(100.0) / double(reused + others), 2)
    return F.when(others > 0, rate).otherwise(F.lit(100.0))


def saved_per_reuse(average: Column, reused: Column) -> Column:
    """The average of one run divided by the reuse count, 4 decimals; 0 without reuse.

    The name is kept from the reports that use it; it is not a saving per reuse.
    """
    return F.when(reused > 0, F.round(average / double(reused), 4)).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Percentage with 2 decimals, NULL for an empty whole."""
    return F.round(F.try_divide(double(part), double(whole)) * F.lit(100.0), 2)
