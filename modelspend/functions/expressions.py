"""Scalar expressions shared by the cost plans. All divide as doubles."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KIB = 1024.0
MIB = KIB**2
GIB = KIB**3
TIB = KIB**4


def lit_timestamp(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def lit_date(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def double(value: Column) -> Column:
    return value.cast("double")


def gib(size: Column) -> Column:
    return double(size) / F.lit(GIB)


def ms_to_seconds(ms: Column) -> Column:
    return double(ms) / F.lit(1000.0)


def ms_to_minutes(ms: Column) -> Column:
    return double(ms) / F.lit(1000.0) / F.lit(60.0)


def ms_to_hours(ms: Column) -> Column:
    return double(ms) / F.lit(3600000.0)


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Elapsed whole seconds, the fraction cut off."""
    return F.timestamp_diff("SECOND", start, end)


def ms_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def second_boundaries_between(start: Column, end: Column) -> Column:
    """Number of whole-second marks crossed, ignoring fractions on both ends."""
    return naive_seconds(end) - naive_seconds(start)


def naive_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 on a naive clock; no time zone of the session has a part in it."""
    days = F.datediff(ts, F.lit(date(1970, 1, 1))).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def overlap_seconds(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Whole seconds two time ranges share; 0 when they do not meet."""
    shared = whole_seconds_between(F.greatest(start_a, start_b), F.least(end_a, end_b))
    return F.greatest(shared, F.lit(0).cast("long"))


def preview(text: Column, length: int = 200) -> Column:
    return F.substring(text, 1, length)


def to_naive_utc(value: Column, dtype: T.DataType) -> Column:
    """An instant as a naive UTC timestamp; a naive one passes through."""
    if isinstance(dtype, T.TimestampNTZType):
        return value
    return F.to_utc_timestamp(value, F.current_timezone()).cast("timestamp_ntz")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / double(denominator))


def compute_resource(cluster_id: Column, warehouse_id: Column) -> Column:
    return F.coalesce(cluster_id, warehouse_id)


def mentions(text: Column, table: str) -> Column:
    """``text LIKE '%table%'``, where '_' stands for any one character and '%' for any text.

    A search for the longest plain part comes first; only statements that contain
    it are matched against the whole pattern.
    """
    parts = re.split(r"([_%])", table)
    wildcards = {"_": ".", "%": ".*"}
    pattern = "(?s)" + "".join(wildcards.get(p, re.escape(p)) for p in parts)
    plain = max((p for p in parts if p not in wildcards), key=len)
    return text.contains(plain) & text.rlike(pattern)
