"""Table checks that return the offending rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their ``count``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
