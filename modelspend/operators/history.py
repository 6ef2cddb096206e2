"""Keeping tables up to date: incremental upsert and versioned history.

Sources must be unique on the key (see ``unique_violations``); rows with a NULL
key match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend.functions.expressions import lit_timestamp

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def incremental_upsert(target: DataFrame, source: DataFrame, key: str, ts: str) -> DataFrame:
    """The target with source rows above its highest ``ts`` inserted, or replacing their key.

    The highest ``ts`` is a scalar subquery, so it becomes a pushed-down bound on
    the source scan.  A target without one, as before its first load, takes all rows.
    """
    highest = target.agg(F.max(ts)).scalar()
    fresh = source.filter(highest.isNull() | (F.col(ts) > highest))
    replaced = fresh.select(F.col(key).alias("_key"))
    kept = target.join(replaced, F.col(key) == F.col("_key"), "left_anti")
    return kept.unionByName(fresh)


def snapshot_by_timestamp(
    history: DataFrame, source: DataFrame, key: str | Sequence[str], updated_at: str
) -> DataFrame:
    """History with a new version where the source row is newer than the current version."""
    return _snapshot(
        history,
        source,
        key,
        changed=F.col(f"_new.{updated_at}") > F.col(f"_old.{VALID_FROM}"),
        valid_from=F.col(f"_new.{updated_at}"),
    )


def snapshot_by_check(
    history: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    check_columns: Sequence[str],
    now: datetime,
) -> DataFrame:
    """History with a new version where any checked column differs, NULLs compared as values."""
    differs = F.lit(False)
    for c in check_columns:
        differs = differs | ~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
    return _snapshot(history, source, key, changed=differs, valid_from=lit_timestamp(now))


def _snapshot(
    history: DataFrame, source: DataFrame, key: str | Sequence[str], changed: Column, valid_from: Column
) -> DataFrame:
    """One full outer join of current versions and source; closed versions pass through.

    Keys that left the source keep their current version open.  Rows with a NULL
    key can match nothing, so they go around the join: it would send all of them
    to one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = source.columns
    has_key = F.lit(True)
    same_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
        same_key = same_key & (F.col(f"_old.{k}") == F.col(f"_new.{k}"))

    is_current = F.col(VALID_TO).isNull()
    old = history.filter(is_current & has_key).select(F.struct(*columns, VALID_FROM).alias("_old"))
    new = source.select(F.struct(*columns).alias("_new"), has_key.alias("_has_key"))
    joined = old.join(new.filter("_has_key").drop("_has_key"), same_key, "full_outer")

    never = F.lit(None).cast(history.schema[VALID_TO].dataType)
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def version(row: str, start: Column, end: Column) -> Column:
        values = [F.col(f"{row}.{c}").alias(c) for c in columns]
        return F.struct(*values, start.alias(VALID_FROM), end.alias(VALID_TO))

    added_version = version("_new", valid_from, never)
    end = F.when(has_new & changed, valid_from).otherwise(never)
    kept = F.when(has_old, version("_old", F.col(f"_old.{VALID_FROM}"), end))
    added = F.when(has_new & (~has_old | changed), added_version)
    versions = joined.select(F.inline(F.array_compact(F.array(kept, added))))
    unkeyed = new.filter(~F.col("_has_key")).select(F.inline(F.array(added_version)))
    passed = history.filter(~is_current | ~has_key).select(*columns, VALID_FROM, VALID_TO)
    return passed.unionByName(versions).unionByName(unkeyed)
