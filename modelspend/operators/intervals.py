"""Joins on time ranges, as equi-joins on time cells.

Without help Spark evaluates a range join as a nested loop, or as a hash join
whose every group is compared pairwise.  Here each side is expanded to the time
cells it touches and joined on (keys, level, cell); the exact range condition is
then checked on the few candidates that share a cell.

Cells come in levels, each 32 times wider than the one below.  A range lives on
the lowest level where it touches at most 33 cells, so an hour and a century
both expand to a handful of rows, and no range ever has to be cut or dropped.
Two ranges meet on the higher of their two levels, in the first cell they share:
each pair is found exactly once, with no ``distinct``.  A role is part of the
join key: a small-side row stands for itself on its own level and as a visitor above it;
a large-side row meets the former everywhere and visitors on its own level only.
So rows that are both above their own level never become candidates, and one
long range costs its own pairs, not all rows of its cell.

The larger side is expanded only on the levels the smaller side occupies, which a
scalar subquery over the smaller side finds out, so for ranges of similar length
it is hardly expanded at all.

A hot key is spread over its time cells, and adaptive execution splits a cell
that is still too big: the joins below are inner or left-anti joins, where
either side's (or the left side's) hot partition may be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 32  # how much wider the cells of the next level are
TOP_LEVEL = 6  # reached by ranges of centuries

HOUR = 3600
MINUTE = 60


@dataclass(frozen=True)
class Span:
    """Column names of a time range; a point in time has equal names."""

    start: str
    end: str

    @property
    def is_point(self) -> bool:
        return self.start == self.end

    def low(self) -> str:
        """First second of the range, as SQL; a reversed range is turned around."""
        return _seconds(self.start if self.is_point else f"least({self.start}, {self.end})")

    def high(self) -> str:
        return _seconds(self.start if self.is_point else f"greatest({self.start}, {self.end})")

    def level(self, width: int) -> str:
        """The lowest level on which the range touches at most 33 cells."""
        if self.is_point:
            return "0"
        steps = f"ceil(log({FANOUT}, ({self.high()} - {self.low()}) / {width}D)) - 1"
        return f"cast(least(greatest(coalesce({steps}, 0), 0), {TOP_LEVEL}) AS int)"


def _seconds(ts: str) -> str:
    """Seconds since 1970 on a naive clock, whatever the session's time zone."""
    days = f"cast(datediff({ts}, date'1970-01-01') AS bigint)"
    return f"({days} * 86400 + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def levels_in_use(df: DataFrame, span: Span, width: int) -> Column:
    """Scalar subquery: the distinct levels a side occupies, a handful of numbers."""
    return df.select(F.expr(span.level(width)).alias("level")).agg(F.collect_set("level")).scalar()


def in_cells(df: DataFrame, span: Span, peer_levels: Column, width: int, p: str, small: bool) -> DataFrame:
    """One row per cell a range touches, on each level where a peer may meet it.

    Adds, with prefix ``p``, the ``level`` and ``cell``, ``role`` (0 with a small-side
    row on its own level, 1 with one above it) and ``first`` (is this the range's
    first cell on the level).
    """
    spread = df.select(
        "*",
        F.expr(span.low()).alias(f"{p}low"),
        F.expr(span.high()).alias(f"{p}high"),
        F.expr(span.level(width)).alias(f"{p}level0"),
        peer_levels.alias(f"{p}peers"),
    )
    levels = f"array_distinct(transform({p}peers, l -> greatest(l, {p}level0)))"
    first = f"floor({p}low / ({width}D * power({FANOUT}D, l)))"
    last = f"floor({p}high / ({width}D * power({FANOUT}D, l)))"
    if small:
        roles = f"array(if(l = {p}level0, 0, 1))"
    else:
        # visitors come only from levels of the small side below this one
        roles = f"if(l = {p}level0 AND exists({p}peers, q -> q < {p}level0), array(0, 1), array(0))"
    place = f"named_struct('level', l, 'cell', c, 'role', r, 'first', c = {first})"
    cells = f"array({first})" if span.is_point else f"sequence({first}, {last})"
    places = f"flatten(transform({levels}, l -> flatten(transform({roles}, r -> transform({cells}, c -> {place})))))"
    names = [f"{p}{name}" for name in CELL]
    cells = spread.select("*", F.expr(f"inline({places})").alias(*names))
    return cells.drop(f"{p}low", f"{p}high", f"{p}level0", f"{p}peers")


CELL = ("level", "cell", "role", "first")


def interval_join(
    small: DataFrame,
    large: DataFrame,
    *,
    small_span: Span,
    large_span: Span,
    condition: Column,
    on: Sequence[tuple[str, str]] = (),
    width: int = HOUR,
    small_levels: Column | None = None,
) -> DataFrame:
    """Inner join of rows whose time ranges touch and that satisfy ``condition``.

    ``on`` pairs columns that must be equal.  ``condition`` is the exact test over
    both sides' columns (all names must differ between the sides) and may only
    accept ranges that have at least one instant in common.  ``width`` is the
    lowest cell width in seconds, about the length of typical ranges.  Which side
    is called small affects only the cost.  ``small_levels`` may give its
    :func:`levels_in_use` if they are cheaper to find elsewhere.
    """
    if small_levels is None:
        small_levels = levels_in_use(small, small_span, width)
    top = 0 if large_span.is_point else TOP_LEVEL
    small_cells = in_cells(small, small_span, F.expr(f"sequence(0, {top})"), width, "_s_", small=True)
    large_cells = in_cells(large, large_span, small_levels, width, "_l_", small=False)
    same_place = F.lit(True)
    for name in ("level", "role", "cell"):
        same_place = same_place & (F.col(f"_s_{name}") == F.col(f"_l_{name}"))
    for s, l in on:
        same_place = (F.col(s) == F.col(l)) & same_place
    once = F.col("_s_first") | F.col("_l_first")
    joined = small_cells.join(large_cells, same_place & once & condition, "inner")
    return joined.drop(*[f"{p}{name}" for p in ("_s_", "_l_") for name in CELL])


def without_match(
    left: DataFrame, matched: DataFrame, *, decided_by: Sequence[str], nullable: Sequence[str] = ()
) -> DataFrame:
    """Left rows with no match, for completing an inner join to a left join.

    ``decided_by`` are the left columns that decide whether a row matches, so
    equal rows share their fate and the matched side shrinks to distinct keys
    before it is shuffled.  Those in ``nullable`` may match while NULL.
    """
    keys = [*decided_by, *nullable]
    found = matched.select(*[F.col(k).alias(f"_m_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in decided_by:
        same = same & (F.col(k) == F.col(f"_m_{k}"))
    for k in nullable:
        same = same & F.col(k).eqNullSafe(F.col(f"_m_{k}"))
    return left.join(found, same, "left_anti")
