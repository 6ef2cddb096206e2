"""Joining recorded executions to the statements they issued."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend import schemas as S
from modelspend.functions.metadata import comment_json, is_alone, json_pair
from modelspend.operators.intervals import HOUR, Span, interval_join, without_match
from modelspend.sources.staging import unstaged

# Columns that carry a statement's metadata and start time into the join.
META = "_meta_"
AT = "_at"

# Execution column -> metadata key, per kind of history.
BY_RUN_AND_INVOCATION = {
    S.RUN_ID: S.RUN_ID,
    "model_name": "node_name",
    "invocation_id": "invocation_id",
}
BY_JOB_AND_RUN = {S.JOB_ID: S.JOB_ID, S.RUN_ID: S.RUN_ID, "model_name": "node_name"}
BY_JOB = {S.JOB_ID: S.JOB_ID, "model_name": "node_name"}


@dataclass(frozen=True)
class Matches:
    """Matched pairs, and on demand the executions without any statement."""

    executions: DataFrame
    pairs: DataFrame
    decided_by: tuple[str, ...]

    @property
    def matched(self) -> DataFrame:
        return self.pairs.drop("insert_timestamp")

    @property
    def unmatched(self) -> DataFrame:
        return without_match(
            self.executions, self.pairs, decided_by=self.decided_by, nullable=["relation_name"]
        ).drop("insert_timestamp")

    def left_join(self) -> DataFrame:
        return self.matched.unionByName(self.unmatched, allowMissingColumns=True)


def match_executions(
    executions: DataFrame,
    statements: DataFrame,
    keys: dict[str, str],
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> Matches:
    """Pair executions with statements that carry their ids and started during the run.

    ``statements`` holds ``_at`` (start time), ``_meta_<key>`` for every key and
    ``_meta_node_id``, plus output columns whose names differ from those of the
    executions.  A NULL ``relation_name`` accepts any node id.  ``stage`` may store
    the pairs, which spares a second reading of the statements when both parts of
    the result are used.
    """
    executions = executions.select(*S.FACT_EXECUTION_COLUMNS, "insert_timestamp")
    node_id = F.col(f"{META}node_id")
    in_run = (
        (F.col(AT) >= F.col("run_started_at"))
        & (F.col(AT) <= F.col("insert_timestamp"))
        & (node_id == F.coalesce(F.col("relation_name"), node_id))
    )
    outputs = [c for c in statements.columns if c != AT and not c.startswith(META)]
    joined = interval_join(
        executions,
        statements,
        small_span=Span("run_started_at", "insert_timestamp"),
        large_span=Span(AT, AT),
        condition=in_run,
        on=[(column, f"{META}{key}") for column, key in keys.items()],
        width=HOUR,
    )
    pairs = stage(joined.select(*executions.columns, *outputs))
    return Matches(executions, pairs, (*keys, "run_started_at", "insert_timestamp"))


def within_runs(history: DataFrame, at: str, executions: DataFrame) -> DataFrame:
    """Statements that started while any execution ran: no other can match one.

    The bounds are scalar subqueries over two columns of the executions, so they reach the scan
    and spare the search of the text.
    """
    first, last = executions.agg(F.min("run_started_at")), executions.agg(F.max("insert_timestamp"))
    return history.filter((F.col(at) >= first.scalar()) & (F.col(at) <= last.scalar()))


def with_metadata(
    history: DataFrame, text: str, keys: dict[str, str], pattern: str, mode: str, guarded: bool = False
) -> DataFrame:
    """Add the comment metadata a join by ``keys`` needs, as ``_meta_<key>`` columns.

    The struct is generated as a row of its own: filters that Catalyst derives
    from the join then test its columns instead of parsing the text again.  With
    ``guarded``, a comment that is not one whole JSON value has no metadata.
    """
    wanted = list(dict.fromkeys([*keys.values(), "node_id"]))
    fields = T.StructType([S.QUERY_METADATA[key] for key in wanted])
    raw = f"{META}json"
    found = history.withColumn(raw, comment_json(F.col(text), pattern, mode))
    if guarded:
        # columns of their own, so the text is searched and the JSON checked once per row
        found = found.withColumn(f"{META}pair", json_pair(F.col(raw)))
        found = found.withColumn(raw, F.when(is_alone(F.col(f"{META}pair")), F.col(raw))).drop(f"{META}pair")
    parsed = F.from_json(F.col(raw), fields)
    return found.select(*history.columns, F.inline(F.array(parsed)).alias(*[f"{META}{key}" for key in wanted]))
