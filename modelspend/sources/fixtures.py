"""The engine's input tables, derived from the ``events`` and ``region`` test tables.

Every table comes from all events: one statement per event, with the executions,
usage periods and usage windows grouped from them (see FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.config import Settings, Sources
from modelspend.functions.metadata import with_run_comment

SETTINGS = Settings(
    monitor_start=datetime(2024, 1, 1),
    as_of=date(2024, 2, 1),
    summary_start=date(2024, 1, 2),
    summary_end=date(2024, 1, 29),
)
INSERTED_AT = datetime(2024, 2, 1, 12, 30, 0)
OWN_PACKAGE = "modelspend"

# SQL with a metadata comment; some have none, some write the tracking table.
STATEMENT_BODY = f"""
    CASE WHEN event_id % 13 = 0 THEN concat('insert into {S.EXECUTIONS_TABLE} select ', event_id)
         ELSE concat('select ', event_id, ' as id from shop.', model, ' where kind = ''', event_type, '''')
    END"""
STATEMENT_COMMENT = f"""
    concat('/* {{"invocation_id": "', inv, '", "{S.JOB_ID}": "', job, '", "{S.RUN_ID}": "', run,
           '", "node_id": "', node_id, '", "node_name": "', model,
           '", "relation": {{"database": "shop", "schema": "main", "identifier": "', model, '"}}}} */ ')"""
STATEMENT_TEXT = f"""
    CASE WHEN event_id % 11 = 0 THEN {STATEMENT_BODY} ELSE concat({STATEMENT_COMMENT}, {STATEMENT_BODY}) END"""


class Inputs:
    """The test tables of one folder, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return _events(self.table("events"))

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")


def _events(raw: DataFrame) -> DataFrame:
    """Events with the values the other tables share."""
    return (
        raw.selectExpr(
            "event_id",
            "cast(ts AS timestamp_ntz) AS ts",
            "user_id",
            "event_type",
            "props",
            "user_id % 12 AS model_no",
            "user_id % 4 AS wh_no",
            "cast(round(value * 100) AS bigint) AS cents",
            "cast(round(value * 1000) AS bigint) AS ms",
        )
        .selectExpr(
            "*",
            "cast(to_date(ts) AS timestamp_ntz) AS day",
            "dayofmonth(ts) AS dom",
            "concat('run_', date_format(ts, 'yyyyMMdd')) AS run",
            "concat('inv_', date_format(ts, 'yyyyMMdd')) AS inv",
            "concat('job_', dayofmonth(ts) % 3) AS job",
            "concat('wh_', wh_no) AS wh",
            "concat('model_', model_no) AS model",
            "concat('model.shop.model_', model_no) AS node_id",
            "timestampadd(MILLISECOND, ms, ts) AS end",
        )
    )


def executions(inputs: Inputs) -> DataFrame:
    """One execution per day, model and half-day; model_99 never issued a statement."""
    columns = [
        "model_name",
        "relation_name",
        "'shop' AS model_package",
        "model_type",
        "status",
        "execution_time",
        "inv AS invocation_id",
        "'none' AS query_id",
        "timestampadd(HOUR, 20, day) AS insert_timestamp",
        f"run AS {S.RUN_ID}",
        f"job AS {S.JOB_ID}",
        f"'prj_1' AS {S.PROJECT_ID}",
        f"'1.9.0' AS {S.VERSION}",
        "day AS run_started_at",
        "'{}' AS node_config",
    ]
    busy = (
        inputs.events
        .selectExpr("day", "dom", "run", "inv", "job", "model_no", "model", "hour(ts) >= 12 AS late")
        .groupBy("day", "dom", "run", "inv", "job", "model_no", "model", "late")
        .count()
        .selectExpr(
            "day",
            "inv",
            "job",
            "CASE WHEN dom = 30 THEN 'none' ELSE run END AS run",
            "model AS model_name",
            "CASE WHEN model_no <> 7 THEN concat('model.shop.', model) END AS relation_name",
            "CASE WHEN model_no % 3 = 0 THEN 'view' ELSE 'table' END AS model_type",
            """CASE (model_no + dom) % 5 WHEN 0 THEN 'reused' WHEN 1 THEN 'reused' WHEN 2 THEN 'error'
               WHEN 3 THEN 'skipped' ELSE 'success' END AS status""",
            "cast(count AS double) AS execution_time",
        )
    )
    silent = (
        inputs.region
        .selectExpr("timestampadd(DAY, r_regionkey, timestamp_ntz'2024-01-02 00:00:00') AS day")
        .selectExpr(
            "day",
            "concat('inv_', date_format(day, 'yyyyMMdd')) AS inv",
            "concat('job_', dayofmonth(day) % 3) AS job",
            "concat('run_', date_format(day, 'yyyyMMdd')) AS run",
            "'model_99' AS model_name",
            "'model.shop.model_99' AS relation_name",
            "'table' AS model_type",
            "'reused' AS status",
            "cast(1 AS double) AS execution_time",
        )
    )
    return busy.unionByName(silent).selectExpr(*columns)


def job_runs(inputs: Inputs) -> DataFrame:
    """One row per day, and again for days with clicks: duplicates are part of the log."""
    ev = inputs.events
    days = ev.select("dom", "run", "job").distinct()
    again = ev.filter("event_type = 'click'").select("dom", "run", "job").distinct()
    return days.unionAll(again).selectExpr(
        f"run AS {S.RUN_ID}",
        f"job AS {S.JOB_ID}",
        f"concat('env_', dom % 2) AS {S.ENVIRONMENT_ID}",
        f"'prj_1' AS {S.PROJECT_ID}",
        f"'{{}}' AS {S.RUN_CONTEXT}",
    )


def usage_history(inputs: Inputs) -> DataFrame:
    return _usage_history(inputs.events, STATEMENT_TEXT)


def _usage_history(events: DataFrame, text: str) -> DataFrame:
    return events.selectExpr(
        "concat('q', event_id) AS statement_id",
        "concat('user_', user_id) AS executed_by",
        "'sql' AS client_application",
        "ts AS start_time",
        "end AS end_time",
        "ms AS execution_duration_ms",
        """named_struct('cluster_id', CASE WHEN wh_no = 3 THEN wh END,
                        'warehouse_id', CASE WHEN wh_no <> 3 THEN wh END,
                        'type', CASE WHEN wh_no = 3 THEN 'CLUSTER' ELSE 'WAREHOUSE' END) AS compute""",
        "'ws' AS workspace_id",
        "cents AS read_rows",
        "event_id * 1000 AS read_bytes",
        "event_id % 1000 AS produced_rows",
        "event_id % 7 * 1048576 AS written_bytes",
        f"{text} AS statement_text",
        "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS execution_status",
    )


def billing_usage(inputs: Inputs) -> DataFrame:
    """One usage period per warehouse and hour with events."""
    return (
        inputs.events
        .selectExpr("wh_no", "wh", "day", "hour(ts) AS hour")
        .groupBy("wh_no", "wh", "day", "hour")
        .count()
        .selectExpr(
            "concat('u_', wh, '_', date_format(day, 'yyyyMMdd'), '_', hour) AS record_id",
            "'ws' AS workspace_id",
            """named_struct('cluster_id', CASE WHEN wh_no = 3 THEN wh END,
                            'warehouse_id', CASE WHEN wh_no <> 3 THEN wh END) AS usage_metadata""",
            "timestampadd(HOUR, hour, day) AS usage_start_time",
            "timestampadd(HOUR, hour + 1, day) AS usage_end_time",
            "cast(count % 3 + 4 AS double) AS usage_quantity",
            "concat('SKU_', wh_no % 2) AS sku_name",
            "'SQL' AS billing_origin_product",
        )
    )


def list_prices(inputs: Inputs) -> DataFrame:
    """A current and an expired price per SKU, one SKU per region."""

    def prices(price: str, start: str, end: str) -> DataFrame:
        return inputs.region.selectExpr(
            "concat('SKU_', r_regionkey) AS sku_name",
            f"named_struct('effective_list', named_struct('default', {price})) AS pricing",
            f"timestamp_ntz'{start}' AS price_start_time",
            f"cast({end} AS timestamp_ntz) AS price_end_time",
        )

    current = prices("(r_regionkey + 1) * 0.25D", "2023-01-01 00:00:00", "NULL")
    expired = prices("9.0D", "2022-01-01 00:00:00", "'2023-01-01 00:00:00'")
    return current.unionByName(expired)


def credit_history(inputs: Inputs) -> DataFrame:
    """Credits are multiples of 1/1024, so their sums do not depend on the order."""
    return inputs.events.selectExpr(
        "concat('q', event_id) AS query_id",
        f"{STATEMENT_TEXT} AS query_text",
        "'SHOP' AS database_name",
        "wh AS warehouse_name",
        "'X-Small' AS warehouse_size",
        "cents / 1024D AS credits_used_cloud_services",
        "ms AS total_elapsed_time",
        "ms AS execution_time",
        "0L AS queued_overload_time",
        "event_id * 1048576 AS bytes_scanned",
        "ts AS start_time",
    )


def query_attribution(inputs: Inputs) -> DataFrame:
    """Compute credits of every statement but views, which ran without compute."""
    return (
        inputs.events
        .filter("event_type <> 'view'")
        .selectExpr("concat('q', event_id) AS query_id", "cents / 256D AS credits_attributed_compute")
    )


def jobs(inputs: Inputs) -> DataFrame:
    return inputs.events.selectExpr(
        "concat('q', event_id) AS job_id",
        "CASE WHEN event_type = 'signup' THEN 'LOAD' ELSE 'QUERY' END AS job_type",
        "'shop' AS project_id",
        f"{STATEMENT_TEXT} AS query",
        "concat('res_', wh_no) AS reservation_id",
        f"""named_struct('table_id', CASE WHEN event_id % 13 = 0 THEN '{S.EXECUTIONS_TABLE}'
                         ELSE model END) AS destination_table""",
        "event_id * 1048576 AS total_bytes_billed",
        "ms * (event_id % 5 + 1) AS total_slot_ms",
        "event_id * 524288 AS total_bytes_processed",
        "event_type = 'view' AS cache_hit",
        "ts AS creation_time",
        "ts AS start_time",
        "end AS end_time",
    )


def rpu_history(inputs: Inputs) -> DataFrame:
    return _rpu_history(inputs.events, STATEMENT_TEXT)


def _rpu_history(events: DataFrame, text: str) -> DataFrame:
    return events.selectExpr(
        "event_id AS query_id",
        f"{text} AS query_text",
        "'shop' AS database_name",
        "ms * 1000 AS elapsed_time",
        "ms * 900 AS execution_time",
        "ms * 100 AS queue_time",
        "ts AS start_time",
        "end AS end_time",
    )


def serverless_usage(inputs: Inputs) -> DataFrame:
    """One window per minute with events, charged one second per event."""
    return (
        inputs.events
        .selectExpr("timestampadd(MINUTE, hour(ts) * 60 + minute(ts), day) AS start_time")
        .groupBy("start_time")
        .count()
        .selectExpr("start_time", "timestampadd(MINUTE, 1, start_time) AS end_time", "count AS charged_seconds")
    )


def node_history(inputs: Inputs) -> DataFrame:
    return inputs.events.selectExpr(
        "event_id AS query_id",
        "user_id % 5 AS user_id",
        f"CASE WHEN event_id % 17 = 0 THEN concat('commit ', {STATEMENT_TEXT}) ELSE {STATEMENT_TEXT} END AS query_text",
        "'shop' AS database_name",
        "ts AS start_time",
        "end AS end_time",
    )


COMMANDS = ", ".join(f"'{c}'" for c in (*S.TRACKED_COMMANDS, "docs"))


def run_results(inputs: Inputs, extra: tuple[str, ...] = ()) -> DataFrame:
    """One result per event, over all commands and node types, some of the engine's own."""
    return inputs.events.selectExpr(
        *extra,
        f"array({COMMANDS})[cast(user_id % 5 AS int)] AS command",
        "inv AS invocation_id",
        "ts AS run_started_at",
        f"'1.9.0' AS {S.VERSION}",
        f"CASE WHEN dom % 2 = 0 THEN run END AS {S.RUN_ID}",
        f"CASE WHEN dom % 2 = 0 THEN job END AS {S.JOB_ID}",
        f"CASE WHEN dom % 2 = 0 THEN 'prj_1' ELSE 'none' END AS {S.PROJECT_ID}",
        "CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status",
        "ms / 1000D AS execution_time",
        "named_struct('query_id', CASE WHEN event_type <> 'view' THEN concat('q', event_id) END) AS adapter_response",
        f"""named_struct(
              'name', model, 'unique_id', node_id,
              'package_name', CASE WHEN model_no = 5 THEN '{OWN_PACKAGE}' ELSE 'shop' END,
              'resource_type', CASE event_type WHEN 'view' THEN 'model' WHEN 'click' THEN 'test'
                               WHEN 'purchase' THEN 'snapshot' WHEN 'signup' THEN 'unit_test' ELSE 'seed' END,
              'config', CASE WHEN wh_no <> 2 THEN named_struct(
                 'materialized', CASE WHEN model_no % 3 = 0 THEN 'view' ELSE 'table' END,
                 'group', CASE WHEN wh_no = 0 THEN wh END,
                 'tags', array('nightly', event_type),
                 'persist_docs', map('relation', true, 'columns', wh_no = 1),
                 'description', props,
                 'meta', map('owner', concat('user_', user_id))) END) AS node""",
    )


# A run of its own for every event; some have no run id, some no job id, some neither.
OWN_RUN = {
    "invocation_id": "concat('inv_', event_id)",
    S.RUN_ID: "CASE WHEN dom % 2 = 0 THEN concat('run_', event_id) END",
    S.JOB_ID: "CASE WHEN dom % 3 = 0 THEN concat('job_', event_id) END",
}


def own_run_results(inputs: Inputs) -> DataFrame:
    """The run results, each of a run of its own."""
    results = run_results(inputs, ("event_id", "dom"))
    return results.withColumns({key: F.expr(sql) for key, sql in OWN_RUN.items()}).drop("event_id", "dom")


def own_run_statements(inputs: Inputs) -> DataFrame:
    """Each event's statement with the comment its run writes; errors come from outside of any node."""
    node = """CASE WHEN event_type <> 'error' THEN named_struct('unique_id', node_id, 'name', model, 'package_name', 'shop',
        'database', 'shop', 'schema', 'main', 'identifier', model) END AS node"""
    runs = inputs.events.selectExpr(
        "*", "ts AS run_started_at", *[f"{sql} AS {key}" for key, sql in OWN_RUN.items()], node, f"{STATEMENT_BODY} AS body"
    )
    return with_run_comment(runs, "body", "node", "tagged")


def own_run_usage_history(inputs: Inputs) -> DataFrame:
    return _usage_history(own_run_statements(inputs), "tagged")


def own_run_rpu_history(inputs: Inputs) -> DataFrame:
    return _rpu_history(own_run_statements(inputs), "tagged")


def run_environments(inputs: Inputs) -> DataFrame:
    """One environment per event; odd days run outside the hosted scheduler."""
    hosted = (
        "run",
        "job",
        "'prj_1'",
        "concat('env_', wh_no)",
        "'acc_1'",
        "'prod'",
        "'deployment'",
        "'scheduled'",
        "event_type",
        r"""concat('it\'s "', event_type, '" \\ ', props, ' #$%^&*\n')""",
        "NULL",
        "NULL",
    )
    values = {key: f"CASE WHEN dom % 2 = 0 THEN {v} END" for key, v in zip(S.RUN_CONTEXT_KEYS, hosted)}
    values["invocation_id"] = "inv"
    values[S.VERSION] = "'1.9.0'"
    values["target_query_tag"] = "NULL"
    values["invocation_args"] = """concat('{"which":"run","threads":', wh_no, '}')"""
    return inputs.events.selectExpr(
        f"array({COMMANDS})[cast(user_id % 5 AS int)] AS command",
        "ts AS run_started_at",
        *[f"cast({value} AS string) AS {key}" for key, value in values.items()],
    )


TABLES: dict[str, Callable[[Inputs], DataFrame]] = {
    "executions": executions,
    "job_runs": job_runs,
    "usage_history": usage_history,
    "billing_usage": billing_usage,
    "list_prices": list_prices,
    "credit_history": credit_history,
    "query_attribution": query_attribution,
    "jobs": jobs,
    "rpu_history": rpu_history,
    "serverless_usage": serverless_usage,
    "node_history": node_history,
}


def sources(spark: SparkSession, sf_dir: str, *names: str) -> Sources:
    """The named input tables (all when none is named), as lazy DataFrames."""
    inputs = Inputs(spark, sf_dir)
    return Sources(**{name: TABLES[name](inputs) for name in names or TABLES})
