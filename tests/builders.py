"""Small input tables for tests: defaults plus what a test cares about."""

from __future__ import annotations

from datetime import date, datetime

from modelspend import schemas as S
from modelspend.config import Settings, Sources

SETTINGS = Settings(
    monitor_start=datetime(2024, 1, 1),
    as_of=date(2024, 2, 1),
    summary_start=date(2024, 1, 1),
    summary_end=date(2024, 1, 31),
)


def at(hour: int, minute: int = 0, second: int = 0, day: int = 1) -> datetime:
    return datetime(2024, 1, day, hour, minute, second)


def table(spark, schema, rows, **defaults):
    """A DataFrame with ``schema``; missing columns come from ``defaults`` or are NULL."""
    data = [tuple({**defaults, **row}.get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(data, schema)


def executions(spark, *rows):
    return table(
        spark,
        S.EXECUTIONS,
        rows,
        model_name="orders",
        relation_name="model.shop.orders",
        model_package="shop",
        model_type="table",
        status="success",
        execution_time=10.0,
        invocation_id="inv",
        query_id="none",
        insert_timestamp=at(23),
        run_started_at=at(0),
        node_config="{}",
        **{S.RUN_ID: "run", S.JOB_ID: "job", S.PROJECT_ID: "prj", S.VERSION: "1"},
    )


def comment(node_id="model.shop.orders", node_name="orders", run="run", job="job", inv="inv"):
    return (
        f'/* {{"invocation_id": "{inv}", "{S.JOB_ID}": "{job}", "{S.RUN_ID}": "{run}", '
        f'"node_id": "{node_id}", "node_name": "{node_name}"}} */ select 1'
    )


def usage_history(spark, *rows):
    return table(
        spark,
        S.USAGE_HISTORY,
        rows,
        statement_id="q",
        start_time=at(10),
        end_time=at(10, 1),
        execution_duration_ms=60000,
        compute=(None, "wh", "WAREHOUSE"),
        workspace_id="ws",
        read_rows=1,
        read_bytes=1024**3,
        produced_rows=10,
        written_bytes=1024**2,
        statement_text=comment(),
        execution_status="FINISHED",
    )


def billing_usage(spark, *rows):
    return table(
        spark,
        S.BILLING_USAGE,
        rows,
        record_id="u",
        workspace_id="ws",
        usage_metadata=(None, "wh"),
        usage_start_time=at(10),
        usage_end_time=at(11),
        usage_quantity=10.0,
        sku_name="SKU",
        billing_origin_product="SQL",
    )


def list_prices(spark, *rows):
    return table(
        spark,
        S.LIST_PRICES,
        rows,
        sku_name="SKU",
        pricing=((0.5,),),
        price_start_time=datetime(2023, 1, 1),
    )


def job_runs(spark, *rows):
    return table(
        spark, S.JOB_RUNS, rows, **{S.RUN_ID: "run", S.JOB_ID: "job", S.ENVIRONMENT_ID: "env", S.PROJECT_ID: "prj"}
    )


def credit_history(spark, *rows):
    return table(
        spark,
        S.CREDIT_HISTORY,
        rows,
        query_id="q",
        query_text=comment(),
        database_name="SHOP",
        credits_used_cloud_services=1.0,
        total_elapsed_time=1000,
        execution_time=900,
        bytes_scanned=1024**3,
        start_time=at(10),
    )


def attribution(spark, *rows):
    return table(spark, S.QUERY_ATTRIBUTION, rows, query_id="q", credits_attributed_compute=2.0)


def jobs(spark, *rows):
    return table(
        spark,
        S.JOBS,
        rows,
        job_id="q",
        job_type="QUERY",
        project_id="shop",
        query=comment(),
        destination_table=("orders",),
        total_bytes_billed=1024**4,
        total_slot_ms=3600000,
        total_bytes_processed=1024**3,
        cache_hit=False,
        creation_time=at(10),
        start_time=at(10),
        end_time=at(10, 1),
    )


def rpu_history(spark, *rows):
    return table(
        spark,
        S.RPU_HISTORY,
        rows,
        query_id=1,
        query_text=comment(),
        database_name="shop",
        elapsed_time=5,
        execution_time=4,
        queue_time=1,
        start_time=at(10),
        end_time=at(10, 0, 30),
    )


def serverless_usage(spark, *rows):
    return table(
        spark, S.SERVERLESS_USAGE, rows, start_time=at(10), end_time=at(10, 1), charged_seconds=3600
    )


def node_history(spark, *rows):
    return table(
        spark,
        S.NODE_HISTORY,
        rows,
        query_id=1,
        user_id=100,
        query_text=comment(),
        database_name="shop",
        start_time=at(10),
        end_time=at(10, 0, 30),
    )


def sources(**tables):
    return Sources(**tables)


def dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def one(df):
    rows = dicts(df)
    assert len(rows) == 1, rows
    return rows[0]
