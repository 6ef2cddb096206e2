"""Names and schemas of the tables the engine reads and writes.

Timestamps are naive UTC (``TIMESTAMP_NTZ``); run with
``spark.sql.session.timeZone=UTC`` (see :func:`modelspend.config.session_settings`).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table, column and JSON key names that existing tracking tables,
# query texts and downstream reports already use.  Everything else in the
# package refers to them through these constants.
# ---------------------------------------------------------------------------
EXECUTIONS_TABLE = "dbt_model_executions"
JOB_RUNS_TABLE = "dbt_platform_job_runs"
FACT_VIEW = "fct_dbt_model_queries"
DAILY_SAVINGS_VIEW = "rpt_daily_sao_model_savings"
SUMMARY_VIEW = "agg_sao_savings_summary"

RUN_ID = "dbt_cloud_run_id"
JOB_ID = "dbt_cloud_job_id"
PROJECT_ID = "dbt_cloud_project_id"
ENVIRONMENT_ID = "dbt_cloud_environment_id"
VERSION = "dbt_version"
RUN_CONTEXT = "dbt_run_context"
CREDIT_EXECUTION_TIME = "snowflake_execution_time"

METADATA_KEYS = (
    "app",
    "dbt_version",
    "dbt_databricks_version",
    "databricks_sql_connector_version",
    "profile_name",
    "target_name",
    "node_id",
    "node_name",
    "dbt_cloud_job_id",
    "dbt_cloud_run_id",
    "invocation_id",
    "connection_name",
)

# JSON key -> default when the environment does not set it (None: no default).
RUN_CONTEXT_KEYS = {
    "dbt_cloud_run_id": None,
    "dbt_cloud_job_id": None,
    "dbt_cloud_project_id": "none",
    "dbt_cloud_environment_id": "none",
    "dbt_cloud_account_id": "none",
    "dbt_cloud_environment_name": "none",
    "dbt_cloud_environment_type": "none",
    "dbt_cloud_invocation_context": "none",
    "dbt_cloud_run_reason_category": "none",
    "dbt_cloud_run_reason": "none",
    "dbt_cloud_git_branch": "none",
    "dbt_cloud_git_sha": "none",
    "invocation_id": None,
    "dbt_version": None,
    "target_query_tag": "null",
    "invocation_args": None,
}

NONE_MARKER = "none"
IGNORED_MODEL = "model_queries"
UNSERIALIZABLE_CONFIG = '"non-serializable node config received"'
TRACKED_RESOURCE_TYPES = ("model", "test", "snapshot", "unit_test")
TRACKED_COMMANDS = ("run", "test", "build", "snapshot")
# ------------------------------------------------------------ end fixed values


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


STRING, LONG, DOUBLE, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TIMESTAMP = T.TimestampNTZType()

QUERY_METADATA = T.StructType([T.StructField(k, STRING) for k in METADATA_KEYS])

EXECUTIONS = _struct(
    model_name=STRING,
    relation_name=STRING,  # holds the node id, e.g. model.pkg.name
    model_package=STRING,
    model_type=STRING,
    status=STRING,
    execution_time=DOUBLE,
    invocation_id=STRING,
    query_id=STRING,
    insert_timestamp=TIMESTAMP,
    **{RUN_ID: STRING, JOB_ID: STRING, PROJECT_ID: STRING, VERSION: STRING},
    run_started_at=TIMESTAMP,
    node_config=STRING,
)

# What every execution log has; an older one may lack the other columns.
EXECUTION_KEYS = (
    "model_name",
    "relation_name",
    "model_package",
    "status",
    "invocation_id",
    "insert_timestamp",
    RUN_ID,
    JOB_ID,
    "run_started_at",
)

JOB_RUNS = _struct(
    **{RUN_ID: STRING, JOB_ID: STRING, ENVIRONMENT_ID: STRING, PROJECT_ID: STRING, RUN_CONTEXT: STRING}
)

RUN_RESULTS = _struct(
    command=STRING,
    invocation_id=STRING,
    run_started_at=TIMESTAMP,
    **{VERSION: STRING, RUN_ID: STRING, JOB_ID: STRING, PROJECT_ID: STRING},
    status=STRING,
    execution_time=DOUBLE,
    adapter_response=_struct(query_id=STRING),
    node=_struct(
        name=STRING,
        unique_id=STRING,
        package_name=STRING,
        resource_type=STRING,
        config=_struct(
            materialized=STRING,
            group=STRING,
            tags=T.ArrayType(STRING),
            persist_docs=T.MapType(STRING, BOOL),
            description=STRING,
            meta=T.MapType(STRING, STRING),
        ),
    ),
)

RUN_ENV = _struct(
    command=STRING, run_started_at=TIMESTAMP, **{key: STRING for key in RUN_CONTEXT_KEYS}
)

USAGE_HISTORY = _struct(
    statement_id=STRING,
    executed_by=STRING,
    client_application=STRING,
    start_time=TIMESTAMP,
    end_time=TIMESTAMP,
    execution_duration_ms=LONG,
    compute=_struct(cluster_id=STRING, warehouse_id=STRING, type=STRING),
    workspace_id=STRING,
    read_rows=LONG,
    read_bytes=LONG,
    produced_rows=LONG,
    written_bytes=LONG,
    statement_text=STRING,
    execution_status=STRING,
)

BILLING_USAGE = _struct(
    record_id=STRING,
    workspace_id=STRING,
    usage_metadata=_struct(cluster_id=STRING, warehouse_id=STRING),
    usage_start_time=TIMESTAMP,
    usage_end_time=TIMESTAMP,
    usage_quantity=DOUBLE,
    sku_name=STRING,
    billing_origin_product=STRING,
)

LIST_PRICES = _struct(
    sku_name=STRING,
    pricing=_struct(effective_list=_struct(default=DOUBLE)),
    price_start_time=TIMESTAMP,
    price_end_time=TIMESTAMP,
)

CREDIT_HISTORY = _struct(
    query_id=STRING,
    query_text=STRING,
    database_name=STRING,
    warehouse_name=STRING,
    warehouse_size=STRING,
    credits_used_cloud_services=DOUBLE,
    total_elapsed_time=LONG,
    execution_time=LONG,
    queued_overload_time=LONG,
    bytes_scanned=LONG,
    start_time=TIMESTAMP,
)

QUERY_ATTRIBUTION = _struct(query_id=STRING, credits_attributed_compute=DOUBLE)

JOBS = _struct(
    job_id=STRING,
    job_type=STRING,
    project_id=STRING,
    query=STRING,
    reservation_id=STRING,
    destination_table=_struct(table_id=STRING),
    total_bytes_billed=LONG,
    total_slot_ms=LONG,
    total_bytes_processed=LONG,
    cache_hit=BOOL,
    creation_time=TIMESTAMP,
    start_time=TIMESTAMP,
    end_time=TIMESTAMP,
)

RPU_HISTORY = _struct(
    query_id=LONG,
    query_text=STRING,
    database_name=STRING,
    elapsed_time=LONG,
    execution_time=LONG,
    queue_time=LONG,
    start_time=TIMESTAMP,
    end_time=TIMESTAMP,
)

SERVERLESS_USAGE = _struct(start_time=TIMESTAMP, end_time=TIMESTAMP, charged_seconds=LONG)

NODE_HISTORY = _struct(
    query_id=LONG,
    user_id=LONG,
    query_text=STRING,
    database_name=STRING,
    start_time=TIMESTAMP,
    end_time=TIMESTAMP,
)

# Execution columns that every fact carries (the query id comes from the history).
FACT_EXECUTION_COLUMNS = (
    "run_started_at",
    "model_name",
    "relation_name",
    "model_type",
    "model_package",
    JOB_ID,
    RUN_ID,
    "execution_time",
    "status",
    "invocation_id",
    VERSION,
)
