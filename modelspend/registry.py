"""The engine's queries over the derived input tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.functions import costs
from modelspend.functions import expressions as E
from modelspend.functions import metadata as M
from modelspend.functions.tracking_json import node_config_json
from modelspend.operators import allocation as A
from modelspend.operators import history as H
from modelspend.operators import quality as Q
from modelspend.operators import stored_history as T
from modelspend.plans import daily_state, facts, histories, ingest, reports, tracking
from modelspend.plans.views import BYTES_SLOTS, CREDITS
from modelspend.sources import fixtures as X
from modelspend.sources.staging import CHECKPOINT_DIR, WAREHOUSE_DIR, Stages, unstaged
from modelspend.sources.tables import Dated
from modelspend.streaming.ingest import record_executions, record_job_runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SETTINGS = X.SETTINGS
SNAPSHOT_NOW = datetime(2030, 1, 1)
# A bound in the middle of a day and of the data.
RECENT = replace(SETTINGS, monitor_start=datetime(2024, 1, 15, 12, 30))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stages(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Stages in the session's shared folder; nothing is stored where it names none."""
    return Stages(spark, spark.conf.get(CHECKPOINT_DIR)) if spark.conf.get(CHECKPOINT_DIR, None) else unstaged


def new_folder(spark: SparkSession) -> str:
    """A folder for the queries that write tables: in the shared folder, or in the warehouse where none is named."""
    return Stages(spark, spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(WAREHOUSE_DIR)).folder


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --------------------------------------------------------------------- tracking


@query
def tracking_union(spark, sf_dir):
    executions = X.sources(spark, sf_dir, "executions").executions
    sources = X.Sources(executions=executions, extra_executions=(executions,))
    return tracking.tracking_union(sources.load_executions(spark))


@query
def eligible_executions(spark, sf_dir):
    return tracking.eligible_executions(X.sources(spark, sf_dir, "executions").executions, S.RUN_ID)


@query
def dedup_job_runs(spark, sf_dir):
    return tracking.dedup_job_runs(X.sources(spark, sf_dir, "job_runs").job_runs)


# ------------------------------------------------------------- filtered sources


@query
def scan_usage_history(spark, sf_dir):
    return histories.usage_history(X.sources(spark, sf_dir, "usage_history").usage_history, SETTINGS)


@query
def scan_billing_usage(spark, sf_dir):
    usage = X.sources(spark, sf_dir, "billing_usage").billing_usage
    return A.usage_periods(histories.billing_usage(usage, SETTINGS))


@query
def scan_credit_history(spark, sf_dir):
    return histories.credit_history(X.sources(spark, sf_dir, "credit_history").credit_history, SETTINGS)


@query
def scan_jobs(spark, sf_dir):
    scanned = histories.jobs(X.sources(spark, sf_dir, "jobs").jobs, SETTINGS)
    return scanned.withColumn("destination_table", F.col("destination_table.table_id"))


@query
def scan_rpu_history(spark, sf_dir):
    return histories.rpu_history(X.sources(spark, sf_dir, "rpu_history").rpu_history, SETTINGS)


@query
def scan_node_history(spark, sf_dir):
    return histories.node_history(X.sources(spark, sf_dir, "node_history").node_history, SETTINGS)


# --------------------------------------------------------------------- metadata


@query
def metadata_extract_struct(spark, sf_dir):
    history = X.sources(spark, sf_dir, "usage_history").usage_history
    parsed = M.extract_query_metadata(F.col("statement_text"))
    return history.select("statement_id", parsed.alias("m")).select("statement_id", "m.*")


@query
def metadata_extract_variant(spark, sf_dir):
    history = X.sources(spark, sf_dir, "credit_history").credit_history
    parsed = history.select("query_id", M.extract_query_variant(F.col("query_text")).alias("m"))
    keys = (S.JOB_ID, S.RUN_ID, "node_name", "node_id")
    return parsed.select("query_id", *[M.variant_text(F.col("m"), k).alias(k) for k in keys])


@query
def metadata_extract_guarded(spark, sf_dir):
    history = X.sources(spark, sf_dir, "rpu_history").rpu_history
    parsed = history.select("query_id", M.guarded_comment_json(F.col("query_text")).alias("query_metadata"))
    return parsed.withColumn("extracted_node_id", M.json_text(F.col("query_metadata"), "node_id"))


@query
def query_comment_build(spark, sf_dir):
    """Comments for every event: errors have no node, odd days no job."""
    events = X.Inputs(spark, sf_dir).events
    node = F.when(
        F.col("event_type") != "error",
        F.struct(
            F.col("node_id").alias("unique_id"),
            F.col("model").alias("name"),
            F.lit("shop").alias("package_name"),
            F.lit("shop").alias("database"),
            F.lit("main").alias("schema"),
            F.col("model").alias("identifier"),
        ),
    )
    comment = M.query_comment_json(
        invocation_id=F.col("inv"),
        job_id=F.when(F.col("dom") % 2 == 0, F.col("job")),
        run_id=F.col("run"),
        node=F.col("node"),
    )
    statements = events.select(
        "event_id", "inv", "dom", "job", "run", node.alias("node"), F.concat(F.lit("select "), "props").alias("sql")
    )
    return M.with_query_comment(statements, "sql", comment).select("event_id", "query_text")


# ----------------------------------------------------------------------- ingest


@query
def ingest_executions(spark, sf_dir):
    rows = ingest.ingest_executions(X.run_results(X.Inputs(spark, sf_dir)), X.INSERTED_AT)
    return rows.drop("node_config")


@query
def ingest_job_runs(spark, sf_dir):
    return ingest.ingest_job_runs(X.run_environments(X.Inputs(spark, sf_dir)))


@query
def node_config(spark, sf_dir):
    results = X.run_results(X.Inputs(spark, sf_dir))
    json = node_config_json(F.col("node"), results.schema["node"].dataType)
    return results.select("run_started_at", json.alias("node_config"))


NTZ_AS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _recorded(spark, rows, record, **options):
    """Result files recorded in two arrivals, then offered again to a stream without checkpoint."""
    folder = new_folder(spark)
    arriving, table = f"{folder}/arriving", f"{folder}/table"
    for part in (F.col("run_started_at") < "2024-01-12", F.col("run_started_at") >= "2024-01-12"):
        rows.filter(part).write.mode("append").option("timestampNTZFormat", NTZ_AS_TEXT).json(arriving)
        record(spark, arriving, table, f"{folder}/checkpoint", rows.schema, **options).awaitTermination()
    record(spark, arriving, table, f"{folder}/another-checkpoint", rows.schema, **options).awaitTermination()
    return table


@query
def append_executions(spark, sf_dir):
    results = X.run_results(X.Inputs(spark, sf_dir))
    table = _recorded(spark, results, record_executions, insert_timestamp=X.INSERTED_AT)
    return X.Sources(executions=table).load(spark, "executions").drop("node_config")


@query
def append_job_runs(spark, sf_dir):
    table = _recorded(spark, X.run_environments(X.Inputs(spark, sf_dir)), record_job_runs)
    return X.Sources(job_runs=table).load(spark, "job_runs")


# ------------------------------------------------------------- partitioned sources


def _dated(spark, df, at):
    """A copy of a table in a folder per day of ``at``, and a batch of it committed beside them."""
    path = f"{new_folder(spark)}/dated"
    df.withColumn("day", F.to_date(at)).repartition("day").write.partitionBy("day").parquet(path)
    return Dated(path, "day")


@query
def scan_dated_history(spark, sf_dir):
    """Statements since the middle of a day, from a history in day folders."""
    dated = _dated(spark, X.sources(spark, sf_dir, "usage_history").usage_history, "start_time")
    loaded = X.Sources(usage_history=dated).load(spark, "usage_history", RECENT.monitor_start)
    return histories.usage_history(loaded, RECENT)


@query
def scan_dated_billing(spark, sf_dir):
    dated = _dated(spark, X.sources(spark, sf_dir, "billing_usage").billing_usage, "usage_start_time")
    loaded = X.Sources(billing_usage=dated).load(spark, "billing_usage", RECENT.monitor_start)
    return A.usage_periods(histories.billing_usage(loaded, RECENT))


@query
def fact_credits_dated(spark, sf_dir):
    """The credits fact of recent statements, all tables of statements in day folders."""
    sources = X.sources(spark, sf_dir, *CREDIT_TABLES)
    sources = replace(sources, credit_history=_dated(spark, sources.credit_history, "start_time"))
    return facts.fact_credits(spark, sources, RECENT)


@query
def scan_other_database(spark, sf_dir):
    """Statements of one of two databases."""
    history = X.sources(spark, sf_dir, "credit_history").credit_history
    two = history.withColumn("database_name", F.when(F.col("total_elapsed_time") % 3 == 0, "OTHER").otherwise("SHOP"))
    return histories.credit_history(two, replace(SETTINGS, database="other"))


@query
def tracking_union_older(spark, sf_dir):
    """An older log, with fewer columns and narrower types, above the present one."""
    executions = X.sources(spark, sf_dir, "executions").executions
    older = executions.drop("node_config", S.VERSION, "query_id").withColumn("execution_time", F.col("execution_time").cast("float"))
    sources = X.Sources(executions=executions, extra_executions=(older,))
    return tracking.tracking_union(sources.load_executions(spark))


# ------------------------------------------------------------------------ joins


@query
def execution_query_join_left(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "usage_history")
    return facts.usage_matches(spark, sources, SETTINGS, stages(spark)).left_join()


@query
def execution_query_join_job_run(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "credit_history")
    return facts.credit_matches(spark, sources, SETTINGS).matched


@query
def execution_query_join_invocation(spark, sf_dir):
    return facts.job_matches(spark, X.sources(spark, sf_dir, "executions", "jobs"), SETTINGS).matched


@query
def execution_query_join_job(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "rpu_history")
    return facts.rpu_matches(spark, sources, SETTINGS).matched


@query
def execution_query_join_job_provisioned(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "node_history")
    return facts.node_matches(spark, sources, SETTINGS).matched


def _own_runs(spark, sf_dir):
    """Runs recorded and statements tagged from the same runs, most of which have no id of their own."""
    inputs = X.Inputs(spark, sf_dir)
    return inputs, ingest.ingest_executions(X.own_run_results(inputs), X.INSERTED_AT)


RECORDED = ("query_id", "model_name", S.RUN_ID, S.JOB_ID, "invocation_id", "run_started_at")


@query
def recorded_runs_find_their_statements(spark, sf_dir):
    inputs, executions = _own_runs(spark, sf_dir)
    sources = X.Sources(executions=executions, usage_history=X.own_run_usage_history(inputs))
    return facts.usage_matches(spark, sources, SETTINGS, stages(spark)).left_join().select(*RECORDED)


@query
def recorded_jobs_find_their_statements(spark, sf_dir):
    inputs, executions = _own_runs(spark, sf_dir)
    sources = X.Sources(executions=executions, rpu_history=X.own_run_rpu_history(inputs))
    return facts.rpu_matches(spark, sources, SETTINGS).matched.select(*RECORDED)


# ------------------------------------------------------------------- allocation


def _usage(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "usage_history", "billing_usage", "list_prices")
    queries = A.query_spans(histories.usage_history(sources.usage_history, SETTINGS))
    periods = A.usage_periods(histories.billing_usage(sources.billing_usage, SETTINGS))
    return sources, queries, periods


@query
def usage_overlap_pairs(spark, sf_dir):
    _, queries, periods = _usage(spark, sf_dir)
    return A.usage_overlap_pairs(periods, queries).select(
        "record_id", "sku_name", "statement_id", "start_time", "end_time", "overlap_seconds"
    )


@query
def usage_period_totals(spark, sf_dir):
    _, queries, periods = _usage(spark, sf_dir)
    return A.usage_period_totals(periods, queries)


@query
def usage_allocation(spark, sf_dir):
    _, queries, periods = _usage(spark, sf_dir)
    return A.allocate_usage(queries, periods, stage=stages(spark))


@query
def usage_priced(spark, sf_dir):
    sources, _, _ = _usage(spark, sf_dir)
    return facts.usage_costs(spark, sources, SETTINGS, stages(spark))


@query
def window_containment(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "rpu_history", "serverless_usage")
    return A.window_containment(sources.serverless_usage, histories.rpu_history(sources.rpu_history, SETTINGS))


@query
def charged_seconds_per_query(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "rpu_history", "serverless_usage")
    queries = histories.rpu_history(sources.rpu_history, SETTINGS)
    return A.charged_seconds_per_query(sources.serverless_usage, queries)


# ------------------------------------------------------------------------ facts

USAGE_TABLES = ("executions", "usage_history", "billing_usage", "list_prices")
CREDIT_TABLES = ("executions", "credit_history", "query_attribution")
JOB_TABLES = ("executions", "jobs")


@query
def fact_usage_split(spark, sf_dir):
    return facts.fact_usage_split(spark, X.sources(spark, sf_dir, *USAGE_TABLES), SETTINGS, stages(spark))


@query
def fact_credits(spark, sf_dir):
    return facts.fact_credits(spark, X.sources(spark, sf_dir, *CREDIT_TABLES), SETTINGS)


@query
def fact_bytes_slots(spark, sf_dir):
    return facts.fact_bytes_slots(spark, X.sources(spark, sf_dir, *JOB_TABLES), SETTINGS)


@query
def fact_rpu(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "rpu_history", "serverless_usage")
    return facts.fact_rpu(spark, sources, SETTINGS, stage=stages(spark))


@query
def fact_node_time(spark, sf_dir):
    return facts.fact_node_time(spark, X.sources(spark, sf_dir, "executions", "node_history"), SETTINGS, stage=stages(spark))


# ---------------------------------------------------------------------- reports

# Results whose terms are not exact in binary.
USAGE_SUMS = [
    *[f"{p}_{m}" for m in ("dbus", "cost") for p in reports.AVG_MAX_TOTAL],
    "avg_execution_time_seconds",
]
USAGE_SAVINGS = ["estimated_dbus_saved", "estimated_cost_saved_usd"]
CREDIT_SUMS = ["avg_execution_time_seconds"]
BYTES_SUMS = [f"{p}_{m}" for m in ("capacity_cost", "slot_minutes") for p in reports.AVG_MAX_TOTAL]
BYTES_SAVINGS = ["estimated_slot_minutes_saved"]


def _usage_history(spark, sources):
    return reports.model_cost_history_usage(facts.fact_usage_split(spark, sources, SETTINGS, stages(spark)))


def _credit_daily(spark, sf_dir):
    sources = X.sources(spark, sf_dir, *CREDIT_TABLES, "job_runs")
    counts = reports.reuse_execute_counts(sources.executions, sources.job_runs)
    history = reports.model_cost_history_credits(facts.fact_credits(spark, sources, SETTINGS))
    return reports.daily_savings_credits(counts, history)


@query
def model_cost_history_usage(spark, sf_dir):
    return rounded(_usage_history(spark, X.sources(spark, sf_dir, *USAGE_TABLES)), *USAGE_SUMS)


@query
def model_cost_history_credits(spark, sf_dir):
    sources = X.sources(spark, sf_dir, *CREDIT_TABLES)
    history = reports.model_cost_history_credits(facts.fact_credits(spark, sources, SETTINGS))
    return rounded(history, *CREDIT_SUMS)


@query
def model_cost_history_bytes(spark, sf_dir):
    fact = facts.fact_bytes_slots(spark, X.sources(spark, sf_dir, *JOB_TABLES), SETTINGS)
    return rounded(reports.model_cost_history_bytes(fact, SETTINGS.rates), *BYTES_SUMS)


@query
def reuse_counts(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "job_runs")
    return reports.reuse_counts(sources.executions, sources.job_runs)


@query
def reuse_execute_counts(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "executions", "job_runs")
    return reports.reuse_execute_counts(sources.executions, sources.job_runs)


@query
def daily_savings_usage(spark, sf_dir):
    sources = X.sources(spark, sf_dir, *USAGE_TABLES, "job_runs")
    counts = reports.reuse_counts(sources.executions, sources.job_runs)
    daily = reports.daily_savings_usage(counts, _usage_history(spark, sources))
    return rounded(daily, *USAGE_SUMS, *USAGE_SAVINGS)


@query
def daily_savings_credits(spark, sf_dir):
    return rounded(_credit_daily(spark, sf_dir), *CREDIT_SUMS)


@query
def daily_savings_bytes(spark, sf_dir):
    sources = X.sources(spark, sf_dir, *JOB_TABLES, "job_runs")
    counts = reports.reuse_counts(sources.executions, sources.job_runs)
    fact = facts.fact_bytes_slots(spark, sources, SETTINGS)
    history = reports.model_cost_history_bytes(fact, SETTINGS.rates)
    return rounded(reports.daily_savings_bytes(counts, history), *BYTES_SUMS, *BYTES_SAVINGS)


@query
def savings_summary(spark, sf_dir):
    return reports.savings_summary(_credit_daily(spark, sf_dir), SETTINGS)


def _refreshed_state(spark, sf_dir, pricing, tables):
    """A state of days after a first load and a run with a day's new and other days' late executions."""
    stage = Stages(spark, new_folder(spark))
    sources = X.sources(spark, sf_dir, *tables, "job_runs")
    started, late = F.col("run_started_at"), F.col("status") == "error"
    on_time = (started < "2024-01-25") & ~(late & (started >= "2024-01-20"))
    path = f"{stage.folder}/state"
    first = replace(sources, executions=sources.executions.filter(on_time))
    for known, new in ((first, first.executions), (sources, sources.executions.filter(~F.coalesce(on_time, F.lit(False))))):
        daily_state.refresh_days(spark, path, known, SETTINGS, pricing, daily_state.days_of(new), stage)
    return path, sources


@query
def daily_savings_credits_stored(spark, sf_dir):
    path, sources = _refreshed_state(spark, sf_dir, CREDITS, CREDIT_TABLES)
    return rounded(daily_state.daily_savings(spark, path, sources, SETTINGS, CREDITS), *CREDIT_SUMS)


@query
def daily_savings_bytes_stored(spark, sf_dir):
    path, sources = _refreshed_state(spark, sf_dir, BYTES_SLOTS, JOB_TABLES)
    daily = daily_state.daily_savings(spark, path, sources, SETTINGS, BYTES_SLOTS)
    return rounded(daily, *BYTES_SUMS, *BYTES_SAVINGS)


@query
def savings_summary_stored(spark, sf_dir):
    path, sources = _refreshed_state(spark, sf_dir, CREDITS, CREDIT_TABLES)
    return daily_state.savings_summary(spark, path, sources, SETTINGS)


# ------------------------------------------------------------------ expressions


@query
def expr_unit_conversions(spark, sf_dir):
    history = X.sources(spark, sf_dir, "usage_history").usage_history
    ms, size = F.col("execution_duration_ms"), F.col("read_bytes")
    return history.select(
        "statement_id",
        E.ms_to_seconds(ms).alias("seconds"),
        E.ms_to_minutes(ms).alias("minutes"),
        E.ms_to_hours(ms).alias("hours"),
        E.gib(size).alias("gib"),
        costs.bytes_cost(size, SETTINGS.rates.per_tib).alias("on_demand_usd"),
        E.preview(F.col("statement_text")).alias("preview"),
    )


@query
def expr_time_differences(spark, sf_dir):
    jobs = X.sources(spark, sf_dir, "jobs").jobs
    start, end = F.col("start_time"), F.col("end_time")
    hour = F.expr("timestampadd(HOUR, hour(start_time), cast(to_date(start_time) AS timestamp_ntz))")
    next_hour = F.expr("timestampadd(HOUR, hour(start_time) + 1, cast(to_date(start_time) AS timestamp_ntz))")
    return jobs.select(
        "job_id",
        E.whole_seconds_between(start, end).alias("whole_seconds"),
        E.ms_between(start, end).alias("ms"),
        E.second_boundaries_between(start, end).alias("boundaries"),
        E.overlap_seconds(start, end, hour, next_hour).alias("seconds_in_first_hour"),
        F.to_date(start).alias("day"),
    )


@query
def expr_null_handling(spark, sf_dir):
    sources = X.sources(spark, sf_dir, "usage_history", "query_attribution")
    compute = F.col("compute")
    joined = sources.usage_history.join(
        sources.query_attribution, F.col("statement_id") == F.col("query_id"), "left"
    )
    return joined.select(
        "statement_id",
        E.compute_resource(compute["cluster_id"], compute["warehouse_id"]).alias("resource"),
        E.or_zero(F.col("credits_attributed_compute")).alias("credits"),
        costs.cost_per_row(F.col("credits_attributed_compute"), F.col("produced_rows")).alias("per_row"),
        costs.cost_per_mib(F.col("credits_attributed_compute"), F.col("written_bytes")).alias("per_mib"),
    )


@query
def expr_cost_formulas(spark, sf_dir):
    """Every per-query price formula on the same statements."""
    rates = SETTINGS.rates
    events = X.Inputs(spark, sf_dir).events
    ms, seconds = F.col("ms"), F.floor(F.col("ms") / 1000)
    return events.select(
        "event_id",
        costs.credit_cost(F.col("cents") / F.lit(1024.0), rates.per_credit).alias("credit_usd"),
        costs.bytes_cost(F.col("event_id") * 1048576, rates.per_tib).alias("bytes_usd"),
        costs.slot_cost(ms * 4, rates.per_slot_hour).alias("slot_usd"),
        costs.avg_slots(ms * 4, F.col("ts"), F.col("end")).alias("avg_slots"),
        costs.node_time_cost(seconds, rates.per_node_hour, rates.node_count).alias("node_usd"),
        costs.rpu_cost(seconds, rates.per_rpu_hour).alias("rpu_usd"),
    )


# ---------------------------------------------------------- checks and versions


@query
def not_null_violations(spark, sf_dir):
    return Q.not_null_violations(X.sources(spark, sf_dir, "executions").executions, "relation_name")


@query
def unique_violations(spark, sf_dir):
    return Q.unique_violations(X.sources(spark, sf_dir, "job_runs").job_runs, [S.RUN_ID])


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "cast(o_orderdate AS timestamp_ntz) AS updated_at",
    )


def _upsert_input(spark, sf_dir):
    """Orders as first loaded until their middle date, then all orders with later changes."""
    orders = _orders(spark, sf_dir)
    target = orders.filter("updated_at < timestamp_ntz'1996-07-01 00:00:00'")
    urgent = "o_orderpriority = '1-URGENT'"
    source = orders.selectExpr(
        "o_orderkey",
        f"CASE WHEN {urgent} THEN 'X' ELSE o_orderstatus END AS o_orderstatus",
        "o_orderpriority",
        f"CASE WHEN {urgent} THEN timestampadd(DAY, 400, updated_at) ELSE updated_at END AS updated_at",
    )
    return target, source


@query
def incremental_upsert(spark, sf_dir):
    target, source = _upsert_input(spark, sf_dir)
    return H.incremental_upsert(target, source, "o_orderkey", "updated_at")


@query
def upsert_stored(spark, sf_dir):
    """The same upsert of a stored table: a first load, then the buckets that change."""
    folder = Stages(spark, new_folder(spark))
    path = f"{folder.folder}/orders"
    for source in _upsert_input(spark, sf_dir):
        T.upsert_stored(spark, path, source, "o_orderkey", "updated_at", folder, buckets=8)
    return T.read_buckets(spark, path).drop(T.BUCKET)


@query
def snapshot_stored(spark, sf_dir):
    """Two runs of a stored history: the settled orders, then all orders with later changes."""
    folder = Stages(spark, new_folder(spark))
    path = f"{folder.folder}/orders"
    orders, (_, later) = _orders(spark, sf_dir), _snapshot_input(spark, sf_dir)
    for run, source in (("first", orders.filter("o_orderstatus <> 'P'")), ("second", later)):
        T.snapshot_stored_by_timestamp(spark, path, source, "o_orderkey", "updated_at", run, folder, buckets=8)
    return T.read_history(spark, path)


def _snapshot_input(spark, sf_dir):
    """A first snapshot of the orders that are not pending, and all orders as of later."""
    orders = _orders(spark, sf_dir)
    history = orders.filter("o_orderstatus <> 'P'").selectExpr(
        "*",
        "updated_at AS valid_from",
        "CASE WHEN o_orderpriority = '5-LOW' THEN timestampadd(DAY, 1, updated_at) END AS valid_to",
    )
    later = orders.selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderstatus END AS o_orderstatus",
        "o_orderpriority",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN timestampadd(DAY, 7, updated_at) ELSE updated_at END AS updated_at",
    )
    return history, later


@query
def snapshot_by_timestamp(spark, sf_dir):
    history, later = _snapshot_input(spark, sf_dir)
    return H.snapshot_by_timestamp(history, later, "o_orderkey", "updated_at")


@query
def snapshot_by_check(spark, sf_dir):
    history, later = _snapshot_input(spark, sf_dir)
    return H.snapshot_by_check(history, later, "o_orderkey", ["o_orderstatus"], SNAPSHOT_NOW)
