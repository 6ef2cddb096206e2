"""DuckDB SQL for every registered query, over the same Parquet tables.

The derived input tables are common table expressions; ``sql`` prepends the ones
a query uses.  All ratios divide doubles, and a sum whose terms are not exactly
representable is rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import re

from modelspend import schemas as S

RUN, JOB, ENV, PRJ, VER = S.RUN_ID, S.JOB_ID, S.ENVIRONMENT_ID, S.PROJECT_ID, S.VERSION
START = "TIMESTAMP '2024-01-01 00:00:00'"
RECENT = "TIMESTAMP '2024-01-15 12:30:00'"
AS_OF = "DATE '2024-02-01'"
TRACKING = S.EXECUTIONS_TABLE

BODY = f"""CASE WHEN event_id % 13 = 0 THEN 'insert into {TRACKING} select ' || event_id
    ELSE 'select ' || event_id || ' as id from shop.' || model || ' where kind = ''' || event_type || '''' END"""
TEXT = f"""CASE WHEN event_id % 11 = 0 THEN {BODY} ELSE
    '/* {{"invocation_id": "' || inv || '", "{JOB}": "' || job || '", "{RUN}": "' || run
    || '", "node_id": "' || node_id || '", "node_name": "' || model
    || '", "relation": {{"database": "shop", "schema": "main", "identifier": "' || model || '"}}}} */ '
    || {BODY} END"""

CTES: dict[str, str] = {}

CTES["ev0"] = """SELECT event_id, ts, user_id, event_type, props, user_id % 12 AS model_no, user_id % 4 AS wh_no,
    CAST(round(value * 100) AS BIGINT) AS cents, CAST(round(value * 1000) AS BIGINT) AS ms FROM events"""
CTES["ev"] = """SELECT *, date_trunc('day', ts)::TIMESTAMP AS day0, day(ts) AS dom,
    'run_' || strftime(ts, '%Y%m%d') AS run, 'inv_' || strftime(ts, '%Y%m%d') AS inv,
    'job_' || (day(ts) % 3) AS job, 'wh_' || wh_no AS wh, 'model_' || model_no AS model,
    'model.shop.model_' || model_no AS node_id, ts + to_milliseconds(ms) AS ended FROM ev0"""

EXECUTION_TAIL = f"""'shop' AS model_package, model_type, status, execution_time, inv AS invocation_id,
    'none' AS query_id, day0 + INTERVAL 20 HOUR AS insert_timestamp, run AS {RUN}, job AS {JOB},
    'prj_1' AS {PRJ}, '1.9.0' AS {VER}, day0 AS run_started_at, '{{}}' AS node_config"""
CTES["ex_busy"] = """SELECT day0, inv, job, CASE WHEN dom = 30 THEN 'none' ELSE run END AS run, model AS model_name,
    CASE WHEN model_no <> 7 THEN 'model.shop.' || model END AS relation_name,
    CASE WHEN model_no % 3 = 0 THEN 'view' ELSE 'table' END AS model_type,
    CASE (model_no + dom) % 5 WHEN 0 THEN 'reused' WHEN 1 THEN 'reused' WHEN 2 THEN 'error'
        WHEN 3 THEN 'skipped' ELSE 'success' END AS status,
    CAST(count(*) AS DOUBLE) AS execution_time
    FROM ev GROUP BY day0, dom, run, inv, job, model_no, model, hour(ts) >= 12"""
CTES["ex_days"] = "SELECT TIMESTAMP '2024-01-02 00:00:00' + to_days(r_regionkey) AS day0 FROM region"
CTES["ex_silent"] = """SELECT day0, 'inv_' || strftime(day0, '%Y%m%d') AS inv, 'job_' || (day(day0) % 3) AS job,
    'run_' || strftime(day0, '%Y%m%d') AS run, 'model_99' AS model_name,
    'model.shop.model_99' AS relation_name, 'table' AS model_type, 'reused' AS status,
    CAST(1 AS DOUBLE) AS execution_time FROM ex_days"""
CTES["executions"] = f"""SELECT model_name, relation_name, {EXECUTION_TAIL} FROM ex_busy
    UNION ALL SELECT model_name, relation_name, {EXECUTION_TAIL} FROM ex_silent"""
CTES["job_runs"] = f"""SELECT run AS {RUN}, job AS {JOB}, 'env_' || (dom % 2) AS {ENV}, 'prj_1' AS {PRJ},
    '{{}}' AS {S.RUN_CONTEXT} FROM (SELECT DISTINCT dom, run, job FROM ev UNION ALL
    SELECT DISTINCT dom, run, job FROM ev WHERE event_type = 'click') d"""
CTES["usage_history"] = f"""SELECT 'q' || event_id AS statement_id, 'user_' || user_id AS executed_by,
    'sql' AS client_application, ts AS start_time, ended AS end_time, ms AS execution_duration_ms,
    CASE WHEN wh_no = 3 THEN wh END AS cluster_id, CASE WHEN wh_no <> 3 THEN wh END AS warehouse_id,
    CASE WHEN wh_no = 3 THEN 'CLUSTER' ELSE 'WAREHOUSE' END AS compute_type, 'ws' AS workspace_id,
    cents AS read_rows, event_id * 1000 AS read_bytes, event_id % 1000 AS produced_rows,
    event_id % 7 * 1048576 AS written_bytes, {TEXT} AS statement_text,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS execution_status FROM ev"""
CTES["billing_usage"] = """SELECT 'u_' || wh || '_' || strftime(day0, '%Y%m%d') || '_' || h AS record_id,
    'ws' AS workspace_id, CASE WHEN wh_no = 3 THEN wh END AS cluster_id,
    CASE WHEN wh_no <> 3 THEN wh END AS warehouse_id, day0 + to_hours(h) AS usage_start_time,
    day0 + to_hours(h + 1) AS usage_end_time, CAST(n % 3 + 4 AS DOUBLE) AS usage_quantity,
    'SKU_' || (wh_no % 2) AS sku_name, 'SQL' AS billing_origin_product
    FROM (SELECT wh_no, wh, day0, hour(ts) AS h, count(*) AS n FROM ev GROUP BY ALL) g"""
CTES["list_prices"] = """SELECT 'SKU_' || r_regionkey AS sku_name, (r_regionkey + 1) * 0.25::DOUBLE AS price,
    TIMESTAMP '2023-01-01' AS price_start_time, NULL::TIMESTAMP AS price_end_time FROM region
    UNION ALL SELECT 'SKU_' || r_regionkey, 9.0::DOUBLE, TIMESTAMP '2022-01-01', TIMESTAMP '2023-01-01' FROM region"""
CTES["credit_history"] = f"""SELECT 'q' || event_id AS query_id, {TEXT} AS query_text, 'SHOP' AS database_name,
    wh AS warehouse_name, 'X-Small' AS warehouse_size, cents / 1024::DOUBLE AS credits_used_cloud_services,
    ms AS total_elapsed_time, ms AS execution_time, 0::BIGINT AS queued_overload_time,
    event_id * 1048576 AS bytes_scanned, ts AS start_time FROM ev"""
CTES["query_attribution"] = """SELECT 'q' || event_id AS query_id, cents / 256::DOUBLE AS credits_attributed_compute
    FROM ev WHERE event_type <> 'view'"""
CTES["bq_jobs"] = f"""SELECT 'q' || event_id AS job_id,
    CASE WHEN event_type = 'signup' THEN 'LOAD' ELSE 'QUERY' END AS job_type, 'shop' AS project_id,
    {TEXT} AS query, 'res_' || wh_no AS reservation_id,
    CASE WHEN event_id % 13 = 0 THEN '{TRACKING}' ELSE model END AS table_id,
    event_id * 1048576 AS total_bytes_billed, ms * (event_id % 5 + 1) AS total_slot_ms,
    event_id * 524288 AS total_bytes_processed, event_type = 'view' AS cache_hit,
    ts AS creation_time, ts AS start_time, ended AS end_time FROM ev"""
CTES["rpu_history"] = f"""SELECT event_id AS query_id, {TEXT} AS query_text, 'shop' AS database_name,
    ms * 1000 AS elapsed_time, ms * 900 AS execution_time, ms * 100 AS queue_time,
    ts AS start_time, ended AS end_time FROM ev"""
CTES["serverless_usage"] = """SELECT date_trunc('minute', ts)::TIMESTAMP AS start_time,
    date_trunc('minute', ts)::TIMESTAMP + INTERVAL 1 MINUTE AS end_time, count(*) AS charged_seconds
    FROM ev GROUP BY ALL"""
CTES["node_history"] = f"""SELECT event_id AS query_id, user_id % 5 AS user_id,
    CASE WHEN event_id % 17 = 0 THEN 'commit ' ELSE '' END || {TEXT} AS query_text, 'shop' AS database_name,
    ts AS start_time, ended AS end_time FROM ev"""

# ------------------------------------------------------------ filtered histories

CTES["usage_scan"] = f"""SELECT * EXCLUDE (execution_status, statement_text), statement_text AS query_text,
    execution_duration_ms / 1000::DOUBLE AS execution_seconds,
    execution_duration_ms / 3600000::DOUBLE AS execution_hours, substr(statement_text, 1, 200) AS query_preview
    FROM usage_history WHERE start_time >= {START} AND execution_status = 'FINISHED'"""
CTES["credit_scan"] = f"""SELECT * FROM credit_history WHERE start_time >= {START} AND database_name = upper('shop')
    AND query_text NOT LIKE '%{TRACKING}%'"""
CTES["job_scan"] = f"""SELECT * FROM bq_jobs WHERE job_type = 'QUERY' AND creation_time >= {START}
    AND table_id <> '{TRACKING}' AND project_id = 'shop'"""
CTES["rpu_scan"] = f"SELECT * FROM rpu_history WHERE start_time >= {START} AND database_name = 'shop'"
CTES["node_scan"] = f"""SELECT *, date_diff('second', start_time, end_time) AS duration_seconds FROM node_history
    WHERE user_id > 1 AND start_time >= {START} AND database_name = 'shop'
    AND query_text NOT ILIKE 'COMMIT%' AND query_text NOT ILIKE 'BEGIN%' AND query_text NOT ILIKE 'FETCH%'
    AND query_text NOT ILIKE 'SET%' AND query_text NOT ILIKE 'INSERT INTO %'"""


def meta(pattern: str, text: str, *keys: str) -> str:
    comment = f"nullif(regexp_extract({text}, '{pattern}', 1), '')"
    return ", ".join(f"json_extract_string({comment}, '$.{key}') AS m_{key}" for key in keys)


ANY = r"/\* (.*?) \*/"
OBJECT = r"/\* (\{.*?\}) \*/"
SPACED = r"/\*\s*(\{.*?\})\s*\*/"

CTES["usage_meta"] = f"""SELECT *, {meta(ANY, 'query_text', RUN, 'node_id', 'node_name', 'invocation_id')}
    FROM usage_scan WHERE query_text NOT LIKE '%{TRACKING}%'"""
CTES["credit_meta"] = f"SELECT *, {meta(OBJECT, 'query_text', JOB, RUN, 'node_id', 'node_name')} FROM credit_scan"
CTES["job_meta"] = f"SELECT *, {meta(ANY, 'query', RUN, 'node_id', 'node_name', 'invocation_id')} FROM job_scan"
CTES["rpu_meta"] = f"SELECT *, {meta(SPACED, 'query_text', JOB, 'node_id', 'node_name')} FROM rpu_scan"
CTES["node_meta"] = f"SELECT *, {meta(SPACED, 'query_text', JOB, 'node_id', 'node_name')} FROM node_scan"

FACT = f"""e.run_started_at, e.model_name, e.relation_name, e.model_type, e.model_package, e.{JOB}, e.{RUN},
    e.execution_time, e.status, e.invocation_id, e.{VER}"""


def eligible(column: str) -> str:
    return f"e.{column} IS NOT NULL AND e.{column} <> 'none' AND e.model_name <> 'model_queries'"


def in_run(at: str) -> str:
    return f"""q.m_node_name = e.model_name AND q.m_node_id = coalesce(e.relation_name, q.m_node_id)
    AND q.{at} >= e.run_started_at AND q.{at} <= e.insert_timestamp"""


CTES["usage_join"] = f"""SELECT {FACT}, q.statement_id AS query_id, q.compute_type, q.cluster_id, q.warehouse_id,
    q.workspace_id, q.execution_duration_ms, q.execution_seconds, q.execution_hours, q.read_rows, q.read_bytes,
    q.produced_rows, q.written_bytes
    FROM executions e LEFT JOIN usage_meta q ON q.m_{RUN} = e.{RUN} AND q.m_invocation_id = e.invocation_id
    AND {in_run('start_time')} WHERE {eligible(RUN)}"""
CTES["credit_join"] = f"""SELECT {FACT}, q.query_id, q.warehouse_name, q.warehouse_size,
    q.credits_used_cloud_services, q.bytes_scanned, q.total_elapsed_time,
    q.execution_time AS {S.CREDIT_EXECUTION_TIME}, q.start_time AS query_start_time
    FROM executions e JOIN credit_meta q ON q.m_{JOB} = e.{JOB} AND q.m_{RUN} = e.{RUN}
    AND {in_run('start_time')} WHERE {eligible(JOB)}"""
CTES["job_join"] = f"""SELECT {FACT}, q.job_id AS query_id, q.reservation_id, q.total_bytes_billed, q.total_slot_ms,
    q.total_bytes_processed, q.cache_hit, q.creation_time AS query_creation_time,
    q.start_time AS query_start_time, q.end_time AS query_end_time
    FROM executions e JOIN job_meta q ON q.m_{RUN} = e.{RUN} AND q.m_invocation_id = e.invocation_id
    AND {in_run('creation_time')} WHERE {eligible(JOB)}"""
CTES["rpu_join"] = f"""SELECT {FACT}, q.query_id, q.query_text, q.elapsed_time,
    q.execution_time AS query_execution_time, q.queue_time
    FROM executions e JOIN rpu_meta q ON q.m_{JOB} = e.{JOB} AND {in_run('start_time')} WHERE {eligible(JOB)}"""
CTES["node_join"] = f"""SELECT {FACT}, q.query_id, q.user_id, q.query_text, q.start_time, q.end_time,
    q.duration_seconds
    FROM executions e JOIN node_meta q ON q.m_{JOB} = e.{JOB} AND {in_run('start_time')} WHERE {eligible(JOB)}"""

# ------------------------------------------------------------------- allocation

OVERLAP = """greatest(date_sub('second', greatest(q.start_time, u.usage_start_time),
    least(q.end_time, u.usage_end_time)), 0)"""
MEETS = """q.workspace_id = u.usage_workspace_id AND q.resource_id = u.compute_resource_id
    AND q.start_time < u.usage_end_time AND q.end_time > u.usage_start_time"""

CTES["q_spans"] = """SELECT statement_id, workspace_id, coalesce(cluster_id, warehouse_id) AS resource_id,
    start_time, end_time FROM usage_scan"""
CTES["u_periods"] = f"""SELECT record_id, workspace_id AS usage_workspace_id,
    coalesce(cluster_id, warehouse_id) AS compute_resource_id, usage_start_time, usage_end_time, usage_quantity,
    sku_name, billing_origin_product FROM billing_usage WHERE usage_start_time >= {START}"""
CTES["u_totals"] = f"""SELECT u.*, CAST(sum({OVERLAP}) AS BIGINT) AS total_query_execution_seconds
    FROM u_periods u LEFT JOIN q_spans q ON {MEETS} GROUP BY ALL"""
CTES["q_shares"] = f"""SELECT q.*, u.sku_name, CASE WHEN u.total_query_execution_seconds > 0
    THEN u.usage_quantity * CAST({OVERLAP} AS DOUBLE) / u.total_query_execution_seconds ELSE 0 END AS dbus_consumed
    FROM q_spans q LEFT JOIN u_totals u ON {MEETS}"""
CTES["q_costs"] = f"""SELECT s.*, p.price AS dbu_unit_price, s.dbus_consumed * p.price AS estimated_cost_usd
    FROM q_shares s LEFT JOIN list_prices p ON p.sku_name = s.sku_name AND {AS_OF} >= p.price_start_time::DATE
    AND (p.price_end_time IS NULL OR {AS_OF} < p.price_end_time::DATE)"""
CTES["contained"] = """SELECT w.start_time AS window_start, w.end_time AS window_end, w.charged_seconds,
    q.query_id, q.start_time, q.end_time FROM serverless_usage w JOIN rpu_scan q
    ON q.start_time >= w.start_time AND q.end_time <= w.end_time"""
CTES["charged"] = """SELECT query_id, CAST(sum(charged_seconds) AS BIGINT) AS total_charged_seconds
    FROM contained GROUP BY query_id"""

# ------------------------------------------------------------------------ facts

CTES["fact_usage"] = """SELECT e.*, c.dbus_consumed, c.dbu_unit_price, c.sku_name, c.estimated_cost_usd,
    e.read_bytes / 1073741824::DOUBLE AS gb_read, e.written_bytes / 1073741824::DOUBLE AS gb_written,
    CASE WHEN e.produced_rows > 0 THEN c.estimated_cost_usd / e.produced_rows END AS cost_per_row_produced,
    CASE WHEN e.written_bytes > 0 THEN c.estimated_cost_usd / (e.written_bytes / 1048576::DOUBLE) END
        AS cost_per_mb_written
    FROM usage_join e LEFT JOIN q_costs c ON c.statement_id = e.query_id"""
CTES["fact_credits"] = f"""SELECT p.* EXCLUDE (bytes_scanned, query_start_time),
    p.credits_used_cloud_services * 3::DOUBLE AS cloud_services_cost,
    p.bytes_scanned / 1073741824::DOUBLE AS gb_scanned, a.credits_attributed_compute,
    a.credits_attributed_compute * 3::DOUBLE AS attributed_compute_cost
    FROM credit_join p LEFT JOIN query_attribution a ON a.query_id = p.query_id AND p.query_start_time >= {START}"""
CTES["fact_bytes"] = """SELECT *, total_slot_ms / 1000::DOUBLE / 60::DOUBLE AS slot_minutes,
    total_slot_ms::DOUBLE / nullif(date_sub('millisecond', query_start_time, query_end_time), 0) AS job_avg_slots
    FROM job_join"""
CTES["fact_rpu"] = """SELECT p.*, c.total_charged_seconds::DOUBLE / 3600::DOUBLE * 0.36::DOUBLE AS estimated_cost_usd
    FROM rpu_join p JOIN charged c ON c.query_id = p.query_id"""
CTES["fact_node"] = """SELECT *, 0.543::DOUBLE * 1::DOUBLE / 3600::DOUBLE AS cluster_cost_per_second,
    duration_seconds::DOUBLE * (0.543::DOUBLE * 1::DOUBLE / 3600::DOUBLE) AS estimated_cost_usd FROM node_join"""

# ---------------------------------------------------------------------- reports

MODEL = "model_name, relation_name, model_package"
CTES["hist_usage"] = f"""SELECT {MODEL}, avg(dbus) AS avg_run_dbus, max(dbus) AS max_run_dbus,
    sum(dbus) AS total_run_dbus, avg(cost) AS avg_run_cost, max(cost) AS max_run_cost, sum(cost) AS total_run_cost,
    count(*) AS total_query_count, count(DISTINCT {RUN}) AS total_run_count,
    avg(execution_time) AS avg_execution_time_seconds, max(execution_time) AS max_execution_time_seconds,
    avg(gb_read) AS avg_gb_read, max(gb_read) AS max_gb_read
    FROM (SELECT {MODEL}, {RUN}, sum(dbus_consumed) AS dbus, sum(estimated_cost_usd) AS cost,
        avg(execution_time) AS execution_time, sum(gb_read) AS gb_read FROM fact_usage GROUP BY ALL) r
    GROUP BY {MODEL}"""
CTES["hist_credits"] = f"""SELECT {MODEL}, avg(credits) AS avg_run_credits, max(credits) AS max_run_credits,
    sum(credits) AS total_run_credits, sum(compute_credits) AS total_run_compute_credits,
    avg(cost) AS avg_run_cost, max(cost) AS max_run_cost, sum(cost) AS total_run_cost,
    sum(compute_cost) AS total_run_compute_cost, count(*) AS total_query_count,
    count(DISTINCT {RUN}) AS total_run_count, avg(execution_time) AS avg_execution_time_seconds,
    max(execution_time) AS max_execution_time_seconds, avg(gb_scanned) AS avg_gb_scanned,
    max(gb_scanned) AS max_gb_scanned
    FROM (SELECT {MODEL}, {RUN}, sum(credits_attributed_compute) AS compute_credits,
        sum(coalesce(credits_attributed_compute, 0) + coalesce(credits_used_cloud_services, 0)) AS credits,
        sum(attributed_compute_cost) AS compute_cost,
        sum(coalesce(attributed_compute_cost, 0) + coalesce(cloud_services_cost, 0)) AS cost,
        avg(execution_time) AS execution_time, sum(gb_scanned) AS gb_scanned FROM fact_credits GROUP BY ALL) r
    GROUP BY {MODEL}"""
CTES["hist_bytes"] = f"""SELECT {MODEL}, avg(on_demand) AS avg_run_on_demand_cost,
    max(on_demand) AS max_run_on_demand_cost, sum(on_demand) AS total_run_on_demand_cost,
    avg(capacity) AS avg_run_capacity_cost, max(capacity) AS max_run_capacity_cost,
    sum(capacity) AS total_run_capacity_cost, avg(slot_minutes) AS avg_run_slot_minutes,
    max(slot_minutes) AS max_run_slot_minutes, sum(slot_minutes) AS total_run_slot_minutes,
    avg(job_avg_slots) AS avg_slots_per_query, max(job_avg_slots) AS max_slots_per_query,
    avg(billed) AS avg_bytes_billed, max(billed) AS max_bytes_billed, CAST(sum(billed) AS BIGINT) AS total_bytes_billed,
    avg(processed) AS avg_bytes_processed, max(processed) AS max_bytes_processed, count(*) AS total_query_count,
    count(DISTINCT {RUN}) AS total_run_count, avg(execution_time) AS avg_execution_time_seconds,
    max(execution_time) AS max_execution_time_seconds
    FROM (SELECT {MODEL}, {RUN}, total_bytes_billed / 1099511627776::DOUBLE * 6.25::DOUBLE AS on_demand,
        total_slot_ms / 3600000::DOUBLE * 0.04::DOUBLE AS capacity, slot_minutes, job_avg_slots,
        total_bytes_billed AS billed, total_bytes_processed AS processed, execution_time FROM fact_bytes) r
    GROUP BY {MODEL}"""
CTES["runs"] = f"SELECT DISTINCT {RUN}, {ENV}, {PRJ} FROM job_runs"
CTES["reuse"] = f"""SELECT e.model_name, e.relation_name, e.model_package, e.run_started_at::DATE AS reuse_date,
    j.{ENV}, j.{PRJ}, count(*) AS reuse_count, count(DISTINCT e.{RUN}) AS unique_runs_reused
    FROM executions e LEFT JOIN runs j ON j.{RUN} = e.{RUN} WHERE e.status = 'reused' GROUP BY ALL"""
CTES["reuse_execute"] = f"""SELECT e.model_name, e.relation_name, e.model_package,
    e.run_started_at::DATE AS reuse_date, j.{ENV}, j.{PRJ},
    CAST(sum(CASE WHEN e.status = 'reused' THEN 1 ELSE 0 END) AS BIGINT) AS reuse_count,
    CAST(sum(CASE WHEN e.status IN ('success', 'error') THEN 1 ELSE 0 END) AS BIGINT) AS execute_count
    FROM executions e LEFT JOIN runs j ON j.{RUN} = e.{RUN} GROUP BY ALL"""

RATE_BY_RUNS = """CASE WHEN h.total_run_count > 0
    THEN round(r.reuse_count * 100::DOUBLE / (r.reuse_count + h.total_run_count), 2)
    ELSE 100::DOUBLE END AS reuse_rate_percent"""


def per_reuse(column: str, name: str) -> str:
    return f"CASE WHEN r.reuse_count > 0 THEN round(h.{column} / r.reuse_count, 4) ELSE 0::DOUBLE END AS {name}"


SAME_MODEL = """h.model_name = r.model_name AND h.model_package = r.model_package
    AND h.relation_name = r.relation_name"""
CTES["daily_usage"] = f"""SELECT r.*, h.* EXCLUDE ({MODEL}),
    r.reuse_count * h.avg_run_dbus AS estimated_dbus_saved, r.reuse_count * h.avg_run_cost AS estimated_cost_saved_usd,
    {RATE_BY_RUNS}, {per_reuse('avg_run_cost', 'avg_cost_saved_per_reuse_usd')}
    FROM reuse r LEFT JOIN hist_usage h ON {SAME_MODEL}"""
CTES["daily_credits"] = f"""SELECT r.*,
    h.* EXCLUDE ({MODEL}, total_run_compute_credits, total_run_compute_cost),
    r.reuse_count * h.avg_run_credits AS estimated_credits_saved,
    r.reuse_count * h.avg_run_cost AS estimated_cost_saved_usd,
    r.execute_count * h.avg_run_credits AS estimated_credits_used,
    r.execute_count * h.avg_run_cost AS estimated_cost_spent_usd,
    CASE WHEN r.execute_count > 0 THEN round(r.reuse_count * 100::DOUBLE / (r.reuse_count + r.execute_count), 2)
        ELSE 100::DOUBLE END AS reuse_rate_percent,
    {per_reuse('avg_run_cost', 'avg_cost_saved_per_reuse_usd')}
    FROM reuse_execute r LEFT JOIN hist_credits h ON {SAME_MODEL}"""
CTES["daily_bytes"] = f"""SELECT r.*, h.* EXCLUDE ({MODEL}),
    r.reuse_count * h.avg_run_on_demand_cost AS estimated_on_demand_cost_saved_usd,
    r.reuse_count * h.avg_run_slot_minutes AS estimated_slot_minutes_saved,
    r.reuse_count * h.avg_bytes_billed AS estimated_bytes_billed_saved,
    r.reuse_count * h.avg_execution_time_seconds AS estimated_execution_time_saved_seconds, {RATE_BY_RUNS},
    {per_reuse('avg_run_on_demand_cost', 'avg_on_demand_cost_saved_per_reuse_usd')},
    {per_reuse('avg_run_slot_minutes', 'avg_slot_minutes_saved_per_reuse')}
    FROM reuse r LEFT JOIN hist_bytes h ON h.model_name = r.model_name AND h.model_package = r.model_package
    AND coalesce(h.relation_name, '') = coalesce(r.relation_name, '')"""

# ----------------------------------------------------------------------- ingest

COMMAND = "['run', 'test', 'build', 'snapshot', 'docs'][user_id % 5 + 1]"
CTES["results"] = f"""SELECT *, {COMMAND} AS command, CASE WHEN dom % 2 = 0 THEN run END AS given_run,
    CASE WHEN dom % 2 = 0 THEN job END AS given_job, CASE WHEN dom % 2 = 0 THEN 'prj_1' ELSE 'none' END AS given_prj,
    CASE WHEN model_no = 5 THEN 'modelspend' ELSE 'shop' END AS package,
    CASE event_type WHEN 'view' THEN 'model' WHEN 'click' THEN 'test' WHEN 'purchase' THEN 'snapshot'
        WHEN 'signup' THEN 'unit_test' ELSE 'seed' END AS resource FROM ev"""
RUN_FALLBACK = "coalesce(given_run, substr(strftime(ts, '%Y%m%d_%H%M%S_%f'), 1, 19))"


def used_ctes(body: str) -> list[str]:
    """Names of the CTEs a query needs, dependencies first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                found.append(name)

    visit(body)
    return found


def sql(body: str) -> str:
    names = used_ctes(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def rounded(body: str, *columns: str, digits: int = 6) -> str:
    replaced = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({body}) _t"


def json_members(comment: str, keys: tuple[str, ...]) -> str:
    return ", ".join(f"json_extract_string({comment}, '$.{k}') AS {k}" for k in keys)


def comment(pattern: str, text: str) -> str:
    return f"nullif(regexp_extract({text}, '{pattern}', 1), '')"


HOUR_START = "date_trunc('hour', start_time)::TIMESTAMP"
CONTEXT = {
    RUN: RUN_FALLBACK,
    JOB: "coalesce(given_job, inv)",
    PRJ: "coalesce(CASE WHEN dom % 2 = 0 THEN 'prj_1' END, 'none')",
    ENV: "coalesce(CASE WHEN dom % 2 = 0 THEN 'env_' || wh_no END, 'none')",
}
HOSTED = ["'acc_1'", "'prod'", "'deployment'", "'scheduled'", "event_type",
          "'it''s \"' || event_type || '\" \\ ' || props || ' #$%^&*' || chr(10)", "NULL", "NULL"]
for _key, _value in zip(list(S.RUN_CONTEXT_KEYS)[4:12], HOSTED):
    CONTEXT[_key] = f"coalesce(CASE WHEN dom % 2 = 0 THEN {_value} END, 'none')"
CONTEXT["invocation_id"] = "inv"
CONTEXT[VER] = "'1.9.0'"
CONTEXT["target_query_tag"] = "'null'"
CONTEXT["invocation_args"] = """('{"which":"run","threads":' || wh_no || '}')::JSON"""
CONTEXT_JSON = "to_json({" + ", ".join(f"'{k}': {CONTEXT[k]}" for k in S.RUN_CONTEXT_KEYS) + "})::VARCHAR"
TRACKED = "command IN ('run', 'test', 'build', 'snapshot')"

MAX_TOTAL = ("avg_run", "max_run", "total_run")
USAGE_SUMS = [f"{p}_{m}" for m in ("dbus", "cost") for p in MAX_TOTAL] + ["avg_execution_time_seconds"]
USAGE_SAVINGS = ["estimated_dbus_saved", "estimated_cost_saved_usd"]
CREDIT_SUMS = ["avg_execution_time_seconds"]
BYTES_SUMS = [f"{p}_{m}" for m in ("capacity_cost", "slot_minutes") for p in MAX_TOTAL]
BYTES_SAVINGS = ["estimated_slot_minutes_saved"]

ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate::TIMESTAMP AS updated_at FROM orders"
CTES["o"] = ORDERS
CTES["o_target"] = "SELECT * FROM o WHERE updated_at < TIMESTAMP '1996-07-01 00:00:00'"
CTES["o_changed"] = """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END
    AS o_orderstatus, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN updated_at + INTERVAL 400 DAY
    ELSE updated_at END AS updated_at FROM o"""
CTES["o_fresh"] = "SELECT * FROM o_changed WHERE updated_at > (SELECT max(updated_at) FROM o_target)"
CTES["o_history"] = """SELECT *, updated_at AS valid_from, CASE WHEN o_orderpriority = '5-LOW'
    THEN updated_at + INTERVAL 1 DAY END AS valid_to FROM o WHERE o_orderstatus <> 'P'"""
CTES["o_later"] = """SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderstatus END
    AS o_orderstatus, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN updated_at + INTERVAL 7 DAY
    ELSE updated_at END AS updated_at FROM o"""
CTES["o_current"] = "SELECT * FROM o_history WHERE valid_to IS NULL"


def snapshot(changed: str, start: str) -> str:
    return f"""SELECT * FROM o_history WHERE valid_to IS NOT NULL
    UNION ALL SELECT c.* EXCLUDE (valid_to), CASE WHEN n.o_orderkey IS NOT NULL AND {changed} THEN {start} END
        AS valid_to FROM o_current c LEFT JOIN o_later n ON n.o_orderkey = c.o_orderkey
    UNION ALL SELECT n.*, {start} AS valid_from, NULL::TIMESTAMP AS valid_to
        FROM o_later n LEFT JOIN o_current c ON n.o_orderkey = c.o_orderkey
        WHERE c.o_orderkey IS NULL OR {changed}"""


BODIES: dict[str, str] = {
    "tracking_union": "SELECT * FROM executions UNION ALL SELECT * FROM executions",
    "eligible_executions": f"SELECT e.* FROM executions e WHERE {eligible(RUN)}",
    "dedup_job_runs": "SELECT * FROM runs",
    "scan_usage_history": "SELECT * FROM usage_scan",
    "scan_billing_usage": "SELECT *, count(*) AS copies FROM u_periods GROUP BY ALL",
    "scan_credit_history": "SELECT * FROM credit_scan",
    "scan_jobs": "SELECT * EXCLUDE (table_id), table_id AS destination_table FROM job_scan",
    "scan_rpu_history": "SELECT * FROM rpu_scan",
    "scan_node_history": "SELECT * FROM node_scan",
    "metadata_extract_struct": f"""SELECT statement_id, {json_members(comment(ANY, 'statement_text'), S.METADATA_KEYS)}
        FROM usage_history""",
    "metadata_extract_variant": f"""SELECT query_id,
        {json_members(comment(OBJECT, 'query_text'), (JOB, RUN, 'node_name', 'node_id'))} FROM credit_history""",
    "metadata_extract_guarded": f"""SELECT query_id, query_metadata,
        json_extract_string(query_metadata, '$.node_id') AS extracted_node_id
        FROM (SELECT query_id, CASE WHEN json_valid({comment(SPACED, 'query_text')}) THEN
            {comment(SPACED, 'query_text')} END AS query_metadata FROM rpu_history) t""",
    "query_comment_build": f"""SELECT event_id, '/* {{"invocation_id":"' || inv || '"' ||
        CASE WHEN dom % 2 = 0 THEN ',"{JOB}":"' || job || '","{RUN}":"' || run || '"' ELSE '' END ||
        CASE WHEN event_type = 'error' THEN ',"node_id":"internal"' ELSE ',"node_id":"' || node_id ||
            '","node_name":"' || model || '","package_name":"shop","relation":{{"database":"shop","schema":"main","identifier":"'
            || model || '"}}' END || '}} */ select ' || props AS query_text FROM ev""",
    "ingest_executions": f"""SELECT model AS model_name, node_id AS relation_name, package AS model_package,
        CASE WHEN resource = 'model' AND wh_no <> 2 THEN CASE WHEN model_no % 3 = 0 THEN 'view' ELSE 'table' END
            WHEN resource <> 'model' THEN resource END AS model_type,
        CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, ms / 1000::DOUBLE AS execution_time,
        inv AS invocation_id, CASE WHEN event_type <> 'view' THEN 'q' || event_id ELSE 'none' END AS query_id,
        TIMESTAMP '2024-02-01 12:30:00' AS insert_timestamp, {RUN_FALLBACK} AS {RUN},
        coalesce(given_job, inv) AS {JOB}, nullif(given_prj, 'none') AS {PRJ}, '1.9.0' AS {VER}, ts AS run_started_at
        FROM results WHERE {TRACKED} AND resource IN ('model', 'test', 'snapshot', 'unit_test')
        AND package <> 'modelspend'""",
    "ingest_job_runs": f"""SELECT {RUN_FALLBACK} AS {RUN}, coalesce(given_job, inv) AS {JOB},
        CASE WHEN dom % 2 = 0 THEN 'env_' || wh_no END AS {ENV}, CASE WHEN dom % 2 = 0 THEN 'prj_1' END AS {PRJ},
        {CONTEXT_JSON} AS {S.RUN_CONTEXT} FROM results WHERE {TRACKED}""",
    "node_config": """SELECT ts AS run_started_at, CASE WHEN wh_no = 2 THEN '"non-serializable node config received"'
        ELSE to_json({'unique_id': node_id, 'group': CASE WHEN wh_no = 0 THEN wh END, 'tags': ['nightly', event_type],
            'persist_docs': {'relation': true, 'columns': wh_no = 1}, 'description': props,
            'meta': {'owner': 'user_' || user_id}})::VARCHAR END AS node_config FROM ev""",
    "execution_query_join_left": "SELECT * FROM usage_join",
    "execution_query_join_job_run": "SELECT * FROM credit_join",
    "execution_query_join_invocation": "SELECT * FROM job_join",
    "execution_query_join_job": "SELECT * FROM rpu_join",
    "execution_query_join_job_provisioned": "SELECT * FROM node_join",
    "usage_overlap_pairs": f"""SELECT u.record_id, u.sku_name, q.statement_id, q.start_time, q.end_time,
        {OVERLAP} AS overlap_seconds FROM u_periods u JOIN q_spans q ON {MEETS}""",
    "usage_period_totals": "SELECT * FROM u_totals",
    "usage_allocation": "SELECT * FROM q_shares",
    "usage_priced": """SELECT statement_id, sku_name, dbus_consumed, dbu_unit_price, estimated_cost_usd
        FROM q_costs""",
    "window_containment": "SELECT * FROM contained",
    "charged_seconds_per_query": "SELECT * FROM charged",
    "fact_usage_split": "SELECT * FROM fact_usage",
    "fact_credits": "SELECT * FROM fact_credits",
    "fact_bytes_slots": "SELECT * FROM fact_bytes",
    "fact_rpu": "SELECT * FROM fact_rpu ORDER BY estimated_cost_usd DESC, elapsed_time DESC",
    "fact_node_time": "SELECT * FROM fact_node ORDER BY estimated_cost_usd DESC, duration_seconds DESC",
    "model_cost_history_usage": rounded("SELECT * FROM hist_usage", *USAGE_SUMS),
    "model_cost_history_credits": rounded("SELECT * FROM hist_credits", *CREDIT_SUMS),
    "model_cost_history_bytes": rounded("SELECT * FROM hist_bytes", *BYTES_SUMS),
    "reuse_counts": "SELECT * FROM reuse",
    "reuse_execute_counts": "SELECT * FROM reuse_execute",
    "daily_savings_usage": rounded("SELECT * FROM daily_usage", *USAGE_SUMS, *USAGE_SAVINGS),
    "daily_savings_credits": rounded("SELECT * FROM daily_credits", *CREDIT_SUMS),
    "daily_savings_bytes": rounded("SELECT * FROM daily_bytes", *BYTES_SUMS, *BYTES_SAVINGS),
    "savings_summary": """SELECT min(reuse_date) AS summary_start_date, max(reuse_date) AS summary_end_date,
        CAST(sum(reuse_count) AS BIGINT) AS total_reused_models,
        CAST(sum(execute_count) AS BIGINT) AS total_executed_models,
        CAST(sum(reuse_count + execute_count) AS BIGINT) AS total_attempted_models,
        round(sum(reuse_count)::DOUBLE / nullif(sum(reuse_count + execute_count), 0) * 100, 2) AS perc_reused_models,
        round(sum(estimated_cost_saved_usd), 2) AS total_reused_cost_savings,
        round(sum(estimated_cost_spent_usd), 2) AS total_cost_spent,
        round(sum(estimated_cost_saved_usd) / nullif(sum(estimated_cost_saved_usd + estimated_cost_spent_usd), 0)
            * 100, 2) AS perc_cost_savings
        FROM daily_credits WHERE reuse_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-29'""",
    "expr_unit_conversions": """SELECT statement_id, execution_duration_ms / 1000::DOUBLE AS seconds,
        execution_duration_ms / 1000::DOUBLE / 60::DOUBLE AS minutes,
        execution_duration_ms / 3600000::DOUBLE AS hours, read_bytes / 1073741824::DOUBLE AS gib,
        read_bytes / 1099511627776::DOUBLE * 6.25::DOUBLE AS on_demand_usd,
        substr(statement_text, 1, 200) AS preview FROM usage_history""",
    "expr_time_differences": f"""SELECT job_id, date_sub('second', start_time, end_time) AS whole_seconds,
        date_sub('millisecond', start_time, end_time) AS ms, date_diff('second', start_time, end_time) AS boundaries,
        greatest(date_sub('second', start_time, least(end_time, {HOUR_START} + INTERVAL 1 HOUR)), 0)
            AS seconds_in_first_hour, start_time::DATE AS day FROM bq_jobs""",
    "expr_null_handling": """SELECT h.statement_id, coalesce(h.cluster_id, h.warehouse_id) AS resource,
        coalesce(a.credits_attributed_compute, 0) AS credits,
        CASE WHEN h.produced_rows > 0 THEN a.credits_attributed_compute / h.produced_rows END AS per_row,
        CASE WHEN h.written_bytes > 0 THEN a.credits_attributed_compute / (h.written_bytes / 1048576::DOUBLE) END
            AS per_mib FROM usage_history h LEFT JOIN query_attribution a ON a.query_id = h.statement_id""",
    "expr_cost_formulas": """SELECT event_id, cents / 1024::DOUBLE * 3::DOUBLE AS credit_usd,
        (event_id * 1048576) / 1099511627776::DOUBLE * 6.25::DOUBLE AS bytes_usd,
        (ms * 4) / 3600000::DOUBLE * 0.04::DOUBLE AS slot_usd,
        (ms * 4)::DOUBLE / nullif(date_sub('millisecond', ts, ended), 0) AS avg_slots,
        floor(ms / 1000::DOUBLE) * (0.543::DOUBLE * 1::DOUBLE / 3600::DOUBLE) AS node_usd,
        floor(ms / 1000::DOUBLE) / 3600::DOUBLE * 0.36::DOUBLE AS rpu_usd FROM ev""",
    "not_null_violations": "SELECT * FROM executions WHERE relation_name IS NULL",
    "unique_violations": f"SELECT {RUN}, count(*) AS count FROM job_runs GROUP BY {RUN} HAVING count(*) > 1",
    "incremental_upsert": """SELECT t.* FROM o_target t WHERE NOT EXISTS (SELECT 1 FROM o_fresh f
        WHERE f.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM o_fresh""",
    "snapshot_by_timestamp": snapshot("n.updated_at > c.valid_from", "n.updated_at"),
    "snapshot_by_check": snapshot(
        "n.o_orderstatus IS DISTINCT FROM c.o_orderstatus", "TIMESTAMP '2030-01-01 00:00:00'"
    ),
}


# Runs of their own: the ids as one expects them, not as they are written and read.
CTES["own_runs"] = f"""SELECT event_id, event_type, model, node_id, ts, 'inv_' || event_id AS own_inv,
    CASE WHEN dom % 2 = 0 THEN 'run_' || event_id ELSE substr(strftime(ts, '%Y%m%d_%H%M%S_%f'), 1, 19) END AS own_run,
    CASE WHEN dom % 3 = 0 THEN 'job_' || event_id ELSE 'inv_' || event_id END AS own_job,
    {TRACKED} AND package <> 'modelspend' AND resource IN ('model', 'test', 'snapshot', 'unit_test') AS is_tracked
    FROM results"""
CTES["own_statements"] = f"""SELECT * FROM own_runs WHERE event_type <> 'error' AND ts >= {START}"""
OWN_PAIR = """s.model = e.model AND s.node_id = e.node_id AND s.ts >= e.ts AND s.ts <= TIMESTAMP '2024-02-01 12:30:00'"""
OWN_COLUMNS = f"""e.model AS model_name, e.own_run AS {RUN}, e.own_job AS {JOB}, e.own_inv AS invocation_id,
    e.ts AS run_started_at"""

BODIES |= {
    "recorded_runs_find_their_statements": f"""SELECT 'q' || s.event_id AS query_id, {OWN_COLUMNS} FROM own_runs e
        LEFT JOIN own_statements s ON s.own_run = e.own_run AND s.own_inv = e.own_inv AND {OWN_PAIR}
        AND s.event_id % 13 <> 0 WHERE e.is_tracked""",
    "recorded_jobs_find_their_statements": f"""SELECT s.event_id AS query_id, {OWN_COLUMNS} FROM own_runs e
        JOIN own_statements s ON s.own_job = e.own_job AND {OWN_PAIR} WHERE e.is_tracked""",
    "upsert_stored": BODIES["incremental_upsert"],
    "daily_savings_credits_stored": BODIES["daily_savings_credits"],
    "daily_savings_bytes_stored": BODIES["daily_savings_bytes"],
    "savings_summary_stored": BODIES["savings_summary"],
    "snapshot_stored": """SELECT o.*, o.updated_at AS valid_from,
        CASE WHEN l.updated_at > o.updated_at THEN l.updated_at END AS valid_to
        FROM o JOIN o_later l USING (o_orderkey) WHERE o.o_orderstatus <> 'P'
        UNION ALL SELECT l.*, l.updated_at AS valid_from, NULL::TIMESTAMP AS valid_to FROM o_later l
        JOIN o USING (o_orderkey) WHERE o.o_orderstatus = 'P' OR l.updated_at > o.updated_at""",
    "append_executions": BODIES["ingest_executions"],
    "append_job_runs": BODIES["ingest_job_runs"],
    "scan_dated_history": f"SELECT * FROM usage_scan WHERE start_time >= {RECENT}",
    "scan_dated_billing": f"SELECT *, count(*) AS copies FROM u_periods WHERE usage_start_time >= {RECENT} GROUP BY ALL",
    "fact_credits_dated": f"""SELECT f.* FROM fact_credits f JOIN credit_history h ON h.query_id = f.query_id
        WHERE h.start_time >= {RECENT}""",
    "scan_other_database": f"""SELECT * REPLACE ('OTHER' AS database_name) FROM credit_history
        WHERE total_elapsed_time % 3 = 0 AND query_text NOT LIKE '%{TRACKING}%'""",
    "tracking_union_older": f"""SELECT * FROM executions UNION ALL SELECT * REPLACE (NULL AS node_config, NULL AS {VER},
        NULL AS query_id) FROM executions""",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
