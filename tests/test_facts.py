from datetime import timedelta

import pytest

import builders as B
from builders import at, comment, dicts, one
from modelspend import schemas as S
from modelspend.config import Rates
from modelspend.plans import facts
from modelspend.sources.staging import shared_stages, unstaged


def usage_fact(spark, executions, queries, periods=({},), prices=({},), stage=unstaged, **settings):
    sources = B.sources(
        executions=B.executions(spark, *executions),
        usage_history=B.usage_history(spark, *queries),
        billing_usage=B.billing_usage(spark, *periods),
        list_prices=B.list_prices(spark, *prices),
    )
    return facts.fact_usage_split(spark, sources, B.SETTINGS if not settings else _settings(**settings), stage)


def _settings(**overrides):
    from dataclasses import replace

    return replace(B.SETTINGS, **overrides)


def test_usage_fact_prices_the_share(spark):
    row = one(usage_fact(spark, [{}], [{}]))
    assert row["query_id"] == "q" and row["sku_name"] == "SKU"
    assert row["dbus_consumed"] == 10.0 and row["dbu_unit_price"] == 0.5 and row["estimated_cost_usd"] == 5.0
    assert row["gb_read"] == 1.0 and row["cost_per_row_produced"] == 0.5 and row["cost_per_mb_written"] == 5.0
    assert row["execution_seconds"] == 60.0 and row["execution_hours"] == pytest.approx(1 / 60)


def test_usage_fact_columns(spark):
    df = usage_fact(spark, [{}], [{}])
    assert df.columns == [
        "query_id",
        *S.FACT_EXECUTION_COLUMNS,
        *"compute_type cluster_id warehouse_id workspace_id dbus_consumed dbu_unit_price sku_name".split(),
        *"estimated_cost_usd execution_duration_ms execution_seconds execution_hours read_rows read_bytes".split(),
        *"produced_rows written_bytes gb_read gb_written cost_per_row_produced cost_per_mb_written".split(),
    ]


@pytest.mark.parametrize("staged", [True, False])
def test_usage_fact_keeps_executions_without_statement(spark, staged):
    stage = shared_stages(spark) if staged else unstaged
    silent = {"model_name": "quiet", "relation_name": None}
    rows = dicts(usage_fact(spark, [{}, silent, silent], [{}], stage=stage))
    assert sorted((r["model_name"], r["query_id"], r["dbus_consumed"]) for r in rows if r["query_id"]) == [
        ("orders", "q", 10.0)
    ]
    quiet = [r for r in rows if r["model_name"] == "quiet"]
    assert len(quiet) == 2
    assert all(r["query_id"] is None and r["dbus_consumed"] is None for r in quiet)


def test_usage_fact_unallocated_statement_has_zero_usage_and_no_price(spark):
    row = one(usage_fact(spark, [{}], [{"start_time": at(20), "end_time": at(20, 1)}]))
    assert row["dbus_consumed"] == 0.0
    assert row["dbu_unit_price"] is None and row["estimated_cost_usd"] is None


def test_usage_fact_repeats_per_period_and_price(spark):
    query = {"start_time": at(10, 50), "end_time": at(11, 10)}
    second = {"record_id": "v", "usage_start_time": at(11), "usage_end_time": at(12)}
    rows = dicts(usage_fact(spark, [{}], [query], [{}, second], [{}, {"pricing": ((1.0,),)}]))
    assert len(rows) == 4 and {r["gb_read"] for r in rows} == {1.0}


def test_usage_fact_keeps_statements_without_id(spark):
    row = one(usage_fact(spark, [{}], [{"statement_id": None}]))
    assert row["compute_type"] == "WAREHOUSE"
    assert row["query_id"] is None and row["dbus_consumed"] is None and row["sku_name"] is None


def test_usage_fact_zero_rows_and_bytes_have_no_unit_cost(spark):
    row = one(usage_fact(spark, [{}], [{"produced_rows": 0, "written_bytes": 0}]))
    assert row["cost_per_row_produced"] is None and row["cost_per_mb_written"] is None


def test_ineligible_executions_are_left_out(spark):
    executions = [{S.RUN_ID: "none"}, {S.RUN_ID: None}, {"model_name": "model_queries"}]
    assert usage_fact(spark, executions, [{}]).count() == 0


def test_statements_that_do_not_match(spark):
    statements = [
        {"execution_status": "FAILED"},
        {"start_time": at(10, day=1).replace(year=2023)},
        {"statement_text": comment(run="other")},
        {"statement_text": comment(inv="other")},
        {"statement_text": comment(node_name="other")},
        {"statement_text": comment(node_id="other")},
        {"statement_text": "select 1"},
        {"statement_text": "/* not json */ select 1"},
        {"statement_text": None},
        {"statement_text": comment() + f" from {S.EXECUTIONS_TABLE}"},
        {"statement_text": comment() + " from " + S.EXECUTIONS_TABLE.replace("_", "X")},
        {"start_time": at(23, 0, 1)},
    ]
    row = one(usage_fact(spark, [{"run_started_at": at(0)}], statements))
    assert row["query_id"] is None


def test_run_bounds_are_inclusive(spark):
    execution = {"run_started_at": at(10), "insert_timestamp": at(11)}
    queries = [{"statement_id": "first", "start_time": at(10)}, {"statement_id": "last", "start_time": at(11)}]
    outside = {"statement_id": "late", "start_time": at(11) + timedelta(microseconds=1)}
    rows = dicts(usage_fact(spark, [execution], [*queries, outside]))
    assert {r["query_id"] for r in rows} == {"first", "last"}


def test_null_relation_accepts_any_node_id(spark):
    row = one(usage_fact(spark, [{"relation_name": None}], [{"statement_text": comment(node_id="x.y.z")}]))
    assert row["query_id"] == "q"


def test_prefixed_comment_needs_lenient_mode(spark):
    text = comment().replace("/* {", "/* team - {")
    assert one(usage_fact(spark, [{}], [{"statement_text": text}]))["query_id"] is None
    lenient = usage_fact(spark, [{}], [{"statement_text": text}], metadata_mode="lenient")
    assert one(lenient)["query_id"] == "q"


def test_extra_execution_tables_are_added(spark):
    base = B.executions(spark, {})
    sources = B.sources(
        executions=base,
        extra_executions=(B.executions(spark, {"model_name": "x"}), base),
        credit_history=B.credit_history(spark, {}),
        query_attribution=B.attribution(spark, {}),
    )
    assert facts.fact_credits(spark, sources, B.SETTINGS).count() == 2


def credit_fact(spark, executions=({},), queries=({},), attributed=({},), settings=B.SETTINGS):
    sources = B.sources(
        executions=B.executions(spark, *executions),
        credit_history=B.credit_history(spark, *queries),
        query_attribution=B.attribution(spark, *attributed),
    )
    return facts.fact_credits(spark, sources, settings)


def test_credit_fact(spark):
    row = one(credit_fact(spark))
    assert row["cloud_services_cost"] == 3.0 and row["attributed_compute_cost"] == 6.0
    assert row["gb_scanned"] == 1.0 and row["execution_time"] == 10.0 and row[S.CREDIT_EXECUTION_TIME] == 900


def test_credit_fact_without_attribution(spark):
    row = one(credit_fact(spark, attributed=[{"query_id": "other"}]))
    assert row["credits_attributed_compute"] is None and row["attributed_compute_cost"] is None


def test_credit_fact_repeats_per_attribution_row(spark):
    rows = dicts(credit_fact(spark, queries=[{}, {"query_id": "p"}], attributed=[{}, {}, {"query_id": None}]))
    assert sorted((r["query_id"], r["credits_attributed_compute"]) for r in rows if r["query_id"] == "q") == [
        ("q", 2.0)
    ] * 2
    assert [r["credits_attributed_compute"] for r in rows if r["query_id"] == "p"] == [None]


def test_credit_fact_rate(spark):
    row = one(credit_fact(spark, settings=_settings(rates=Rates(per_credit=2))))
    assert row["cloud_services_cost"] == 2.0


def test_credit_fact_ignores_the_invocation(spark):
    assert credit_fact(spark, queries=[{"query_text": comment(inv="other")}]).count() == 1


def test_credit_statements_that_do_not_match(spark):
    statements = [
        {"database_name": "shop"},
        {"query_text": comment() + f" into {S.EXECUTIONS_TABLE}"},
        {"query_text": comment().replace("/* {", "/*{")},
        {"query_text": comment(job="other")},
    ]
    assert credit_fact(spark, queries=statements).count() == 0


def bytes_fact(spark, *queries):
    sources = B.sources(executions=B.executions(spark, {}), jobs=B.jobs(spark, *queries))
    return facts.fact_bytes_slots(spark, sources, B.SETTINGS)


def test_bytes_fact(spark):
    row = one(bytes_fact(spark, {}))
    assert row["slot_minutes"] == 60.0 and row["job_avg_slots"] == 60.0 and row["cache_hit"] is False


def test_zero_length_job_has_no_average_slots(spark):
    assert one(bytes_fact(spark, {"end_time": at(10)}))["job_avg_slots"] is None


def test_jobs_that_are_filtered(spark):
    jobs = [
        {"job_type": "LOAD"},
        {"project_id": "SHOP"},
        {"destination_table": (S.EXECUTIONS_TABLE,)},
        {"destination_table": (None,)},
        {"creation_time": at(10).replace(year=2023)},
    ]
    assert bytes_fact(spark, *jobs).count() == 0


def rpu_fact(spark, queries=({},), windows=({},)):
    sources = B.sources(
        executions=B.executions(spark, {}),
        rpu_history=B.rpu_history(spark, *queries),
        serverless_usage=B.serverless_usage(spark, *windows),
    )
    return facts.fact_rpu(spark, sources, B.SETTINGS)


def test_rpu_fact_divides_as_double(spark):
    assert one(rpu_fact(spark, windows=[{"charged_seconds": 1800}]))["estimated_cost_usd"] == 0.18


def test_rpu_fact_needs_a_window(spark):
    assert rpu_fact(spark, windows=[{"start_time": at(12), "end_time": at(13)}]).count() == 0


def test_rpu_fact_order(spark):
    queries = [{"query_id": i, "elapsed_time": e} for i, e in ((1, 5), (2, 9))]
    dear = {"query_id": 3, "start_time": at(11), "end_time": at(11, 0, 1)}
    windows = [{}, {"start_time": at(11), "end_time": at(11, 1), "charged_seconds": 7200}]
    assert [r.query_id for r in rpu_fact(spark, [*queries, dear], windows).collect()] == [3, 2, 1]


def test_comment_without_spaces_is_read(spark):
    text = comment().replace("/* {", "/*{").replace("} */", "}*/")
    assert rpu_fact(spark, [{"query_text": text}]).count() == 1


def node_fact(spark, *queries, executions=({},)):
    sources = B.sources(executions=B.executions(spark, *executions), node_history=B.node_history(spark, *queries))
    return facts.fact_node_time(spark, sources, B.SETTINGS)


def test_node_fact(spark):
    row = one(node_fact(spark, {}))
    assert row["duration_seconds"] == 30
    assert row["cluster_cost_per_second"] == 0.543 / 3600 and row["estimated_cost_usd"] == 30 * (0.543 / 3600)


def test_node_seconds_count_boundaries(spark):
    start = at(10) + timedelta(milliseconds=900)
    assert one(node_fact(spark, {"start_time": start, "end_time": at(10, 0, 1)}))["duration_seconds"] == 1


def test_system_users_and_utility_statements_are_left_out(spark):
    system = [{"user_id": user_id} for user_id in (0, 1, None)]
    utility = [{"query_text": p + comment()} for p in ("COMMIT", "begin ", "Fetch 1", "SET x", "insert into t ")]
    assert node_fact(spark, *system, *utility).count() == 0


def test_runs_of_one_job_cross_match_while_they_overlap(spark):
    """Only the job and the time range tie a statement to a run."""
    runs = [{S.RUN_ID: "a"}, {S.RUN_ID: "b"}, {S.RUN_ID: "c", "run_started_at": at(12)}]
    rows = dicts(node_fact(spark, {}, executions=runs))
    assert sorted(r[S.RUN_ID] for r in rows) == ["a", "b"]
