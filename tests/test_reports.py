from datetime import date

import pytest

import builders as B
from builders import at, dicts, one
from modelspend import schemas as S
from modelspend.config import Rates, Settings
from modelspend.plans import reports

CREDITS = (
    f"model_name string, relation_name string, model_package string, {S.RUN_ID} string, "
    "credits_attributed_compute double, credits_used_cloud_services double, attributed_compute_cost double, "
    "cloud_services_cost double, execution_time double, gb_scanned double"
)
USAGE = (
    f"model_name string, relation_name string, model_package string, {S.RUN_ID} string, "
    "dbus_consumed double, estimated_cost_usd double, execution_time double, gb_read double"
)
BYTES = (
    f"model_name string, relation_name string, model_package string, {S.RUN_ID} string, total_bytes_billed long, "
    "total_slot_ms long, slot_minutes double, job_avg_slots double, total_bytes_processed long, execution_time double"
)
MODEL = ("orders", "model.shop.orders", "shop")


def test_credit_history_is_per_run(spark):
    fact = spark.createDataFrame(
        [
            (*MODEL, "r1", 1.0, 1.0, 3.0, 3.0, 10.0, 1.0),
            (*MODEL, "r1", None, 2.0, None, 6.0, 20.0, 1.0),
            (*MODEL, "r2", 4.0, None, 12.0, None, 30.0, 4.0),
        ],
        CREDITS,
    )
    row = one(reports.model_cost_history_credits(fact))
    assert (row["avg_run_credits"], row["max_run_credits"], row["total_run_credits"]) == (4.0, 4.0, 8.0)
    assert (row["avg_run_cost"], row["total_run_cost"], row["total_run_compute_cost"]) == (12.0, 24.0, 15.0)
    assert row["total_run_compute_credits"] == 5.0
    assert (row["total_query_count"], row["total_run_count"]) == (2, 2)
    assert row["avg_execution_time_seconds"] == 22.5 and row["max_gb_scanned"] == 4.0


def test_usage_history_counts_runs_and_ignores_null_usage(spark):
    fact = spark.createDataFrame(
        [(*MODEL, "r1", 2.0, 1.0, 1.0, 1.0), (*MODEL, "r1", 2.0, 1.0, 1.0, 1.0), (*MODEL, "r2", None, None, 3.0, None)],
        USAGE,
    )
    row = one(reports.model_cost_history_usage(fact))
    assert (row["avg_run_dbus"], row["total_run_dbus"], row["total_query_count"]) == (4.0, 4.0, 2)
    assert row["avg_gb_read"] == 2.0 and row["avg_execution_time_seconds"] == 2.0


def test_bytes_history_is_per_query(spark):
    fact = spark.createDataFrame(
        [
            (*MODEL, "r1", 1024**4, 3600000, 60.0, 1.0, 10, 1.0),
            (*MODEL, "r1", 3 * 1024**4, 3600000, 60.0, None, 30, 3.0),
        ],
        BYTES,
    )
    row = one(reports.model_cost_history_bytes(fact, Rates()))
    assert (row["avg_run_on_demand_cost"], row["total_run_on_demand_cost"]) == (12.5, 25.0)
    assert row["avg_run_capacity_cost"] == 0.04 and row["max_slots_per_query"] == 1.0
    assert (row["total_query_count"], row["total_run_count"]) == (2, 1)
    assert row["avg_bytes_processed"] == 20.0


def test_reuse_counts_per_environment(spark):
    """A run logged under two environments counts in both; equal log rows count once."""
    executions = B.executions(spark, {"status": "reused"}, {"status": "reused"}, {"status": "success"})
    runs = B.job_runs(spark, {}, {}, {S.ENVIRONMENT_ID: "env2"})
    rows = dicts(reports.reuse_counts(executions, runs))
    assert sorted((r[S.ENVIRONMENT_ID], r["reuse_count"], r["unique_runs_reused"]) for r in rows) == [
        ("env", 2, 1),
        ("env2", 2, 1),
    ]
    assert rows[0]["reuse_date"] == date(2024, 1, 1)


def test_reuse_without_job_run_or_run_id(spark):
    executions = B.executions(spark, {"status": "reused", S.RUN_ID: None}, {"status": "reused", S.RUN_ID: "x"})
    row = one(reports.reuse_counts(executions, B.job_runs(spark, {})))
    assert row[S.ENVIRONMENT_ID] is None
    assert (row["reuse_count"], row["unique_runs_reused"]) == (2, 1)


def test_skipped_counts_for_neither_side(spark):
    executions = B.executions(spark, *[{"status": s} for s in ("reused", "success", "error", "skipped", None)])
    row = one(reports.reuse_execute_counts(executions, B.job_runs(spark, {})))
    assert (row["reuse_count"], row["execute_count"]) == (1, 2)


def credit_daily(spark, *executions, fact=()):
    counts = reports.reuse_execute_counts(B.executions(spark, *executions), B.job_runs(spark, {}))
    history = reports.model_cost_history_credits(spark.createDataFrame(list(fact), CREDITS))
    return reports.daily_savings_credits(counts, history)


RUN = (*MODEL, "r1", 1.0, 1.0, 3.0, 3.0, 10.0, 1.0)


def test_credit_savings_and_spend(spark):
    row = one(credit_daily(spark, {"status": "reused"}, {"status": "reused"}, {"status": "success"}, fact=[RUN]))
    assert (row["estimated_credits_saved"], row["estimated_cost_saved_usd"]) == (4.0, 12.0)
    assert (row["estimated_credits_used"], row["estimated_cost_spent_usd"]) == (2.0, 6.0)
    assert row["reuse_rate_percent"] == 66.67 and row["avg_cost_saved_per_reuse_usd"] == 3.0


def test_only_skipped_has_full_rate_and_nothing_per_reuse(spark):
    row = one(credit_daily(spark, {"status": "skipped"}, fact=[RUN]))
    assert row["reuse_rate_percent"] == 100.0 and row["avg_cost_saved_per_reuse_usd"] == 0.0
    assert row["estimated_cost_saved_usd"] == 0.0


def usage_daily(spark, executions, fact):
    counts = reports.reuse_counts(B.executions(spark, *executions), B.job_runs(spark, {}))
    return reports.daily_savings_usage(counts, reports.model_cost_history_usage(spark.createDataFrame(fact, USAGE)))


def test_no_history_gives_null_savings_and_full_rate(spark):
    row = one(usage_daily(spark, [{"status": "reused"}], [("other", "x", "shop", "r", 1.0, 1.0, 1.0, 1.0)]))
    assert row["estimated_cost_saved_usd"] is None and row["reuse_rate_percent"] == 100.0


def test_usage_rate_compares_with_runs(spark):
    fact = [(*MODEL, f"r{i}", 1.0, 2.0, 1.0, 1.0) for i in range(3)]
    row = one(usage_daily(spark, [{"status": "reused"}], fact))
    assert row["reuse_rate_percent"] == 25.0 and row["estimated_cost_saved_usd"] == 2.0


def test_null_relation_joins_only_under_bytes(spark):
    null_model = ("orders", None, "shop")
    executions = [{"status": "reused", "relation_name": None}]
    usage = one(usage_daily(spark, executions, [(*null_model, "r", 1.0, 1.0, 1.0, 1.0)]))
    assert usage["avg_run_cost"] is None
    fact = spark.createDataFrame([(*null_model, "r", 1024**4, 3600000, 60.0, 1.0, 10, 1.0)], BYTES)
    counts = reports.reuse_counts(B.executions(spark, *executions), B.job_runs(spark, {}))
    row = one(reports.daily_savings_bytes(counts, reports.model_cost_history_bytes(fact, Rates())))
    assert row["estimated_on_demand_cost_saved_usd"] == 6.25 and row["estimated_slot_minutes_saved"] == 60.0
    assert row["estimated_bytes_billed_saved"] == float(1024**4)
    assert row["avg_slot_minutes_saved_per_reuse"] == 60.0


def summary(daily, start, end):
    settings = Settings(B.SETTINGS.monitor_start, B.SETTINGS.as_of, start, end)
    return one(reports.savings_summary(daily, settings))


def test_summary_includes_both_ends(spark):
    days = [{"status": s, "run_started_at": at(0, day=d)} for d in (1, 2, 3, 4) for s in ("reused", "success", "success")]
    daily = credit_daily(spark, *days, fact=[RUN])
    row = summary(daily, date(2024, 1, 2), date(2024, 1, 3))
    assert (row["summary_start_date"], row["summary_end_date"]) == (date(2024, 1, 2), date(2024, 1, 3))
    assert (row["total_reused_models"], row["total_executed_models"], row["total_attempted_models"]) == (2, 4, 6)
    assert row["perc_reused_models"] == 33.33
    assert (row["total_reused_cost_savings"], row["total_cost_spent"]) == (12.0, 24.0)
    assert row["perc_cost_savings"] == 33.33


def test_summary_of_nothing_is_null_not_an_error(spark):
    row = summary(credit_daily(spark, {"status": "skipped"}), date(2024, 1, 1), date(2024, 1, 1))
    assert row["perc_reused_models"] is None and row["perc_cost_savings"] is None
    empty = summary(credit_daily(spark, {"status": "reused"}), date(2025, 1, 1), date(2025, 1, 1))
    assert empty["total_reused_models"] is None


def test_default_settings_span_eight_days():
    from datetime import datetime

    settings = Settings.at(datetime(2024, 3, 31, 15, 0))
    assert settings.monitor_start == datetime(2024, 3, 1)
    assert (settings.summary_start, settings.summary_end) == (date(2024, 3, 23), date(2024, 3, 30))
    assert settings.as_of == date(2024, 3, 31)
