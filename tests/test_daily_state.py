from dataclasses import replace
from datetime import date

import pytest

import builders as B
from builders import SETTINGS, at, dicts
from modelspend import schemas as S
from modelspend.plans import daily_state, views
from modelspend.sources.staging import shared_stages
from test_history import files

PRICINGS = (views.CREDITS, views.BYTES_SLOTS)


def inputs(spark):
    """Three days; run "a" spans two of them, the third has reuses only; one execution has no start."""
    runs = [("a", 1, "success"), ("a", 2, "success"), ("b", 1, "error"), ("b", 1, "reused"), ("c", 2, "reused"), ("d", 3, "reused")]
    ids = [{S.RUN_ID: run, S.JOB_ID: "job", "invocation_id": f"{run}{day}"} for run, day, _ in runs]
    rows = [
        {**own, "status": status, "run_started_at": at(1, day=day), "insert_timestamp": at(2, day=day), "execution_time": 2.0 * i}
        for i, (own, (_, day, status)) in enumerate(zip(ids, runs, strict=True))
    ]
    lost = {S.RUN_ID: "lost", "status": "reused", "run_started_at": None}
    done = [(i, own, day) for i, (own, (_, day, status)) in enumerate(zip(ids, runs, strict=True)) if status != "reused"]
    text = {i: B.comment(run=own[S.RUN_ID], inv=own["invocation_id"]) for i, own, _ in done}
    credits = [{"query_id": f"q{i}", "query_text": text[i], "start_time": at(1, 30, day=day)} for i, _, day in done]
    jobs = [
        {"job_id": f"q{i}", "query": text[i], "creation_time": at(1, 30, day=day), "total_bytes_billed": (i + 1) * 1024**4}
        for i, _, day in done
    ]
    return B.sources(
        executions=B.executions(spark, *rows, lost),
        job_runs=B.job_runs(spark, *[{S.RUN_ID: r, S.ENVIRONMENT_ID: "e", S.PROJECT_ID: "p"} for r in "abc"]),
        credit_history=B.credit_history(spark, *credits),
        query_attribution=B.attribution(spark, *[{"query_id": f"q{i}", "credits_attributed_compute": i + 1.0} for i, _, _ in done]),
        jobs=B.jobs(spark, *jobs),
    )


def whole(spark, sources, pricing):
    return views.build_views(spark, sources, SETTINGS, pricing)[S.DAILY_SAVINGS_VIEW]


def same(got, expected):
    key = lambda row: str(sorted(row.items(), key=str))
    return sorted(dicts(got), key=key) == sorted(dicts(expected), key=key)


@pytest.mark.parametrize("pricing", PRICINGS)
def test_refreshed_days_equal_the_whole_report(spark, tmp_path, pricing):
    path, stage, sources = str(tmp_path / "s"), shared_stages(spark), inputs(spark)
    early = replace(sources, executions=sources.executions.filter("run_started_at < '2024-01-02'"))
    report = lambda of: daily_state.daily_savings(spark, path, of, SETTINGS, pricing)
    assert dicts(report(sources)) == []
    for known, new in ((early, early.executions), (sources, sources.executions.filter("run_started_at >= '2024-01-02' OR run_started_at IS NULL"))):
        before = files(path)
        days = daily_state.days_of(new)
        daily_state.refresh_days(spark, path, known, SETTINGS, pricing, days, stage)
        now = files(path)
        assert all(now[f] == t for f, t in before.items()) and len(now) > len(before)
        assert same(report(known), whole(spark, known, pricing))
        assert dicts(report(known))
    assert {r["avg_run_cost" if pricing == views.CREDITS else "avg_run_on_demand_cost"] is None for r in dicts(report(sources))} == {False}


@pytest.mark.parametrize("pricing", PRICINGS)
def test_late_rows_and_lost_days(spark, tmp_path, pricing):
    """A repeated refresh changes nothing; late rows of an old day arrive; a day without rows goes."""
    path, stage, sources = str(tmp_path / "s"), shared_stages(spark), inputs(spark)
    report = lambda: daily_state.daily_savings(spark, path, sources, SETTINGS, pricing)
    on_time = replace(sources, executions=sources.executions.filter("coalesce(status, '') <> 'error'"))
    for _ in range(2):
        daily_state.refresh_days(spark, path, on_time, SETTINGS, pricing, daily_state.days_of(on_time.executions), stage)
        assert same(report(), whole(spark, on_time, pricing))
    late = sources.executions.filter("status = 'error'")
    assert daily_state.days_of(late) == [date(2024, 1, 1)]
    daily_state.refresh_days(spark, path, sources, SETTINGS, pricing, daily_state.days_of(late), stage)
    assert same(report(), whole(spark, sources, pricing))
    left = replace(sources, executions=sources.executions.filter("run_started_at < '2024-01-03'"))
    daily_state.refresh_days(spark, path, left, SETTINGS, pricing, [date(2024, 1, 3), None], stage)
    assert same(report(), whole(spark, left, pricing))


def test_late_statements_name_the_days_of_their_runs(spark):
    sources = inputs(spark)
    late = sources.credit_history.filter("query_id = 'q1'")
    assert daily_state.days_of_statements(sources.executions, late, "start_time") == [date(2024, 1, 2)]
    assert daily_state.days_of_statements(sources.executions, late.limit(0), "start_time") == []


def test_report_reads_no_history(spark, tmp_path):
    path, stage, sources = str(tmp_path / "s"), shared_stages(spark), inputs(spark)
    daily_state.refresh_days(spark, path, sources, SETTINGS, views.CREDITS, daily_state.days_of(sources.executions), stage)
    report = daily_state.daily_savings(spark, path, sources, SETTINGS, views.CREDITS)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "query_text" not in plan and "execution_type" not in plan


def test_usage_split_has_no_state(spark, tmp_path):
    with pytest.raises(ValueError, match="usage_split"):
        daily_state.refresh_days(spark, str(tmp_path), inputs(spark), SETTINGS, views.USAGE_SPLIT, [None], shared_stages(spark))
