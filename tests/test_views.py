import pytest

import builders as B
from builders import one
from modelspend import schemas as S
from modelspend.plans import views as V
from modelspend.sources.staging import shared_stages


def all_sources(spark):
    return B.sources(
        executions=B.executions(spark, {}, {"status": "reused"}),
        job_runs=B.job_runs(spark, {}, {}),
        usage_history=B.usage_history(spark, {}),
        billing_usage=B.billing_usage(spark, {}),
        list_prices=B.list_prices(spark, {}),
        credit_history=B.credit_history(spark, {}),
        query_attribution=B.attribution(spark, {}),
        jobs=B.jobs(spark, {}),
        rpu_history=B.rpu_history(spark, {}),
        serverless_usage=B.serverless_usage(spark, {}),
        node_history=B.node_history(spark, {}),
    )


def test_views_per_pricing(spark):
    src = all_sources(spark)
    names = {p: list(V.build_views(spark, src, B.SETTINGS, p)) for p in V.PRICINGS}
    report, summary = S.DAILY_SAVINGS_VIEW, S.SUMMARY_VIEW
    assert names == {
        V.USAGE_SPLIT: [S.FACT_VIEW, report],
        V.CREDITS: [S.FACT_VIEW, report, summary],
        V.BYTES_SLOTS: [S.FACT_VIEW, report],
        V.RPU: [S.FACT_VIEW],
        V.NODE_TIME: [S.FACT_VIEW],
    }
    with pytest.raises(ValueError, match="pricing must be one of"):
        V.build_views(spark, src, B.SETTINGS, "free")


def test_published_views_can_be_queried(spark):
    V.publish_views(spark, all_sources(spark), B.SETTINGS, V.CREDITS, shared_stages(spark))
    row = one(spark.sql(f"SELECT * FROM {S.SUMMARY_VIEW}"))
    assert (row["total_reused_models"], row["total_executed_models"], row["perc_reused_models"]) == (1, 1, 50.0)
    # Both executions match the statement: one run of 2 x (2 + 1) credits at 3 USD.
    assert row["total_reused_cost_savings"] == row["total_cost_spent"] == 18.0
    assert spark.table(S.FACT_VIEW).count() == 2
    assert one(spark.table(S.DAILY_SAVINGS_VIEW))["avg_run_credits"] == 6.0


@pytest.mark.parametrize("pricing", [V.USAGE_SPLIT, V.BYTES_SLOTS])
def test_daily_reports_of_other_pricings(spark, pricing):
    row = one(V.build_views(spark, all_sources(spark), B.SETTINGS, pricing)[S.DAILY_SAVINGS_VIEW])
    assert row["reuse_count"] == 1 and row["total_run_count"] == 1 and row["reuse_rate_percent"] == 50.0
    saved = "estimated_cost_saved_usd" if pricing == V.USAGE_SPLIT else "estimated_on_demand_cost_saved_usd"
    assert row[saved] == (10.0 if pricing == V.USAGE_SPLIT else 6.25)
