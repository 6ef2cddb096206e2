"""What the physical plans must not lose: pushdown, pruning, hash joins, JVM-side expressions."""

import re

import pytest

import builders as B
from modelspend import schemas as S
from modelspend.config import Sources
from modelspend.operators import allocation as A
from modelspend.plans import facts, histories
from modelspend.sources.staging import shared_stages, unstaged


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """All sources as Parquet folders."""
    base = tmp_path_factory.mktemp("sources")
    tables = {
        "executions": B.executions(spark, {}),
        "usage_history": B.usage_history(spark, {}),
        "billing_usage": B.billing_usage(spark, {}),
        "list_prices": B.list_prices(spark, {}),
        "credit_history": B.credit_history(spark, {}),
        "query_attribution": B.attribution(spark, {}),
        "jobs": B.jobs(spark, {}),
        "rpu_history": B.rpu_history(spark, {}),
        "serverless_usage": B.serverless_usage(spark, {}),
        "node_history": B.node_history(spark, {}),
    }
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
    return Sources(**{name: f"{base}/{name}" for name in tables})


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scans(text, table):
    return [block for block in text.split("\n\n") if "Scan parquet" in block and f"/{table}]" in block]


BUILDS = {
    "usage_split": lambda s, src: facts.fact_usage_split(s, src, B.SETTINGS, unstaged),
    "credits": lambda s, src: facts.fact_credits(s, src, B.SETTINGS),
    "bytes": lambda s, src: facts.fact_bytes_slots(s, src, B.SETTINGS),
    "rpu": lambda s, src: facts.fact_rpu(s, src, B.SETTINGS, stage=unstaged),
    "node": lambda s, src: facts.fact_node_time(s, src, B.SETTINGS, stage=unstaged),
}


@pytest.mark.parametrize("name", BUILDS)
def test_no_nested_loops_and_no_python(spark, stored, name):
    text = plan(BUILDS[name](spark, stored))
    for node in ("NestedLoop", "Cartesian", "Python", "Pandas"):
        assert node not in text


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_facts_agree_with_and_without_broadcast(spark, stored, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for build in BUILDS.values():
            df = build(spark, stored)
            assert df.count() == 1
            if threshold == "-1":
                assert "BroadcastHashJoin" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_filters_reach_the_scan(spark, stored):
    text = plan(facts.credit_matches(spark, stored, B.SETTINGS).matched)
    (scan,) = scans(text, "credit_history")
    assert "GreaterThanOrEqual(start_time,2024-01-01T00:00)" in scan
    assert "EqualTo(database_name,SHOP)" in scan
    assert "queued_overload_time" not in scan


def test_allocation_never_reads_the_text(spark, stored):
    history = histories.usage_history(stored.load(spark, "usage_history"), B.SETTINGS)
    periods = A.usage_periods(stored.load(spark, "billing_usage"))
    spans = A.query_spans(history)
    text = plan(A.allocate_usage(spans, periods))
    found = scans(text, "usage_history")
    assert found and not any("statement_text" in s for s in found)


def test_staged_fact_reads_the_text_once(spark, stored):
    lazy = plan(facts.usage_matches(spark, stored, B.SETTINGS).left_join())
    assert sum("statement_text" in s for s in scans(lazy, "usage_history")) == 2
    staged = plan(facts.usage_matches(spark, stored, B.SETTINGS, shared_stages(spark)).left_join())
    assert not scans(staged, "usage_history")


def test_metadata_is_parsed_once_per_row(spark, stored):
    text = plan(facts.credit_matches(spark, stored, B.SETTINGS).matched)
    assert len(re.findall(r"from_json", text)) == 1


def test_tracking_columns_are_pruned(spark, stored):
    (scan, *_) = scans(plan(facts.credit_matches(spark, stored, B.SETTINGS).matched), "executions")
    assert "node_config" not in scan and S.PROJECT_ID not in scan


def test_usage_overlaps_are_joined_once(spark, stored):
    """With stages the fact joins its executions once and its usage periods once, and each pair set is stored."""
    written = []

    def stage(df):
        written.append(plan(df))
        return shared_stages(spark)(df)

    rest = plan(facts.fact_usage_split(spark, stored, B.SETTINGS, stage))
    assert len(written) == 2
    assert all(len(re.findall(r"^\(\d+\) (?:\w*HashJoin|SortMergeJoin)", text, re.M)) == 1 for text in written)
    assert not scans(rest, "billing_usage") or "inline" not in rest
    assert "statement_text" not in written[1]


def test_runs_bound_the_history_before_its_text_is_searched(spark, stored):
    text = plan(facts.node_matches(spark, stored, B.SETTINGS).matched)
    blocks = text.split("\n\n")
    (at,) = [i for i, block in enumerate(blocks) if "Scan parquet" in block and "/node_history]" in block]
    assert blocks[at + 1].count("ubquery") >= 2 and ") Filter" in blocks[at + 1]
