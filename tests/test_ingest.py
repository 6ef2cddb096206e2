import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import builders as B
from builders import dicts, one
from modelspend import schemas as S
from modelspend.config import Sources
from modelspend.functions.tracking_json import node_config_json
from modelspend.plans.ingest import ingest_executions, ingest_job_runs
from modelspend.sources.staging import shared_stages, unstaged
from modelspend.sources.tables import append, create_tracking_tables, load_table, publish, require_columns
from modelspend.streaming.ingest import record_executions, record_job_runs

NASTY = "it's \"fine\" C:\\dir\\ end */ tab\t bell\x07 café 漢\nnext line"
NOW = datetime(2024, 5, 6, 7, 8, 9)


def node(name="orders", package="shop", kind="model", materialized="table", config=True):
    settings = (materialized, None, ["nightly"], {"relation": True}, None, {"owner": "x'y"})
    return (name, f"{kind}.{package}.{name}", package, kind, settings if config else None)


def results(spark, *rows):
    return B.table(
        spark,
        S.RUN_RESULTS,
        rows,
        command="run",
        invocation_id="inv",
        run_started_at=datetime(2024, 1, 2, 3, 4, 5, 678999),
        status="success",
        execution_time=1.5,
        adapter_response=("qid",),
        node=node(),
        **{S.VERSION: "1", S.RUN_ID: "run", S.JOB_ID: "job", S.PROJECT_ID: "prj"},
    )


def environments(spark, *rows):
    return B.table(
        spark,
        S.RUN_ENV,
        rows,
        command="build",
        run_started_at=datetime(2024, 1, 2, 3, 4, 5, 678999),
        invocation_id="inv",
        **{S.VERSION: "1"},
    )


def test_execution_row(spark):
    df = ingest_executions(results(spark, {}), NOW)
    assert df.columns == S.EXECUTIONS.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in S.EXECUTIONS]
    row = one(df)
    assert row["relation_name"] == "model.shop.orders" and row["model_type"] == "table"
    assert row["query_id"] == "qid" and row["insert_timestamp"] == NOW
    assert json.loads(row["node_config"]) == {
        "unique_id": "model.shop.orders",
        "group": None,
        "tags": ["nightly"],
        "persist_docs": {"relation": True},
        "description": None,
        "meta": {"owner": "x'y"},
    }


def test_what_is_tracked(spark):
    kept = [{"command": c} for c in ("run", "test", "build", "snapshot")]
    kept += [{"node": node(kind=k)} for k in ("test", "snapshot", "unit_test")]
    dropped = [{"command": c} for c in ("docs", "compile", None)]
    dropped += [{"node": node(kind="seed")}, {"node": node(package="modelspend")}]
    rows = dicts(ingest_executions(results(spark, *kept, *dropped), NOW))
    assert sorted(r["model_type"] for r in rows) == ["snapshot", *["table"] * 4, "test", "unit_test"]


def test_own_packages_can_be_named(spark):
    rows = results(spark, {}, {"node": node(package="tools")})
    assert ingest_executions(rows, NOW, own_packages=("tools",)).count() == 1


def test_fallback_ids(spark):
    row = one(
        ingest_executions(
            results(spark, {S.RUN_ID: None, S.JOB_ID: None, S.PROJECT_ID: "none", "adapter_response": (None,)}), NOW
        )
    )
    assert row[S.RUN_ID] == "20240102_030405_678" and row[S.JOB_ID] == "inv"
    assert row[S.PROJECT_ID] is None and row["query_id"] == "none"


def test_insert_time_defaults_to_now(spark):
    row = one(ingest_executions(results(spark, {})))
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - row["insert_timestamp"]).total_seconds()) < 300


def config_of(spark, schema, value):
    df = spark.createDataFrame([(value,)], f"node {schema}")
    return one(df.select(node_config_json(F.col("node"), df.schema["node"].dataType).alias("c")))["c"]


def test_datetimes_in_meta_become_iso_text(spark):
    schema = (
        "struct<unique_id:string, config:struct<meta:struct<owner:string, made:timestamp_ntz, whole:timestamp_ntz,"
        " day:date, many:array<timestamp_ntz>, by:map<string,date>>>>"
    )
    moment = datetime(2024, 1, 2, 3, 4, 5, 60)
    meta = ("me", moment, datetime(2024, 1, 2), date(2024, 1, 2), [moment, None], {"a": date(2024, 1, 3)})
    got = json.loads(config_of(spark, schema, ("m.a", (meta,))))
    assert got["meta"] == {
        "owner": "me",
        "made": moment.isoformat(),
        "whole": "2024-01-02T00:00:00",
        "day": "2024-01-02",
        "many": [moment.isoformat(), None],
        "by": {"a": "2024-01-03"},
    }
    assert got["tags"] is None


def test_config_that_is_not_plain(spark):
    schema = "struct<unique_id:string, config:struct<group:string>, config_object:struct<group:string, at:date>>"
    whole = config_of(spark, schema, ("m.a", None, ("g", date(2024, 1, 2))))
    assert json.loads(whole) == {"group": "g", "at": "2024-01-02"}
    nothing = config_of(spark, schema, ("m.a", None, None))
    assert nothing == '"non-serializable node config received"'
    assert config_of(spark, "struct<unique_id:string>", ("m.a",)) == nothing


def test_job_run_context_defaults(spark):
    row = one(ingest_job_runs(environments(spark, {})))
    assert (row[S.ENVIRONMENT_ID], row[S.PROJECT_ID]) == (None, None)
    context = json.loads(row[S.RUN_CONTEXT])
    assert list(context) == list(S.RUN_CONTEXT_KEYS)
    assert context[S.RUN_ID] == row[S.RUN_ID] == "20240102_030405_678"
    assert context[S.JOB_ID] == "inv" and context["target_query_tag"] == "null"
    assert context["invocation_args"] is None
    assert {v for k, v in context.items() if S.RUN_CONTEXT_KEYS[k] == "none"} == {"none"}


def test_job_run_context_survives_any_text(spark):
    reason = list(S.RUN_CONTEXT_KEYS)[9]
    rows = [
        {reason: NASTY, "invocation_args": '{"vars": {"a": [1, "x"]}}', S.ENVIRONMENT_ID: "e"},
        {reason: NASTY, "invocation_args": NASTY, S.ENVIRONMENT_ID: "none"},
        {"command": "docs"},
    ]
    first, second = sorted(dicts(ingest_job_runs(environments(spark, *rows))), key=lambda r: r[S.ENVIRONMENT_ID] or "z")
    assert first[S.ENVIRONMENT_ID] == "e" and second[S.ENVIRONMENT_ID] is None
    context = json.loads(first[S.RUN_CONTEXT])
    assert context[reason] == NASTY and context["invocation_args"] == {"vars": {"a": [1, "x"]}}
    assert json.loads(second[S.RUN_CONTEXT])["invocation_args"] == NASTY


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_create_append_read(spark, tmp_path, kind):
    namespace = str(tmp_path / "tracking") if kind == "path" else "tracking_db"
    rows = ingest_executions(results(spark, {}, {}), NOW)
    for expected in (2, 4):
        executions, job_runs = create_tracking_tables(spark, namespace)
        append(rows.select(*reversed(rows.columns)), executions)
        append(ingest_job_runs(environments(spark, {})), job_runs)
        loaded = Sources(executions=executions, job_runs=job_runs)
        assert loaded.load(spark, "executions").count() == expected
        assert loaded.load(spark, "job_runs").count() == expected / 2
    assert one(loaded.load(spark, "executions").select("model_name", "run_started_at").distinct()) == {
        "model_name": "orders",
        "run_started_at": datetime(2024, 1, 2, 3, 4, 5, 678999),
    }


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("x", ("a",))], "record_id string, usage_metadata struct<cluster_id:string>")
    with pytest.raises(ValueError, match="workspace_id, usage_metadata.warehouse_id"):
        require_columns(df, S.BILLING_USAGE)
    with pytest.raises(ValueError, match="not configured"):
        Sources().load(spark, "jobs")


def test_publish_names_a_view(spark):
    publish(B.executions(spark, {}), S.FACT_VIEW)
    assert load_table(spark, S.FACT_VIEW, S.EXECUTIONS).count() == 1


def test_stage_stores_in_the_shared_folder(spark):
    stages = shared_stages(spark)
    staged = stages(B.executions(spark, {}, {}))
    assert staged.schema == S.EXECUTIONS and staged.count() == 2
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in staged.inputFiles())
    assert unstaged(staged) is staged
    stages.clear()
    assert not os.path.exists(stages.folder.removeprefix("file:"))


def test_streams_record_each_file_once(spark, tmp_path):
    arriving, envs = str(tmp_path / "results"), str(tmp_path / "envs")
    tables = [str(tmp_path / t) for t in ("executions", "job_runs")]
    for expected in (2, 4):
        arrived = results(spark, {}, {}, {"command": "docs"}).coalesce(1).write.mode("append")
        arrived.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(arriving)
        environments(spark, {}).coalesce(1).write.mode("append").json(envs)
        record_executions(spark, arriving, tables[0], str(tmp_path / "c1")).awaitTermination()
        record_job_runs(spark, envs, tables[1], str(tmp_path / "c2")).awaitTermination()
        assert Sources(executions=tables[0]).load(spark, "executions").count() == expected
        assert Sources(job_runs=tables[1]).load(spark, "job_runs").count() == expected / 2
    row = one(Sources(executions=tables[0]).load(spark, "executions").drop("insert_timestamp").distinct())
    assert row["run_started_at"] == datetime(2024, 1, 2, 3, 4, 5, 678999)
    assert row[S.RUN_ID] == "run" and json.loads(row["node_config"])["tags"] == ["nightly"]


def test_streams_and_batches_share_a_folder(spark, tmp_path):
    table, _ = create_tracking_tables(spark, str(tmp_path / "tracking"))
    arriving = str(tmp_path / "results")
    count = lambda: Sources(executions=table).load(spark, "executions").count()
    rows = ingest_executions(results(spark, {}))
    append(rows, table)
    arrived = results(spark, {}, {}).coalesce(1).write.mode("append")
    arrived.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(arriving)
    for _ in range(2):
        record_executions(spark, arriving, table, str(tmp_path / "c")).awaitTermination()
    assert count() == 3
    append(rows, table)
    assert count() == 4
