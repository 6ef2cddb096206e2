"""Partitioned sources, batches that are committed once, and schemas that differ."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import builders as B
from modelspend import schemas as S
from modelspend.config import Sources
from modelspend.plans import facts, histories
from modelspend.plans.tracking import tracking_union
from modelspend.sources import commits
from modelspend.sources.tables import Dated, append, create_tracking_tables, fits, load_table, reconciled, require_columns
from modelspend.streaming.ingest import record_executions
from test_ingest import results

DAYS = [date(2024, 1, d) for d in range(1, 9)]


def dated_history(spark, path, zone_shift=0):
    """A statement at the first and last second of every day, in folders by day."""
    rows = []
    for d in DAYS:
        for at in ("00:00:00", "23:59:59"):
            rows.append({"query_id": f"{d}-{at}", "start_time": datetime.fromisoformat(f"{d} {at}")})
    history = B.credit_history(spark, *rows)
    day = F.date_add(F.to_date("start_time"), zone_shift)
    history.withColumn("d", day).repartition("d").write.partitionBy("d").parquet(path)
    return path


def files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("zone_shift", [-1, 0, 1])
@pytest.mark.parametrize("bound", ["2024-01-05 00:00:00", "2024-01-05 23:59:59", "2024-01-04 23:59:59"])
def test_time_bound_prunes_day_folders_and_loses_nothing(spark, tmp_path, zone_shift, bound):
    path = dated_history(spark, str(tmp_path / "history"), zone_shift)
    settings = replace(B.SETTINGS, monitor_start=datetime.fromisoformat(bound))
    whole = histories.credit_history(load_table(spark, path, S.CREDIT_HISTORY), settings)
    pruned_source = load_table(spark, Dated(path, "d"), S.CREDIT_HISTORY, settings.monitor_start)
    pruned = histories.credit_history(pruned_source, settings)
    ids = lambda df: sorted(r.query_id for r in df.select("query_id").collect())
    assert ids(pruned) == ids(whole) and len(ids(pruned)) > 0
    first = settings.monitor_start.date().toordinal() - 1
    assert {int(date.fromisoformat(f.split("/d=")[1][:10]).toordinal() >= first) for f in files_read(pruned_source)} == {1}
    assert len(files_read(pruned_source)) < len(files_read(load_table(spark, path, S.CREDIT_HISTORY)))


def test_partition_filters_are_in_the_plan_of_a_fact(spark, tmp_path):
    path = dated_history(spark, str(tmp_path / "history"))
    sources = B.sources(
        executions=B.executions(spark, {}), credit_history=Dated(path, "d"), query_attribution=B.attribution(spark, {})
    )
    fact = facts.fact_credits(spark, sources, replace(B.SETTINGS, monitor_start=datetime(2024, 1, 5, 10)))
    plan = fact._jdf.queryExecution().toString()
    (filters,) = {line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line and "d#" in line.split("PartitionFilters: [")[1].split("]")[0]}
    assert ">= 2024-01-04" in filters


def test_partition_columns_get_the_declared_type(spark, tmp_path):
    path = str(tmp_path / "history")
    history = B.credit_history(spark, {"warehouse_name": "007"}, {"warehouse_name": "8"})
    history.write.partitionBy("warehouse_name").parquet(path)
    loaded = load_table(spark, path, S.CREDIT_HISTORY)
    assert sorted(r.warehouse_name for r in loaded.collect()) == ["007", "8"]


def test_day_of_another_type_is_refused(spark, tmp_path):
    history = B.credit_history(spark, {}).withColumn("d", F.lit(20240105))
    with pytest.raises(ValueError, match="date or text"):
        load_table(spark, Dated(history, "d"), S.CREDIT_HISTORY, datetime(2024, 1, 1))


# ------------------------------------------------------------------------ commits


def arrive(spark, folder, *rows):
    files = results(spark, *rows).coalesce(1).write.mode("append")
    files.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)


def count(spark, table):
    return Sources(executions=table).load(spark, "executions").count()


def test_a_lost_checkpoint_neither_repeats_nor_overwrites(spark, tmp_path):
    table, _ = create_tracking_tables(spark, str(tmp_path / "tracking"))
    arriving = str(tmp_path / "results")
    arrive(spark, arriving, {}, {})
    record_executions(spark, arriving, table, str(tmp_path / "c1")).awaitTermination()
    arrive(spark, arriving, {}, {}, {})
    record_executions(spark, arriving, table, str(tmp_path / "c1")).awaitTermination()
    assert count(spark, table) == 5
    # a new stream meets both files in one batch, and one more
    arrive(spark, arriving, {})
    record_executions(spark, arriving, table, str(tmp_path / "c2")).awaitTermination()
    assert count(spark, table) == 6
    record_executions(spark, arriving, table, str(tmp_path / "c3")).awaitTermination()
    assert count(spark, table) == 6


def test_batches_are_whole_and_named_ones_come_once(spark, tmp_path):
    table = str(tmp_path / "executions")
    rows = B.executions(spark, {}, {})
    assert commits.append_once(rows, table, "monday")
    assert commits.append_once(rows, table, "monday") is None
    assert commits.append_once(rows, table, "tuesday")
    assert count(spark, table) == 4
    append(rows, table)
    assert count(spark, table) == 6
    # an attempt that failed before its marker
    rows.withColumn(commits.SOURCE, F.lit("wednesday")).write.parquet(f"{table}/{commits.BATCHES}/lost/{commits.ROWS}")
    assert count(spark, table) == 6
    assert commits.drop_uncommitted(spark, table) == 1 and count(spark, table) == 6
    assert commits.append_once(rows, table, "wednesday") and count(spark, table) == 8


def test_rows_without_a_source_are_refused(spark, tmp_path):
    rows = B.executions(spark, {}).withColumn(commits.SOURCE, F.lit(None).cast("string"))
    with pytest.raises(Exception, match="no source"):
        commits.commit_once(rows, str(tmp_path / "t"))
    assert commits.committed(spark, str(tmp_path / "t")) == []


# ------------------------------------------------------------------------ schemas


def test_an_older_log_unions(spark):
    base = B.executions(spark, {"execution_time": 2.5})
    older = base.drop("node_config", S.PROJECT_ID).withColumn("execution_time", F.lit(2.5).cast("float"))
    both = tracking_union([base, older])
    assert both.schema.names == S.EXECUTIONS.names and [f.dataType for f in both.schema] == [f.dataType for f in S.EXECUTIONS]
    assert sorted(r.execution_time for r in both.collect()) == [2.5, 2.5]
    loaded = Sources(executions=base, extra_executions=(older,)).load_executions(spark)
    assert tracking_union(loaded).count() == 2


def test_a_wrong_type_or_missing_key_raises(spark):
    base = B.executions(spark, {})
    with pytest.raises(ValueError, match="run_started_at is string, not timestamp_ntz"):
        tracking_union([base, base.withColumn("run_started_at", F.lit("soon"))])
    with pytest.raises(ValueError, match="status"):
        tracking_union([base, base.drop("status")])
    with pytest.raises(ValueError, match="total_elapsed_time is string"):
        require_columns(B.credit_history(spark, {}).withColumn("total_elapsed_time", F.lit("x")), S.CREDIT_HISTORY)
    with pytest.raises(ValueError, match="missing columns: a"):
        reconciled(spark.range(1), S.EXECUTIONS, ("a",))


def test_what_fits():
    from pyspark.sql import types as T

    assert fits(T.IntegerType(), T.LongType()) and fits(T.FloatType(), T.DoubleType()) and fits(T.IntegerType(), T.DoubleType())
    assert not fits(T.LongType(), T.IntegerType()) and not fits(T.DoubleType(), T.FloatType())
    assert not fits(T.StringType(), T.DoubleType()) and not fits(T.LongType(), T.DoubleType())
    assert fits(T.StructType().add("a", T.IntegerType()).add("b", T.StringType()), T.StructType().add("a", T.LongType()))
    assert not fits(T.StringType(), T.StructType().add("a", T.LongType()))
