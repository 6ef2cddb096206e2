import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import dicts
from modelspend.operators import stored_history as T
from modelspend.operators.history import incremental_upsert, snapshot_by_check, snapshot_by_timestamp
from modelspend.operators.quality import not_null_violations, unique_violations
from modelspend.sources.staging import shared_stages

SCHEMA = "id long, name string, created_at timestamp_ntz"
VERSIONS = SCHEMA + ", valid_from timestamp_ntz, valid_to timestamp_ntz"


def day(n):
    return datetime(2024, 1, n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_replaces_and_inserts_newer_rows_only(spark):
    target = spark.createDataFrame([(1, "a", day(1)), (2, "b", day(3)), (9, "z", day(2))], SCHEMA)
    source = spark.createDataFrame([(1, "a2", day(4)), (2, "old", day(3)), (3, "c", day(5)), (4, "d", day(1))], SCHEMA)
    got = rows(incremental_upsert(target, source, "id", "created_at"))
    assert got == rows(
        spark.createDataFrame([(1, "a2", day(4)), (2, "b", day(3)), (3, "c", day(5)), (9, "z", day(2))], SCHEMA)
    )


def test_upsert_into_empty_target_is_a_first_load(spark):
    source = spark.createDataFrame([(1, "a", day(1)), (2, "b", None)], SCHEMA)
    assert rows(incremental_upsert(source.filter("false"), source, "id", "created_at")) == rows(source)


def history(spark):
    return spark.createDataFrame(
        [
            (1, "a", day(1), day(1), None),
            (2, "b0", day(1), day(1), day(2)),
            (2, "b", day(2), day(2), None),
            (3, "gone", day(1), day(1), None),
            (5, None, day(1), day(1), None),
        ],
        VERSIONS,
    )


def source(spark):
    return spark.createDataFrame(
        [(1, "a2", day(5)), (2, "b", day(2)), (4, "new", day(3)), (5, "e", day(1))], SCHEMA
    )


def test_snapshot_by_timestamp(spark):
    got = rows(snapshot_by_timestamp(history(spark), source(spark), "id", "created_at"))
    assert got == sorted(
        [
            (1, "a", day(1), day(1), day(5)),
            (1, "a2", day(5), day(5), None),
            (2, "b0", day(1), day(1), day(2)),
            (2, "b", day(2), day(2), None),
            (3, "gone", day(1), day(1), None),
            (4, "new", day(3), day(3), None),
            (5, None, day(1), day(1), None),
        ],
        key=repr,
    )


def test_snapshot_by_check_compares_nulls(spark):
    now = day(20)
    got = rows(snapshot_by_check(history(spark), source(spark), ["id"], ["name", "id"], now))
    assert got == sorted(
        [
            (1, "a", day(1), day(1), now),
            (1, "a2", day(5), now, None),
            (2, "b0", day(1), day(1), day(2)),
            (2, "b", day(2), day(2), None),
            (3, "gone", day(1), day(1), None),
            (4, "new", day(3), now, None),
            (5, None, day(1), day(1), now),
            (5, "e", day(1), now, None),
        ],
        key=repr,
    )


def test_snapshots_are_idempotent(spark):
    once = snapshot_by_timestamp(history(spark), source(spark), "id", "created_at")
    assert rows(snapshot_by_timestamp(once, source(spark), "id", "created_at")) == rows(once)


def test_null_keys_match_nothing(spark):
    old = spark.createDataFrame([(None, "a", day(1), day(1), None)], VERSIONS)
    new = spark.createDataFrame([(None, "b", day(2)), (None, "b", day(2))], SCHEMA)
    kept = (None, "a", day(1), day(1), None)
    assert rows(snapshot_by_timestamp(old, new, "id", "created_at")) == sorted(
        [kept, *[(None, "b", day(2), day(2), None)] * 2], key=repr
    )
    assert rows(snapshot_by_check(old, new, "id", ["name"], day(9))) == sorted(
        [kept, *[(None, "b", day(2), day(9), None)] * 2], key=repr
    )


def test_first_snapshot(spark):
    got = snapshot_by_timestamp(history(spark).filter("false"), source(spark), "id", "created_at")
    assert got.filter("valid_to IS NULL").count() == 4


def test_basic_models_pass_the_checks(spark):
    df = spark.createDataFrame([(1, "test_model", day(1)), (2, "test_view", day(1))], SCHEMA)
    assert not_null_violations(df, "id").count() == 0 and unique_violations(df, ["id"]).count() == 0


def test_violations_are_returned(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "y", None), (None, "z", None)], SCHEMA)
    assert [r["name"] for r in dicts(not_null_violations(df, "id"))] == ["z"]
    assert dicts(unique_violations(df, ["id"])) == [{"id": 1, "count": 2}]


# ----------------------------------------------------------------- stored tables


def files(path):
    """Data files with their times, so a rewritten file differs."""
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.startswith("part-")
    }


def many(spark, n, name="x", created=1):
    return spark.createDataFrame([(i, name, day(created)) for i in n], SCHEMA)


def test_stored_upsert_loads_first_and_leaves_other_buckets_alone(spark, tmp_path):
    path, stage = str(tmp_path / "t"), shared_stages(spark)
    first = many(spark, range(200))
    assert len(T.upsert_stored(spark, path, first, "id", "created_at", stage, 16)) == 16
    before = files(path)
    changed = many(spark, [3, 500], "new", 2).unionByName(many(spark, [7], "late", 1))
    (written) = T.upsert_stored(spark, path, changed, "id", "created_at", stage, 16)
    assert 1 <= len(written) <= 2
    after = files(path)
    same = {f for f in before if "/bucket=" in f and int(f.split("/bucket=")[1].split("/")[0]) not in written}
    assert len(same) > 0 and all(after[f] == before[f] for f in same)
    got = T.read_buckets(spark, path).drop(T.BUCKET)
    assert rows(got) == rows(incremental_upsert(first, changed, "id", "created_at"))
    # again, and with nothing new
    assert T.upsert_stored(spark, path, changed, "id", "created_at", stage, 16) == []


def test_stored_upsert_repeats_a_run_that_failed(spark, tmp_path, monkeypatch):
    path, stage = str(tmp_path / "t"), shared_stages(spark)
    first, more = many(spark, range(50)), many(spark, range(40, 60), "new", 3)
    T.upsert_stored(spark, path, first, "id", "created_at", stage, 8)
    whole = T.replace_buckets

    def part(df, path, stage):  # half of the buckets are replaced before the driver dies
        whole(df.filter(F.col(T.BUCKET) < 4), path, stage)
        raise RuntimeError("lost")

    monkeypatch.setattr(T, "replace_buckets", part)
    with pytest.raises(RuntimeError):
        T.upsert_stored(spark, path, more, "id", "created_at", stage, 8)
    monkeypatch.setattr(T, "replace_buckets", whole)
    T.upsert_stored(spark, path, more, "id", "created_at", stage, 8)
    assert rows(T.read_buckets(spark, path).drop(T.BUCKET)) == rows(incremental_upsert(first, more, "id", "created_at"))


def test_stored_history_keeps_closed_files(spark, tmp_path):
    path, stage = str(tmp_path / "h"), shared_stages(spark)
    sources = [
        many(spark, range(100)),
        many(spark, [5, 6, 200], "b", 2),
        many(spark, [5], "c", 3).unionByName(many(spark, [6], "b", 2)),
    ]
    empty = sources[0].limit(0).selectExpr("*", "created_at AS valid_from", "created_at AS valid_to")
    plain, closed = empty, {}
    for number, rows_now in enumerate(sources):
        T.snapshot_stored_by_timestamp(spark, path, rows_now, "id", "created_at", f"run-{number}", stage, 8)
        plain = stage(snapshot_by_timestamp(plain, rows_now, "id", "created_at"))
        assert rows(T.read_history(spark, path)) == rows(plain)
        now = files(T.history_paths(path)[1])
        assert closed.items() <= now.items()
        closed = now
    assert plain.filter("valid_to IS NOT NULL").count() == 3
    # a run repeated under its name changes nothing
    T.snapshot_stored_by_timestamp(spark, path, sources[-1], "id", "created_at", "run-2", stage, 8)
    assert rows(T.read_history(spark, path)) == rows(plain)


def test_stored_history_by_check(spark, tmp_path):
    path, stage = str(tmp_path / "h"), shared_stages(spark)
    first, second = many(spark, range(20)), many(spark, [3, 30], None, 2)
    plain = first.limit(0).selectExpr("*", "created_at AS valid_from", "created_at AS valid_to")
    for number, (now, source) in enumerate(((day(1), first), (day(9), second))):
        T.snapshot_stored_by_check(spark, path, source, ["id"], ["name"], now, f"run-{number}", stage, 4)
        plain = stage(snapshot_by_check(plain, source, ["id"], ["name"], now))
    assert rows(T.read_history(spark, path)) == rows(plain)
