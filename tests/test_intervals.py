"""The cell join against a plain loop, on awkward ranges."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend.functions import expressions as E
from modelspend.operators.intervals import Span, in_cells, interval_join, without_match

BASE = datetime(2024, 1, 1)
SCHEMA = "k string, id long, s timestamp_ntz, e timestamp_ntz"


def ranges(rng, n, keys):
    """Ranges from instants to centuries: reversed, empty, NULL-ended, and many around one hour."""
    rows = []
    for i in range(n):
        start = BASE + timedelta(seconds=rng.randrange(0, 14 * 86400), microseconds=rng.choice([0, 1, 999999]))
        length = rng.choice([0, 1, 60, 3600, 3600, 3600, 7200, 86400, 40 * 86400, 300 * 365 * 86400])
        end = start + timedelta(seconds=length * rng.choice([1, 1, 1, 1, -1]) if length < 10**9 else length)
        rows.append((rng.choice(keys), i, start, end))
    rows.append((None, n, BASE, BASE + timedelta(hours=1)))
    rows.append((keys[0], n + 1, BASE, None))
    rows.append((keys[0], n + 2, None, BASE))
    rows.append((keys[0], n + 3, datetime(1969, 12, 31, 23, 59, 30), datetime(1970, 1, 1, 0, 0, 30)))
    return rows


def both_sides(spark, seed, n=120, keys=("a", "b")):
    rng = random.Random(seed)
    left, right = ranges(rng, n, keys), ranges(rng, n, keys)
    l = spark.createDataFrame(left, SCHEMA).toDF("lk", "lid", "ls", "le")
    r = spark.createDataFrame(right, SCHEMA).toDF("rk", "rid", "rs", "re")
    return left, right, l, r


def ids(df):
    return Counter((row.lid, row.rid) for row in df.select("lid", "rid").collect())


def full(row):
    return None not in row


@pytest.mark.parametrize("width", [60, 3600])
@pytest.mark.parametrize("seed", [1, 2])
def test_overlap_equals_loop(spark, seed, width):
    left, right, l, r = both_sides(spark, seed)
    joined = interval_join(
        l,
        r,
        small_span=Span("ls", "le"),
        large_span=Span("rs", "re"),
        on=[("lk", "rk")],
        condition=(F.col("ls") < F.col("re")) & (F.col("le") > F.col("rs")),
        width=width,
    )
    expected = Counter(
        (a[1], b[1])
        for a in left
        for b in right
        if full(a) and full(b) and a[0] == b[0] and a[2] < b[3] and a[3] > b[2]
    )
    assert ids(joined) == expected
    assert joined.columns == [*l.columns, *r.columns]


def test_containment_without_key_equals_loop(spark):
    left, right, l, r = both_sides(spark, 3)
    joined = interval_join(
        l,
        r,
        small_span=Span("ls", "le"),
        large_span=Span("rs", "re"),
        condition=(F.col("rs") >= F.col("ls")) & (F.col("re") <= F.col("le")),
        width=60,
    )
    expected = Counter(
        (a[1], b[1])
        for a in left
        for b in right
        if None not in a[2:] and None not in b[2:] and b[2] >= a[2] and b[3] <= a[3]
    )
    assert ids(joined) == expected


def test_point_in_range_equals_loop(spark):
    left, right, l, r = both_sides(spark, 4)
    joined = interval_join(
        l,
        r,
        small_span=Span("ls", "le"),
        large_span=Span("rs", "rs"),
        on=[("lk", "rk")],
        condition=(F.col("rs") >= F.col("ls")) & (F.col("rs") <= F.col("le")),
    )
    expected = Counter(
        (a[1], b[1])
        for a in left
        for b in right
        if full(a) and b[0] is not None and b[2] is not None and a[0] == b[0] and a[2] <= b[2] <= a[3]
    )
    assert ids(joined) == expected


def test_copies_are_kept(spark):
    row = [("a", 1, BASE, BASE + timedelta(hours=5))]
    l = spark.createDataFrame(row * 3, SCHEMA).toDF("lk", "lid", "ls", "le")
    r = spark.createDataFrame(row * 2, SCHEMA).toDF("rk", "rid", "rs", "re")
    joined = interval_join(
        l, r, small_span=Span("ls", "le"), large_span=Span("rs", "re"), condition=F.lit(True), on=[("lk", "rk")]
    )
    assert joined.count() == 6


def test_empty_side(spark):
    _, _, l, r = both_sides(spark, 5)
    joined = interval_join(
        l, r.filter("false"), small_span=Span("ls", "le"), large_span=Span("rs", "re"), condition=F.lit(True)
    )
    assert joined.count() == 0


def test_long_ranges_stay_a_handful_of_cells(spark):
    rows = [("a", i, BASE, BASE + timedelta(days=d)) for i, d in enumerate((0, 1, 30, 365, 36500, 2900000))]
    df = spark.createDataFrame(rows, SCHEMA)
    levels = F.array(*[F.lit(i) for i in range(8)])
    cells = in_cells(df, Span("s", "e"), levels, 60, "_", small=True).groupBy("id", "_level").count()
    assert cells.agg(F.max("count")).first()[0] <= 34


def test_without_match_keeps_copies_and_nulls(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    left = spark.createDataFrame([("x", None), ("x", None), ("y", None), ("y", None), (None, "z")], schema)
    matched = spark.createDataFrame([("x", None)], schema)
    rest = without_match(left, matched, decided_by=["a"], nullable=["b"])
    assert Counter(map(tuple, rest.collect())) == Counter({("y", None): 2, (None, "z"): 1})


def test_one_long_range_adds_its_own_candidates_only(spark):
    hours = [("a", i, BASE + timedelta(hours=i), BASE + timedelta(hours=i + 1)) for i in range(200)]
    long = [("a", 999, BASE, BASE + timedelta(days=60))]
    queries = spark.createDataFrame(
        [("a", i, BASE + timedelta(minutes=7 * i), BASE + timedelta(minutes=7 * i + 3)) for i in range(1500)], SCHEMA
    )

    def candidates(rows):
        small = spark.createDataFrame(rows, SCHEMA)
        s = in_cells(small, Span("s", "e"), F.expr("sequence(0, 6)"), 3600, "_s_", small=True)
        peers = F.array(*[F.lit(i) for i in ((0, 2) if len(rows) > 200 else (0,))])
        l = in_cells(queries, Span("s", "e"), peers, 3600, "_l_", small=False)
        s, l = s.select("_s_level", "_s_role", "_s_cell"), l.select("_l_level", "_l_role", "_l_cell")
        same = [F.col(f"_s_{c}") == F.col(f"_l_{c}") for c in ("level", "role", "cell")]
        return s.join(l, same).count()

    assert candidates(hours + long) <= candidates(hours) + 2 * 1500


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clock_changes_of_the_session_have_no_part(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = lambda h, m: f"timestamp_ntz'2024-03-10 0{h}:{m}:00'"
        small = spark.sql(f"select 1 as id, {at(2, 30)} as ls, {at(3, 10)} as le")
        large = spark.sql(f"select {at(2, 50)} as rs, {at(2, 51)} as re")
        joined = interval_join(
            small,
            large,
            small_span=Span("ls", "le"),
            large_span=Span("rs", "re"),
            condition=F.expr("rs >= ls and re <= le"),
            width=60,
        )
        assert joined.count() == 1
        crossed = E.second_boundaries_between(F.expr(at(1, 59)), F.expr(at(3, "01")))
        assert spark.range(1).select(crossed).first()[0] == 3720
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
