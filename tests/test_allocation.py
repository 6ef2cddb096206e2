import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import builders as B
from builders import at
from modelspend.operators import allocation as A
from modelspend.plans import histories


def parts(spark, queries, periods):
    history = histories.usage_history(B.usage_history(spark, *queries), B.SETTINGS)
    return A.query_spans(history), A.usage_periods(B.billing_usage(spark, *periods))


def allocate(spark, queries, periods):
    spans, units = parts(spark, queries, periods)
    rows = A.allocate_usage(spans, units).collect()
    return sorted((r.statement_id, r.sku_name, r.dbus_consumed) for r in rows)


def totals(spark, queries, periods):
    spans, units = parts(spark, queries, periods)
    return {r.record_id: r.total_query_execution_seconds for r in A.usage_period_totals(units, spans).collect()}


def test_split_by_time(spark):
    queries = [
        {"statement_id": "a", "start_time": at(10), "end_time": at(10, 15)},
        {"statement_id": "b", "start_time": at(10, 30), "end_time": at(10, 35)},
    ]
    assert allocate(spark, queries, [{}]) == [("a", "SKU", 7.5), ("b", "SKU", 2.5)]


def test_query_over_two_periods_takes_both(spark):
    query = {"start_time": at(10, 50), "end_time": at(11, 10)}
    second = {"record_id": "v", "usage_start_time": at(11), "usage_end_time": at(12), "usage_quantity": 4.0}
    assert allocate(spark, [query], [{}, second]) == [("q", "SKU", 4.0), ("q", "SKU", 10.0)]


def test_touching_is_not_overlap(spark):
    query = {"start_time": at(9), "end_time": at(10)}
    assert allocate(spark, [query], [{}]) == [("q", None, 0.0)]
    assert totals(spark, [query], [{}]) == {"u": 3600}


def test_other_resource_or_workspace_is_not_charged(spark):
    other = [{"compute": (None, "wh2", "W")}, {"workspace_id": "ws2"}, {"compute": (None, None, "W")}]
    assert allocate(spark, other, [{}]) == [("q", None, 0.0)] * 3


def test_cluster_id_goes_before_warehouse_id(spark):
    queries = [{"compute": ("wh", "elsewhere", "C")}]
    assert allocate(spark, queries, [{}]) == [("q", "SKU", 10.0)]


def test_zero_seconds_give_zero_usage(spark):
    query = {"start_time": at(10), "end_time": at(10, 0, 0) + timedelta(milliseconds=400)}
    assert totals(spark, [query], [{}]) == {"u": 0}
    assert allocate(spark, [query], [{}]) == [("q", "SKU", 0.0)]


def test_equal_usage_rows_share_one_period(spark):
    """Grouping merges them and doubles the seconds, so half of one row is handed out."""
    query = {"start_time": at(10), "end_time": at(10, 10)}
    assert totals(spark, [query], [{}, {}]) == {"u": 1200}
    assert allocate(spark, [query], [{}, {}]) == [("q", "SKU", 5.0)]


def test_failed_statements_count_for_nothing(spark):
    queries = [{"statement_id": "a"}, {"statement_id": "b", "execution_status": "FAILED"}]
    assert allocate(spark, queries, [{}]) == [("a", "SKU", 10.0)]


def test_copies_of_an_unallocated_query_are_kept(spark):
    query = {"start_time": at(20), "end_time": at(20, 1)}
    assert allocate(spark, [query] * 3, [{}]) == [("q", None, 0.0)] * 3


def test_shares_add_up_to_the_quantity(spark):
    rng = random.Random(7)
    queries = []
    for i in range(200):
        start = at(0) + timedelta(seconds=rng.randrange(0, 20 * 3600))
        queries.append(
            {
                "statement_id": str(i),
                "start_time": start,
                "end_time": start + timedelta(seconds=rng.randrange(0, 3 * 3600)),
                "compute": (None, rng.choice(["wh", "wh", "wh2"]), "W"),
            }
        )
    periods = [
        {
            "record_id": f"{wh}_{h}",
            "sku_name": f"{wh}_{h}",
            "usage_metadata": (None, wh),
            "usage_start_time": at(h),
            "usage_end_time": at(h + 1),
            "usage_quantity": float(h + 1),
        }
        for wh in ("wh", "wh2")
        for h in range(22)
    ]
    spans, units = parts(spark, queries, periods)
    sums = A.allocate_usage(spans, units).groupBy("sku_name").agg(F.sum("dbus_consumed"))
    shared = {sku: total for sku, total in sums.collect() if sku is not None}
    assert len(shared) > 30
    for p in periods:
        if p["sku_name"] in shared:
            assert shared[p["sku_name"]] == pytest.approx(p["usage_quantity"])


def priced(spark, prices, as_of=date(2024, 2, 1)):
    usage = spark.createDataFrame([("SKU",), (None,)], "sku_name string")
    return sorted(r.dbu_unit_price for r in A.price_usage(usage, B.list_prices(spark, *prices), as_of).filter("sku_name is not null").collect())


def test_price_ends_before_its_end_date(spark):
    current = {"pricing": ((2.0,),), "price_start_time": datetime(2024, 2, 1, 15)}
    expired = {"pricing": ((9.0,),), "price_end_time": datetime(2024, 2, 1, 23)}
    future = {"pricing": ((7.0,),), "price_start_time": datetime(2024, 2, 2)}
    assert priced(spark, [current, expired, future]) == [2.0]


def test_overlapping_prices_give_a_row_each(spark):
    assert priced(spark, [{}, {"pricing": ((0.75,),)}]) == [0.5, 0.75]


def test_missing_price_is_null(spark):
    usage = spark.createDataFrame([("OTHER",), (None,)], "sku_name string")
    rows = A.price_usage(usage, B.list_prices(spark, {}), date(2024, 2, 1)).collect()
    assert [r.dbu_unit_price for r in rows] == [None, None]


def test_window_equal_to_query_contains_it(spark):
    windows = B.serverless_usage(spark, {"charged_seconds": 5}, {"charged_seconds": 7}, {"start_time": at(10, 0, 1)})
    queries = B.rpu_history(spark, {"start_time": at(10), "end_time": at(10, 1)})
    rows = A.charged_seconds_per_query(windows, queries).collect()
    assert [tuple(r) for r in rows] == [(1, 12)]


def test_query_across_windows_is_not_charged(spark):
    queries = B.rpu_history(spark, {"start_time": at(10, 0, 30), "end_time": at(10, 1, 30)})
    windows = B.serverless_usage(spark, {}, {"start_time": at(10, 1), "end_time": at(10, 2)})
    assert A.charged_seconds_per_query(windows, queries).count() == 0
