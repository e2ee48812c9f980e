"""Null times, null sort keys and null order values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weftline.operators import limiter, paging
from weftline.operators.ordered import range_totals


@pytest.mark.parametrize("descending", [(), ("k",)])
def test_pages_walk_over_null_keys_to_the_last_row(spark, descending):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, None), (4, 7), (5, 5)], "id int, k int")
    order = [F.desc("k") if descending else F.asc("k"), F.asc("id")]
    want = [r.id for r in frame.orderBy(*order).collect()]
    got = [r for r in frame.orderBy(*order).limit(2).collect()]
    while True:
        last = {"k": F.lit(got[-1].k).cast("int"), "id": F.lit(got[-1].id)}
        page = paging.page_after(frame, last, 2, descending).collect()
        if not page:
            break
        got += page
    assert [r.id for r in got] == want


def test_a_hit_without_time_does_not_disturb_its_key(spark):
    at = dt.datetime(2024, 1, 1)
    hits = spark.createDataFrame([("a", at, 1), ("a", at + dt.timedelta(seconds=1), 2), ("a", None, 3)], "k string, ts timestamp_ntz, id int")
    done = {r.id: (r.window_start, r["count"], r.allowed) for r in limiter.limit_from_first_hit(hits, "k", "ts", "id", 1, 60).collect()}
    assert done == {1: (at, 1, True), 2: (at, 2, False), 3: (None, None, None)}


@pytest.mark.parametrize("limit", [None, 2])
def test_rows_without_order_value_are_peers(spark, limit):
    frame = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", 1, 3), ("a", 2, 4), ("a", 9, 5)], "k string, t long, v long")
    done = range_totals(frame, ["k"], "t", 1, {"n": ("count", "v"), "s": ("sum", "v")}, limit=limit)
    assert sorted((r.v, r.n, r.s) for r in done.collect()) == [(1, 2, 3), (2, 2, 3), (3, 1, 3), (4, 2, 7), (5, 1, 5)]


def test_inexact_sums_are_refused(spark):
    frame = spark.createDataFrame([("a", 1, 0.5)], "k string, t long, v double")
    with pytest.raises(TypeError):
        range_totals(frame, ["k"], "t", 1, {"s": ("sum", "v")})
