import random

import pytest
from pyspark.sql import Window, functions as F
from samples import bag, rows

from weftline.operators.ordered import (
    OrderedGroups,
    range_totals,
    sessionize,
    top_per_group,
    top_per_group_with_ties,
    with_group_stats,
)
from weftline.plans.slicing import SLICE, By


def per_region(df, column, digits=None):
    out = {}
    for region, value in rows(df.orderBy("region", "sold_on"), "region", column):
        out.setdefault(region, []).append(round(value, digits) if digits is not None and value is not None else value)
    return out


@pytest.fixture
def groups(data):
    return OrderedGroups(data.dated, ["region"], ["sold_on", "id"])


def test_group_total_on_every_row(data):
    stamped = with_group_stats(data.dated, ["region"], total=F.sum("amount"))
    assert per_region(stamped, "total") == {"North": [560] * 5, "South": [595] * 4}


def test_top_two_per_region(data):
    best = top_per_group(data.dated, ["region"], ["-amount", "id"], 2)
    assert bag(best, "region", "amount") == [("North", 120), ("North", 150), ("South", 180), ("South", 200)]


def test_rank_and_dense_rank(data):
    one = data.dated.withColumn("all", F.lit(1))
    ranked = OrderedGroups(one, ["all"], ["-amount"]).rank("rk", "dr").df.orderBy(F.desc("amount"), "id")
    assert rows(ranked, "rk") == [(r,) for r in (1, 2, 3, 4, 4, 6, 7, 8, 9)]
    assert rows(ranked, "dr") == [(r,) for r in (1, 2, 3, 4, 4, 5, 6, 7, 8)]


def test_running_total(groups):
    done = groups.running({"total": ("sum", "amount")}).df
    assert per_region(done, "total") == {"North": [100, 180, 330, 450, 560], "South": [200, 380, 500, 595]}


def test_running_total_shares_a_value_among_peers(spark):
    frame = spark.createDataFrame([("k", 1, 5), ("k", 1, 7), ("k", 2, 1)], "k string, t int, v int")
    done = OrderedGroups(frame, ["k"], ["t"]).running({"s": ("sum", "v")}, peers=True).df
    assert bag(done, "t", "v", "s") == [(1, 5, 12), (1, 7, 12), (2, 1, 13)]


def test_moving_average(groups):
    done = groups.neighbours({"m": lambda w: F.avg("amount").over(w.rowsBetween(-2, 0))}, before=2).df
    assert per_region(done, "m", 1) == {
        "North": [100.0, 90.0, 110.0, 116.7, 126.7],
        "South": [200.0, 190.0, 166.7, 131.7],
    }


def test_lag_and_lead(groups):
    done = groups.neighbours(
        {
            "back": lambda w: F.col("amount") - F.lag("amount").over(w),
            "ahead": lambda w: F.lead("amount").over(w) - F.col("amount"),
            "two": lambda w: F.lag("amount", 2, 0).over(w),
        },
        before=2,
        after=1,
    ).df
    assert per_region(done, "back") == {"North": [None, -20, 70, -30, -10], "South": [None, -20, -60, -25]}
    assert per_region(done, "ahead") == {"North": [-20, 70, -30, -10, None], "South": [-20, -60, -25, None]}
    assert per_region(done, "two")["South"] == [0, 0, 200, 180]


def test_sessions_open_after_a_gap(spark):
    frame = spark.createDataFrame([("u", 0, 1), ("u", 10, 2), ("u", 21, 3), ("v", 5, 4)], "u string, t int, id int")
    done = sessionize(frame, ["u"], "t", "id", F.lit(10))
    assert bag(done, "id", "session_no") == [(1, 1), (2, 1), (3, 2), (4, 1)]


# ---- sliced groups against the plain window ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Fifteen hundred rows; one key holds half of them, one key is NULL, order values repeat and are sometimes NULL."""
    rng = random.Random(3)
    keys = ["hot"] * 6 + ["warm"] * 3 + [None] * 2 + ["cold"]
    table = [
        (i, rng.choice(keys), rng.choice([None, *range(40)]), rng.choice([None, *range(100)])) for i in range(1500)
    ]
    rng.shuffle(table)
    frame = spark.createDataFrame(table, "id long, k string, t long, v long").repartition(5)
    return frame.withColumn("d", F.col("v").cast("decimal(18,2)"))


def same(got, want):
    columns = got.columns
    assert set(columns) == set(want.columns)
    want = want.select(*columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["-t", "id"], [By("t", True, False), "-id"]])
def test_slices_agree_with_the_plain_window(skewed, keys, order):
    from weftline.plans.slicing import sort_columns

    cut = OrderedGroups(skewed, keys, order, limit=100)
    assert cut.large
    largest = cut.sliced.groupBy(*keys, SLICE).count().agg(F.max("count")).first()[0]
    assert largest < 400
    w = Window.partitionBy(*keys).orderBy(*[e.column() for e in sort_columns(order)])
    got = cut.running({"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")}).number("rn").df
    rows_frame = w.rowsBetween(Window.unboundedPreceding, 0)
    same(
        got,
        skewed.withColumns(
            {
                "s": F.sum("v").over(rows_frame),
                "n": F.count("v").over(rows_frame),
                "lo": F.min("v").over(rows_frame),
                "hi": F.max("v").over(rows_frame),
                "rn": F.row_number().over(w).cast("long"),
            }
        ),
    )
    got = cut.neighbours(
        {
            "a": lambda w: F.lag("v", 3, -1).over(w),
            "b": lambda w: F.lead("v", 2).over(w),
            "c": lambda w: F.sum("v").over(w.rowsBetween(-3, 2)),
        },
        before=3,
        after=2,
    ).df
    same(
        got,
        skewed.withColumns(
            {
                "a": F.lag("v", 3, -1).over(w),
                "b": F.lead("v", 2).over(w),
                "c": F.sum("v").over(w.rowsBetween(-3, 2)),
            }
        ),
    )


def test_neighbours_reach_over_slices_with_fewer_rows(spark):
    """More neighbours than a slice holds rows."""
    frame = spark.range(60).select(F.lit("k").alias("k"), "id")
    cut = OrderedGroups(frame, ["k"], ["id"], limit=4)
    assert cut.large
    w = Window.partitionBy("k").orderBy("id")
    got = cut.neighbours({"b": lambda w: F.lag("id", 25).over(w), "f": lambda w: F.lead("id", 25).over(w)}, 25, 25).df
    same(got, frame.withColumns({"b": F.lag("id", 25).over(w), "f": F.lead("id", 25).over(w)}))


@pytest.mark.parametrize("keys", [["k"], []])
def test_sliced_peers_and_ranks(skewed, keys):
    cut = OrderedGroups(skewed, keys, ["-t"], limit=100)
    w = Window.partitionBy(*keys).orderBy(F.col("t").desc_nulls_last())
    same(
        cut.running({"s": ("sum", "v"), "n": ("count", "v"), "m": ("avg", "v")}, peers=True).df,
        skewed.withColumns({"s": F.sum("v").over(w), "n": F.count("v").over(w), "m": F.avg("v").over(w)}),
    )
    ranks = {"rk": F.rank().over(w).cast("long"), "dr": F.dense_rank().over(w).cast("long")}
    same(cut.rank("rk", "dr").df, skewed.withColumns(ranks))
    if keys:
        same(
            top_per_group_with_ties(skewed, keys, ["-t"], 4),
            skewed.withColumns({"rk": ranks["rk"]}).where("rk <= 4"),
        )


def test_sliced_range_frame(skewed):
    known = skewed.where("t is not null")
    columns = {"n": ("count", F.lit(1)), "s": ("sum", "v")}
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-7, 0)
    want = known.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum("v").over(w)})
    same(range_totals(known, ["k"], "t", 7, columns, limit=100), want)
    same(range_totals(known, ["k"], "t", 7, columns), want)


def test_order_of_arrival_does_not_matter(skewed):
    again = skewed.repartition(3, "v").orderBy(F.rand(5))
    for limit in (100, None):
        a = OrderedGroups(skewed, ["k"], ["t", "id"], limit).running({"s": ("sum", "v")}).number("rn").df
        b = OrderedGroups(again, ["k"], ["t", "id"], limit).running({"s": ("sum", "v")}).number("rn").df
        same(a, b)


def test_empty_and_single_row_groups(spark, skewed):
    empty = skewed.limit(0)
    assert OrderedGroups(empty, ["k"], ["id"]).number("rn").df.count() == 0
    assert OrderedGroups(empty, [], ["id"]).number("rn").df.count() == 0
    one = skewed.limit(1)
    for keys in (["k"], []):
        got = OrderedGroups(one, keys, ["id"], limit=1).running({"n": ("count", F.lit(1))}).number("rn").df
        assert rows(got, "n", "rn") == [(1, 1)]


def test_timestamps_and_text_as_slice_borders(spark):
    frame = spark.range(500).select(
        F.lit("k").alias("k"),
        "id",
        (F.expr("TIMESTAMP_NTZ'2024-03-31 00:00:00'") + F.make_dt_interval(secs=(F.col("id") * 37 % 101).cast("decimal(18,6)"))).alias("ts"),
        F.concat(F.lit("n"), F.col("id") % 13).alias("name"),
    )
    cut = OrderedGroups(frame, ["k"], ["-name", "ts", "id"], limit=40)
    w = Window.partitionBy("k").orderBy(F.desc("name"), "ts", "id")
    assert cut.sliced.select(SLICE).distinct().count() > 10
    same(cut.number("rn").df, frame.withColumn("rn", F.row_number().over(w).cast("long")))


def test_totals_and_ranks_over_five_thousand_slices(spark):
    """More slices than one task scans: totals go up and down by levels."""
    n = 20_000
    frame = spark.range(0, n, 1, 4).select(((F.col("id") * 7919) % n).alias("v"), (F.col("id") % 2 + 1).alias("amount"))
    groups = OrderedGroups(frame, [], ["v"], limit=8)
    done = groups.number("place").running({"total": ("sum", "amount"), "most": ("max", "amount")}).df.agg(
        F.count(F.lit(1)), F.sum((F.col("place") == F.col("v") + 1).cast("int")), F.max("total"), F.sum((F.col("total") < F.col("place")).cast("int")), F.min("most")
    )
    assert tuple(done.first()) == (n, n, n * 3 // 2, 0, 1)
    slices = groups.sliced.agg(F.countDistinct(SLICE)).first()[0]
    assert slices > 3_000


@pytest.mark.parametrize("fan", [2, 5, 1024])
def test_totals_by_levels(spark, monkeypatch, fan):
    from weftline.operators import ordered

    monkeypatch.setattr(ordered, "FAN", fan)
    rng = random.Random(fan)
    table = [(rng.choice("aaab"), i, rng.randrange(9)) for i in range(400)]
    frame = spark.createDataFrame(table, "k string, i long, v long")
    values = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "mean": ("avg", "v")}
    got = OrderedGroups(frame, ["k"], ["i"], limit=10).running(values).df
    assert bag(got) == bag(OrderedGroups(frame, ["k"], ["i"]).running(values).df)
