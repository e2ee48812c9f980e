"""Window functions over the whole tables: totals, ranks, running values, moving frames, neighbours and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import epoch_micros, money
from weftline.operators.ordered import (
    OrderedGroups,
    join_same,
    range_totals,
    sessionize,
    top_per_group,
    top_per_group_with_ties,
    with_group_stats,
)
from weftline.plans.registry import query
from weftline.sources.tables import Tables

MONEY = "CAST(o_totalprice AS DECIMAL(18,2))"
BY_DATE = "PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey"


def sales(t: Tables) -> DataFrame:
    """Orders as dated sales per priority."""
    return t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")


def by_date(t: Tables) -> OrderedGroups:
    return OrderedGroups(sales(t), ["o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query(
    "win_group_total",
    """
    SELECT o_orderkey, o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority) AS DOUBLE) AS group_total,
           max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS group_max
    FROM orders
    """,
)
def win_group_total(t: Tables) -> DataFrame:
    stamped = with_group_stats(
        sales(t),
        ["o_orderpriority"],
        group_total=F.sum(money("o_totalprice")).cast("double"),
        group_max=F.max("o_totalprice"),
    )
    return stamped.select("o_orderkey", "o_orderpriority", "group_total", "group_max")


@query(
    "win_above_avg",
    """
    SELECT o_orderkey FROM (
      SELECT o_orderkey, o_totalprice,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS mean
      FROM orders WINDOW w AS (PARTITION BY o_custkey))
    WHERE o_totalprice > mean
    """,
)
def win_above_avg(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    mean = F.sum(money("o_totalprice")).cast("double") / F.count(F.lit(1))
    return with_group_stats(rows, ["o_custkey"], mean=mean).where("o_totalprice > mean").select("o_orderkey")


@query(
    "win_row_number",
    f"SELECT o_orderkey, o_orderpriority, row_number() OVER ({BY_DATE}) AS rn FROM orders",
)
def win_row_number(t: Tables) -> DataFrame:
    return by_date(t).number("rn").df.select("o_orderkey", "o_orderpriority", "rn")


@query(
    "win_rank_ties",
    """
    SELECT p_partkey, p_brand, p_size, rank() OVER w AS rk, dense_rank() OVER w AS dr
    FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC NULLS LAST)
    """,
)
def win_rank_ties(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    return OrderedGroups(parts, ["p_brand"], ["-p_size"]).rank("rk", "dr").df


@query(
    "topn_per_group",
    """
    SELECT o_orderkey, c_mktsegment, o_totalprice, rn FROM (
      SELECT o_orderkey, c_mktsegment, o_totalprice,
             row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
      FROM orders JOIN customer ON c_custkey = o_custkey)
    WHERE rn <= 3
    """,
)
def topn_per_group(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select("o_orderkey", "c_mktsegment", "o_totalprice")
    return top_per_group(rows, ["c_mktsegment"], ["-o_totalprice", "o_orderkey"], 3)


@query(
    "topn_with_ties",
    """
    SELECT p_partkey, p_brand, p_size, rk FROM (
      SELECT p_partkey, p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC NULLS LAST) AS rk FROM part)
    WHERE rk <= 3
    """,
)
def topn_with_ties(t: Tables) -> DataFrame:
    return top_per_group_with_ties(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], ["-p_size"], 3)


@query(
    "win_running_total",
    f"""
    SELECT o_orderkey, o_orderpriority, CAST(sum({MONEY}) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS DOUBLE)
           AS running_total
    FROM orders
    """,
)
def win_running_total(t: Tables) -> DataFrame:
    """Default frame: orders of one day share the total at the end of that day."""
    groups = OrderedGroups(sales(t), ["o_orderpriority"], ["o_orderdate"])
    done = groups.running({"running_total": ("sum", money("o_totalprice"))}, peers=True).df
    return done.select("o_orderkey", "o_orderpriority", F.col("running_total").cast("double").alias("running_total"))


@query(
    "win_running_stats",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n, CAST(sum({MONEY}) OVER w AS DOUBLE) / count(*) OVER w AS mean,
           min(o_totalprice) OVER w AS low, max(o_totalprice) OVER w AS high
    FROM orders WINDOW w AS ({BY_DATE} ROWS UNBOUNDED PRECEDING)
    """,
)
def win_running_stats(t: Tables) -> DataFrame:
    done = by_date(t).running(
        {
            "n": ("count", F.lit(1)),
            "mean": ("avg", money("o_totalprice")),
            "low": ("min", "o_totalprice"),
            "high": ("max", "o_totalprice"),
        }
    )
    return done.df.select("o_orderkey", "n", "mean", "low", "high")


@query(
    "win_running_global",
    f"""
    SELECT o_orderkey, CAST(sum({MONEY}) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           AS running_total
    FROM orders
    """,
)
def win_running_global(t: Tables) -> DataFrame:
    done = OrderedGroups(sales(t), [], ["o_orderdate", "o_orderkey"]).running(
        {"running_total": ("sum", money("o_totalprice"))}
    )
    return done.df.select("o_orderkey", F.col("running_total").cast("double").alias("running_total"))


def _frame_avg(name: str, low: int, high: int):
    """Average over a ROWS frame as exact sum over count."""

    def make(w):
        frame = w.rowsBetween(low, high)
        return F.sum(money(name)).over(frame).cast("double") / F.count(name).over(frame)

    return make


@query(
    "win_moving_avg",
    f"""
    SELECT o_orderkey, CAST(sum({MONEY}) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg
    FROM orders WINDOW w AS ({BY_DATE} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def win_moving_avg(t: Tables) -> DataFrame:
    done = by_date(t).neighbours({"moving_avg": _frame_avg("o_totalprice", -2, 0)}, before=2)
    return done.df.select("o_orderkey", "moving_avg")


@query(
    "win_centered_avg",
    f"""
    SELECT o_orderkey, CAST(sum({MONEY}) OVER w AS DOUBLE) / count(*) OVER w AS centered_avg
    FROM orders WINDOW w AS ({BY_DATE} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
    """,
)
def win_centered_avg(t: Tables) -> DataFrame:
    done = by_date(t).neighbours({"centered_avg": _frame_avg("o_totalprice", -1, 1)}, before=1, after=1)
    return done.df.select("o_orderkey", "centered_avg")


@query(
    "win_full_frame",
    f"""
    SELECT o_orderkey, CAST(sum({MONEY}) OVER w AS DOUBLE) / count(*) OVER w AS customer_avg, count(*) OVER w AS customer_orders
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def win_full_frame(t: Tables) -> DataFrame:
    """A frame over the whole group is the group aggregate, so no ordered window is needed."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    mean = F.sum(money("o_totalprice")).cast("double") / F.count(F.lit(1))
    return with_group_stats(rows, ["o_custkey"], customer_avg=mean, customer_orders=F.count(F.lit(1))).select(
        "o_orderkey", "customer_avg", "customer_orders"
    )


@query(
    "win_range_interval",
    f"""
    SELECT o_orderkey, CAST(sum({MONEY}) OVER w AS DOUBLE) AS last_days_total, count(*) OVER w AS last_days_orders
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW)
    """,
)
def win_range_interval(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", epoch_micros("o_orderdate").alias("at"))
    two_days = 2 * 86_400 * 1_000_000
    done = range_totals(
        rows,
        ["o_custkey"],
        "at",
        two_days,
        {"last_days_total": ("sum", money("o_totalprice")), "last_days_orders": ("count", F.lit(1))},
    )
    return done.select("o_orderkey", F.col("last_days_total").cast("double").alias("last_days_total"), "last_days_orders")


@query(
    "win_lag_delta",
    f"""
    SELECT o_orderkey, lag({MONEY}::DOUBLE) OVER w AS prev_price, CAST({MONEY} - lag({MONEY}) OVER w AS DOUBLE) AS delta
    FROM orders WINDOW w AS ({BY_DATE})
    """,
)
def win_lag_delta(t: Tables) -> DataFrame:
    price = money("o_totalprice")
    done = by_date(t).neighbours(
        {
            "prev_price": lambda w: F.lag("o_totalprice").over(w),
            "delta": lambda w: (price - F.lag(price).over(w)).cast("double"),
        },
        before=1,
    )
    return done.df.select("o_orderkey", "prev_price", "delta")


@query(
    "win_lead_delta",
    f"""
    SELECT o_orderkey, CAST(lead({MONEY}) OVER w - {MONEY} AS DOUBLE) AS change_to_next FROM orders WINDOW w AS ({BY_DATE})
    """,
)
def win_lead_delta(t: Tables) -> DataFrame:
    price = money("o_totalprice")
    done = by_date(t).neighbours(
        {"change_to_next": lambda w: (F.lead(price).over(w) - price).cast("double")}, after=1
    )
    return done.df.select("o_orderkey", "change_to_next")


@query(
    "win_lag_offset_default",
    f"""
    SELECT o_orderkey, lag(o_orderkey, 2, -1) OVER w AS two_back, lead(o_orderkey, 3) OVER w AS three_ahead
    FROM orders WINDOW w AS ({BY_DATE})
    """,
)
def win_lag_offset_default(t: Tables) -> DataFrame:
    done = by_date(t).neighbours(
        {
            "two_back": lambda w: F.lag("o_orderkey", 2, -1).over(w),
            "three_ahead": lambda w: F.lead("o_orderkey", 3).over(w),
        },
        before=2,
        after=3,
    )
    return done.df.select("o_orderkey", "two_back", "three_ahead")


def by_user(t: Tables) -> OrderedGroups:
    return OrderedGroups(t.events.select("event_id", "user_id", "ts", "event_type", "value"), ["user_id"], ["ts", "event_id"])


@query(
    "win_change_flag",
    """
    SELECT event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type, false) AS changed
    FROM events
    """,
)
def win_change_flag(t: Tables) -> DataFrame:
    done = by_user(t).neighbours({"before": lambda w: F.lag("event_type").over(w)}, before=1).df
    changed = F.coalesce(F.col("before") != F.col("event_type"), F.lit(False))
    return done.select("event_id", changed.alias("changed"))


@query(
    "win_event_gap",
    """
    SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap_micros
    FROM events
    """,
)
def win_event_gap(t: Tables) -> DataFrame:
    done = by_user(t).neighbours({"before": lambda w: F.lag("ts").over(w)}, before=1).df
    return done.select("event_id", (epoch_micros("ts") - epoch_micros("before")).alias("gap_micros"))


@query(
    "date_diff_prev",
    """
    SELECT o_orderkey,
           date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate)
             AS days_since_last
    FROM orders
    """,
)
def date_diff_prev(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    groups = OrderedGroups(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    done = groups.neighbours({"before": lambda w: F.lag("o_orderdate").over(w)}, before=1).df
    return done.select("o_orderkey", F.date_diff("o_orderdate", "before").cast("long").alias("days_since_last"))


@query(
    "win_sessionize",
    """
    SELECT event_id, user_id,
           CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
    FROM (SELECT event_id, user_id, ts,
                 CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOURS >= ts THEN 0 ELSE 1 END
                   AS opens
          FROM events)
    """,
)
def win_sessionize(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts")
    return sessionize(rows, ["user_id"], "ts", "event_id", F.expr("INTERVAL 6 HOURS")).drop("ts")


@query(
    "win_first_last",
    """
    SELECT event_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def win_first_last(t: Tables) -> DataFrame:
    """First and last of a whole group are mergeable aggregates; no sort of the group is needed."""
    when = F.struct("ts", "event_id")
    stamped = with_group_stats(
        t.events.select("event_id", "user_id", "ts", "event_type"),
        ["user_id"],
        first_type=F.min_by("event_type", when),
        last_type=F.max_by("event_type", when),
    )
    return stamped.select("event_id", "first_type", "last_type")


@query(
    "win_named",
    f"""
    SELECT o_orderkey, row_number() OVER w AS rn, count(*) OVER w AS n, lag(o_orderkey) OVER w AS prev_key
    FROM orders WINDOW w AS ({BY_DATE})
    """,
)
def win_named(t: Tables) -> DataFrame:
    """Several functions over one window definition. The groups are checked and shuffled once for all of them."""
    done = (
        by_date(t)
        .number("rn")
        .running({"n": ("count", F.lit(1))})
        .neighbours({"prev_key": lambda w: F.lag("o_orderkey").over(w)}, before=1)
    )
    return done.df.select("o_orderkey", "rn", "n", "prev_key")


@query(
    "prev_row_asof",
    """
    SELECT e.event_id, e.value, (SELECT max(p.ts) FROM events p
                                 WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts < e.ts) AS last_purchase
    FROM events e
    """,
)
def prev_row_asof(t: Tables) -> DataFrame:
    """As-of lookup of the latest earlier purchase, as a running maximum: no pair of rows is ever formed.

    Rows of one moment must not see each other, so the maximum is taken over the moments before it.
    """
    bought = F.when(F.col("event_type") == "purchase", F.col("ts"))
    moments = t.events.groupBy("user_id", "ts").agg(F.max(bought).alias("bought"))
    seen = OrderedGroups(moments, ["user_id"], ["ts"]).running({"upto": ("max", "bought")})
    before = seen.neighbours({"last_purchase": lambda w: F.lag("upto").over(w)}, before=1).df
    rows = t.events.select("event_id", "user_id", "ts", "value")
    joined = join_same(rows, before.select("user_id", "ts", "last_purchase"), ["user_id", "ts"])
    return joined.select("event_id", "value", "last_purchase")
