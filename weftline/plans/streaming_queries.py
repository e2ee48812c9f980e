"""The event table as a stream that arrives in several pieces. Every result must equal the same question asked of the whole
table at once, or of the rows that come in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money
from weftline.operators import leaderboard
from weftline.operators.views import BucketedAggregate, BucketedLatest
from weftline.plans.keyvalue_queries import shown
from weftline.plans import subquery_queries  # noqa: F401  (its SQL is used below)
from weftline.plans.registry import ORACLES, query
from weftline.session import scratch_path
from weftline.sources.tables import Tables
from weftline.streaming import arrivals, first_seen, runs, windows
from weftline.streaming.limiter import limit_stream

DELAY = "1 hour"
#: Micro-batches of the time-ordered streams; rows of the unordered ones come up to three quarters of an hour late.
PIECES = 3
UNORDERED = "event_id % 4 * 900"
#: Late rows: an arrival every ARRIVAL_DAYS days, and every LATE_EVERY-th event comes LATE_DAYS days late.
ARRIVAL_DAYS, LATE_DAYS, LATE_EVERY = 5, 9, 10
#: Folders of a stored table; a merge rewrites those that a micro-batch touches.
BUCKETS = 16
#: A user is first seen again after so many days.
TTL_DAYS = 3


def arriving(t: Tables, late_by: str = "0") -> arrivals.Arrivals:
    return arrivals.in_pieces(runs.event_time(t.events, "ts"), "ts", PIECES, F.expr(late_by))


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_tumbling",
    """
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS hits,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
    """,
)
def stream_tumbling(t: Tables) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return windows.tumbling(
            events, "ts", "1 day", DELAY, ["event_type"], hits=F.count(F.lit(1)), total=F.sum(money("value"))
        )

    feed = arriving(t, UNORDERED)
    result, _ = runs.run_to_close(feed.stream, "ts", build, feed)
    return zoneless(result, "window_start").withColumn("total", F.col("total").cast("double"))


@query(
    "stream_sliding",
    """
    SELECT date_trunc('hour', ts) - to_hours(back * 6) - to_hours(CAST(hour(ts) % 6 AS BIGINT)) AS window_start, event_type,
           count(*) AS hits
    FROM events, generate_series(0, 3) AS g(back) GROUP BY 1, 2
    """,
)
def stream_sliding(t: Tables) -> DataFrame:
    """A day's hits, every six hours, in update mode: the last value of each window wins."""
    feed = arriving(t, UNORDERED)
    counts = windows.sliding(feed.stream, "ts", "1 day", "6 hours", DELAY, ["event_type"], hits=F.count(F.lit(1)))
    return zoneless(runs.run_updates(counts, ["window_start", "event_type"], feed), "window_start")


@query(
    "stream_sessions",
    """
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOURS AS session_end, count(*) AS hits FROM (
      SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
      FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOURS >= ts
                           THEN 0 ELSE 1 END AS opens FROM events))
    GROUP BY user_id, s
    """,
)
def stream_sessions(t: Tables) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return windows.sessions(events, "ts", "6 hours", DELAY, ["user_id"], hits=F.count(F.lit(1)))

    feed = arriving(t, UNORDERED)
    result, _ = runs.run_to_close(feed.stream, "ts", build, feed)
    return zoneless(result, "session_start", "session_end")


@query(
    "stream_first_seen",
    f"""
    WITH RECURSIVE hits AS (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events),
    fold AS (
      SELECT user_id, event_type, event_id, ts, n, ts AS seen FROM hits WHERE n = 1
      UNION ALL
      SELECT h.user_id, h.event_type, h.event_id, h.ts, h.n, CASE WHEN h.ts >= f.seen + INTERVAL {TTL_DAYS} DAY THEN h.ts ELSE f.seen END
      FROM fold f JOIN hits h ON h.user_id = f.user_id AND h.event_type = f.event_type AND h.n = f.n + 1)
    SELECT user_id, event_type, event_id, ts FROM fold WHERE ts = seen
      AND event_id = (SELECT min(event_id) FROM events e WHERE e.user_id = fold.user_id AND e.event_type = fold.event_type AND e.ts = fold.ts)
    """,
)
def stream_first_seen(t: Tables) -> DataFrame:
    """First sight of each user and event type, and again when they were not first for some days."""
    feed = arriving(t, UNORDERED)

    def build(events: DataFrame) -> DataFrame:
        return first_seen.first_within(events, "ts", "event_id", ["user_id", "event_type"], TTL_DAYS * 86_400, DELAY)

    with first_seen.timers(t.spark):
        result, _ = runs.run_to_close(feed.stream, "ts", build, feed)
    return zoneless(result, "ts")


@query("stream_latest", ORACLES["kv_latest"])
def stream_latest(t: Tables) -> DataFrame:
    """The latest event per user, merged into a snapshot table batch by batch."""
    folder = scratch_path(t.spark, "latest")
    table = BucketedLatest(t.spark, f"{folder}/table", ["user_id"], ["ts", "event_id"], BUCKETS)
    feed = arriving(t, UNORDERED)
    runs.run_merging(feed.stream, table.merge, f"{folder}/checkpoint", feed)
    return table.read().select("user_id", "event_id", "event_type")


@query("stream_leaderboard", ORACLES["leaderboard_top"])
def stream_leaderboard(t: Tables) -> DataFrame:
    """Scores kept up to date from the stream; the board is read from the stored totals."""
    folder = scratch_path(t.spark, "board")
    totals = BucketedAggregate(t.spark, f"{folder}/table", ["user_id"], {"score": "points"}, "events", BUCKETS)
    feed = arriving(t)
    points = feed.stream.select("user_id", money("value").alias("points"))
    runs.run_merging(points, totals.merge, f"{folder}/checkpoint", feed)
    return shown(leaderboard.top(totals.read().select("user_id", "score"), "user_id", 10))


@query(
    "stream_rate_limit",
    f"SELECT event_id, user_id, window_start, count, allowed FROM ({ORACLES['rate_limit_anchored']})",
)
def stream_rate_limit(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "limiter")
    feed = arriving(t)
    limited = limit_stream(feed.stream, "user_id", "ts", "event_id", 2, 86_400, DELAY)
    runs.append_to(limited, f"{folder}/out", f"{folder}/checkpoint", feed)
    return zoneless(t.spark.read.parquet(f"{folder}/out"), "window_start")


@query("stream_matview", ORACLES["matview_incremental"])
def stream_matview(t: Tables) -> DataFrame:
    """A stored aggregate that follows the stream; each micro-batch is merged once, also when it is repeated."""
    folder = scratch_path(t.spark, "matview-stream")
    totals = BucketedAggregate(t.spark, f"{folder}/table", ["event_type", "day"], {"total": "amount"}, "events", BUCKETS)
    feed = arriving(t)
    rows = feed.stream.select("event_type", F.to_date("ts").alias("day"), money("value").alias("amount"))
    runs.run_merging(rows, totals.merge, f"{folder}/checkpoint", feed)
    return totals.read().select("event_type", "day", "events", F.col("total").cast("double").alias("total"))


@query(
    "stream_late_rows",
    f"""
    WITH a AS (SELECT *, (date_diff('day', (SELECT min(ts) FROM events), ts)
                          + CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATE_DAYS} ELSE 0 END) // {ARRIVAL_DAYS} AS arrival FROM events),
    tops AS (SELECT arrival, max(ts) AS top FROM a GROUP BY 1),
    marks AS (SELECT arrival, date_trunc('millisecond', max(top) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                              - INTERVAL 1 HOUR AS mark FROM tops),
    judged AS (SELECT a.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= mark, false) AS late FROM a JOIN marks USING (arrival))
    SELECT event_type, count(*) AS arrived, count(*) FILTER (WHERE NOT late) AS counted, count(*) FILTER (WHERE late) AS dropped
    FROM judged GROUP BY 1
    """,
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Rows that a daily count took and rows that it dropped, because their day was over by the watermark when they came."""
    late = F.when(F.col("event_id") % LATE_EVERY == 0, LATE_DAYS).otherwise(0)
    feed = arrivals.by_days(runs.event_time(t.events, "ts"), "ts", ARRIVAL_DAYS, late)

    def build(events: DataFrame) -> DataFrame:
        return windows.tumbling(events, "ts", "1 day", DELAY, ["event_type"], hits=F.count(F.lit(1)))

    result, _ = runs.run_to_close(feed.stream, "ts", build, feed)
    return windows.drops(t.events, result, ["event_type"], "hits")
