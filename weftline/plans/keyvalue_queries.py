"""Key-value patterns over the event log: counters, records, expiry, limits, recent items, presence, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money
from weftline.operators import keyvalue as kv, leaderboard, limiter
from weftline.operators.ordered import OrderedGroups
from weftline.plans.registry import query
from weftline.session import cut_lineage, scratch_path
from weftline.sources.command_log import commands
from weftline.sources.table_sets import TableSet
from weftline.sources.tables import Tables


@query(
    "kv_counter",
    """
    SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS hits,
           CAST(sum(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 THEN 10 ELSE -1 END) AS BIGINT) AS value
    FROM events GROUP BY 1, 2
    """,
)
def kv_counter(t: Tables) -> DataFrame:
    """One dated counter per event type: even payloads add ten, odd ones take one."""
    k = F.get_json_object("props", "$.k").cast("int")
    log = t.events.select("event_type", F.to_date("ts").alias("day"), F.when(k % 2 == 0, 10).otherwise(-1).alias("by"))
    return kv.counter(log, ["event_type", "day"], hits=F.lit(1), value=F.col("by"))


@query(
    "kv_latest",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
    """,
)
def kv_latest(t: Tables) -> DataFrame:
    return kv.latest(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])


COMMANDS_SQL = """
      log AS (SELECT 'user:' || user_id AS key, event_type AS field, json_extract_string(props, '$.k') AS value, ts, event_id AS seq,
                     CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN 'del'
                          WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 1 THEN 'incr' ELSE 'set' END AS op
              FROM events)"""


def record_log(t: Tables) -> DataFrame:
    """Events as record commands: the payload decides between set, del and incr of the field named by the event type."""
    k = F.get_json_object("props", "$.k")
    number = k.cast("int")
    op = F.when(number % 10 == 0, "del").when(number % 3 == 1, "incr").otherwise("set")
    return commands(
        t.events, F.concat(F.lit("user:"), "user_id"), op, F.col("ts"), F.col("event_id"), F.col("event_type"), k
    )


@query(
    "kv_hash_compact",
    f"""
    WITH {COMMANDS_SQL},
    settled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, field ORDER BY ts DESC, seq DESC) AS r
                               FROM log WHERE op <> 'incr') WHERE r = 1),
    bumps AS (SELECT l.key, l.field, sum(CAST(l.value AS BIGINT)) AS s FROM log l
              LEFT JOIN settled b ON b.key = l.key AND b.field = l.field
              WHERE l.op = 'incr' AND (b.key IS NULL OR (l.ts, l.seq) > (b.ts, b.seq)) GROUP BY 1, 2)
    SELECT key, field, value FROM (
      SELECT coalesce(b.key, u.key) AS key, coalesce(b.field, u.field) AS field,
             CASE WHEN u.s IS NOT NULL
                  THEN CAST(CAST(coalesce(CASE WHEN b.op = 'set' THEN b.value END, '0') AS BIGINT) + u.s AS VARCHAR)
                  WHEN b.op = 'set' THEN b.value END AS value
      FROM settled b FULL JOIN bumps u ON b.key = u.key AND b.field = u.field)
    WHERE value IS NOT NULL
    """,
)
def kv_hash_compact(t: Tables) -> DataFrame:
    return kv.record_fields(record_log(t))


@query(
    "ttl_valid_as_of",
    """
    WITH log AS (SELECT user_id, ts, event_id, value,
                        CASE event_type WHEN 'error' THEN 'del' WHEN 'view' THEN 'persist' ELSE 'set' END AS op,
                        CASE WHEN event_type <> 'signup' THEN 86400 END AS ttl
                 FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
                            FROM log WHERE op <> 'persist') WHERE r = 1 AND op = 'set'),
    state AS (SELECT w.*, EXISTS (SELECT 1 FROM log p WHERE p.user_id = w.user_id AND p.op = 'persist'
                                  AND (p.ts, p.event_id) > (w.ts, w.event_id)
                                  AND p.ts < w.ts + INTERVAL 1 DAY) OR ttl IS NULL AS endless FROM last w)
    SELECT 'session:' || user_id AS key, CAST(value AS VARCHAR) AS value,
           CASE WHEN endless THEN -1
                ELSE (epoch_us(ts) + 86400000000 - epoch_us(TIMESTAMP '2024-01-20 12:00:00')) // 1000000 END AS remaining_s
    FROM state WHERE endless OR ts + INTERVAL 1 DAY > TIMESTAMP '2024-01-20 12:00:00'
    """,
)
def ttl_valid_as_of(t: Tables) -> DataFrame:
    return kv.alive_as_of(session_log(t), F.lit("2024-01-20 12:00:00").cast("timestamp"))


def session_log(t: Tables) -> DataFrame:
    """Sessions that live a day; a signup lasts, a view makes the session permanent, an error ends it."""
    kind = F.col("event_type")
    return commands(
        t.events,
        F.concat(F.lit("session:"), "user_id"),
        F.when(kind == "error", "del").when(kind == "view", "persist").otherwise("set"),
        F.col("ts"),
        F.col("event_id"),
        value=F.col("value"),
        ttl_s=F.when(kind != "signup", 86400),
    )


MOMENTS = ("2024-01-02 06:00:00", "2024-01-20 12:00:00", "2024-03-01 00:00:00")


@query(
    "ttl_answers",
    f"""
    WITH log AS (SELECT 'session:' || user_id AS key, ts, event_id, value,
                        CASE event_type WHEN 'error' THEN 'del' WHEN 'view' THEN 'persist' ELSE 'set' END AS op,
                        event_type <> 'signup' AS ends FROM events),
    asked AS (SELECT 'session:' || c_custkey AS key, moment
              FROM customer, (SELECT unnest([{", ".join(f"TIMESTAMP '{m}'" for m in MOMENTS)}]) AS moment)),
    w AS (SELECT a.key, moment, ts, event_id, op, ends, value, row_number() OVER (PARTITION BY a.key, moment ORDER BY ts DESC, event_id DESC) AS r
          FROM asked a JOIN log l ON l.key = a.key AND ts <= moment AND op <> 'persist'),
    state AS (SELECT w.*, NOT ends OR EXISTS (SELECT 1 FROM log p WHERE p.key = w.key AND p.op = 'persist' AND p.ts <= w.moment
                          AND (p.ts, p.event_id) > (w.ts, w.event_id) AND p.ts < w.ts + INTERVAL 1 DAY) AS endless
              FROM w WHERE r = 1 AND op = 'set'),
    alive AS (SELECT * FROM state WHERE endless OR ts + INTERVAL 1 DAY > moment)
    SELECT key, moment, CAST(value AS VARCHAR) AS value,
           CASE WHEN s.ts IS NULL THEN -2 WHEN endless THEN -1 ELSE (epoch_us(ts) + 86400000000 - epoch_us(moment)) // 1000000 END AS ttl_s
    FROM asked LEFT JOIN alive s USING (key, moment)
    """,
)
def ttl_answers(t: Tables) -> DataFrame:
    """What every customer's session answers at several moments, also of customers that never had one."""
    key = F.concat(F.lit("session:"), "c_custkey").alias("key")
    moments = F.explode(F.array(*[F.lit(m).cast("timestamp_ntz") for m in MOMENTS])).alias("moment")
    return kv.ttl_answers(cut_lineage(kv.validity(session_log(t))), t.customer.select(key, moments), "moment")


@query(
    "kv_exists",
    "SELECT c_custkey, c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS found FROM customer",
)
def kv_exists(t: Tables) -> DataFrame:
    store = t.events.where("event_type = 'purchase'")
    return kv.exists(t.customer.select("c_custkey"), "c_custkey", store, "user_id")


@query(
    "rate_limit_fixed",
    """
    SELECT event_id, user_id, date_trunc('hour', ts) AS window_start,
           row_number() OVER w AS count, row_number() OVER w <= 1 AS allowed
    FROM events WINDOW w AS (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id)
    """,
)
def rate_limit_fixed(t: Tables) -> DataFrame:
    hits = t.events.select("event_id", "user_id", "ts")
    return kv.limit_per_window(hits, ["user_id"], "ts", "event_id", "1 hour", 1).drop("ts")


@query(
    "rate_limit_anchored",
    """
    WITH RECURSIVE hits AS (
      SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    fold AS (
      SELECT event_id, user_id, ts, n, ts AS window_start, CAST(1 AS BIGINT) AS count FROM hits WHERE n = 1
      UNION ALL
      SELECT h.event_id, h.user_id, h.ts, h.n,
             CASE WHEN h.ts >= f.window_start + INTERVAL 1 DAY THEN h.ts ELSE f.window_start END,
             CASE WHEN h.ts >= f.window_start + INTERVAL 1 DAY THEN 1 ELSE f.count + 1 END
      FROM fold f JOIN hits h ON h.user_id = f.user_id AND h.n = f.n + 1)
    SELECT event_id, user_id, window_start, count, count <= 2 AS allowed,
           CAST(ceil((epoch_us(window_start) + 86400000000 - epoch_us(ts)) / 1000000) AS BIGINT) AS ttl_s
    FROM fold
    """,
)
def rate_limit_anchored(t: Tables) -> DataFrame:
    """Two hits per user in the day that starts with the first hit."""
    hits = t.events.select("event_id", "user_id", "ts")
    return limiter.limit_from_first_hit(hits, "user_id", "ts", "event_id", 2, 86_400).drop("ts")


@query(
    "rate_limit_sliding",
    """
    SELECT event_id, user_id, count(*) OVER w AS count, count(*) OVER w <= 3 AS allowed
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
    """,
)
def rate_limit_sliding(t: Tables) -> DataFrame:
    hits = t.events.select("event_id", "user_id", "ts")
    return kv.limit_sliding(hits, ["user_id"], "ts", 86_400, 3).drop("ts")


@query(
    "recent_n",
    """
    SELECT user_id, event_id, r - 1 AS pos FROM (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r <= 5
    """,
)
def recent_n(t: Tables) -> DataFrame:
    return kv.recent(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 5).drop("ts")


@query(
    "queue_order",
    """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS fifo,
           row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1 AS lifo
    FROM events
    """,
)
def queue_order(t: Tables) -> DataFrame:
    return kv.queue_positions(t.events.select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "presence_set",
    """
    SELECT day, user_id FROM (
      SELECT CAST(ts AS DATE) AS day, user_id, event_type,
             row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events WHERE event_type IN ('signup', 'error'))
    WHERE r = 1 AND event_type = 'signup'
    """,
)
def presence_set(t: Tables) -> DataFrame:
    """Who is online at the end of each day: a signup adds the user, an error removes them."""
    log = t.events.select(F.to_date("ts").alias("day"), "user_id", "event_type", "ts", "event_id")
    kind = F.col("event_type")
    return kv.members(log, "day", "user_id", ["ts", "event_id"], kind == "signup", kind == "error")


@query(
    "first_writer",
    """
    SELECT user_id, day, event_id AS owner FROM (
      SELECT user_id, CAST(ts AS DATE) AS day, event_id,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS r FROM events) WHERE r = 1
    """,
)
def first_writer(t: Tables) -> DataFrame:
    log = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", F.col("event_id").alias("owner"))
    return kv.first_writer(log, ["user_id", "day"], ["ts", "event_id"], ["owner"])


@query(
    "first_writer_lease",
    """
    WITH RECURSIVE tries AS (
      SELECT user_id, event_id, ts, CASE event_type WHEN 'purchase' THEN 172800 WHEN 'view' THEN 21600 ELSE 86400 END AS s,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    fold AS (
      SELECT user_id, n, event_id AS owner, ts AS lease_start, ts + to_seconds(s) AS lease_end FROM tries WHERE n = 1
      UNION ALL
      SELECT t.user_id, t.n, CASE WHEN t.ts >= lease_end THEN t.event_id ELSE owner END,
             CASE WHEN t.ts >= lease_end THEN t.ts ELSE lease_start END, CASE WHEN t.ts >= lease_end THEN t.ts + to_seconds(s) ELSE lease_end END
      FROM fold f JOIN tries t ON t.user_id = f.user_id AND t.n = f.n + 1)
    SELECT user_id, owner, lease_start, lease_end, count(*) - 1 AS refused FROM fold GROUP BY ALL
    """,
)
def first_writer_lease(t: Tables) -> DataFrame:
    """A user's lock goes to the first who tries while it is free, for a time that depends on who it is."""
    kind = F.col("event_type")
    tries = t.events.select("user_id", "ts", "event_id", F.when(kind == "purchase", 172_800).when(kind == "view", 21_600).otherwise(86_400).alias("s"))
    held = limiter.leases(tries, ["user_id"], "ts", "event_id", F.col("s"))
    return held.select("user_id", F.col("event_id").alias("owner"), "lease_start", "lease_end", "refused")


@query(
    "events_time_range",
    """
    SELECT event_id, ts, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'
    """,
)
def events_time_range(t: Tables) -> DataFrame:
    low, high = [F.lit(s).cast("timestamp_ntz") for s in ("2024-01-10 06:00:00", "2024-01-12 18:00:00")]
    return t.events.where(F.col("ts").between(low, high)).select("event_id", "ts", "user_id").orderBy("ts", "event_id")


@query(
    "log_range",
    """
    SELECT epoch_us(ts) // 1000 || '-' || (row_number() OVER (PARTITION BY epoch_us(ts) // 1000 ORDER BY ts, event_id) - 1) AS entry_id,
           event_id, event_type
    FROM events
    """,
)
def log_range(t: Tables) -> DataFrame:
    """The whole log with stream-style entry ids: milliseconds, then the place within the millisecond."""
    rows = t.events.select("event_id", "event_type", "ts", F.expr("unix_millis(cast(ts as timestamp))").alias("ms"))
    numbered = OrderedGroups(rows, ["ms"], ["ts", "event_id"]).number("seq", start=0).df
    return numbered.orderBy("ms", "seq").select(F.concat_ws("-", "ms", "seq").alias("entry_id"), "event_id", "event_type")


@query(
    "stock_and_audit",
    """
    SELECT p_partkey AS sku, 10000 - coalesce(q, 0) AS stock, coalesce(n, 0) AS audit_rows
    FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q, count(*) AS n
                         FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
    """,
)
def stock_and_audit(t: Tables) -> DataFrame:
    """Stock and audit trail written as one commit; the batch is delivered twice and takes effect once."""
    sales = t.lineitem.select(F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("long").alias("quantity"))
    stock = t.part.select(F.col("p_partkey").alias("sku"), F.lit(10_000).cast("long").alias("stock"))
    both = TableSet(t.spark, scratch_path(t.spark, "stock"))
    for batch in ("day-1", "day-1"):
        after, audit = kv.stock_and_audit(sales, stock, "sku", "quantity")
        both.publish({"stock": after, "audit": audit.select("sku", "entry")}, batch)
    trail = both.read("audit").groupBy(F.col("sku").alias("__sku")).agg(F.count("entry").alias("__n"))
    joined = both.read("stock").join(trail, F.col("sku") == F.col("__sku"), "left")
    return joined.select("sku", "stock", F.coalesce("__n", F.lit(0)).alias("audit_rows"))


@query(
    "hourly_topk",
    """
    SELECT period, user_id, CAST(score AS DOUBLE) AS score, place FROM (
      SELECT *, row_number() OVER (PARTITION BY period ORDER BY score DESC, user_id) AS place FROM (
        SELECT date_trunc('hour', ts) AS period, user_id, sum(CAST(value AS DECIMAL(18,2))) AS score FROM events GROUP BY 1, 2))
    WHERE place <= 3
    """,
)
def hourly_topk(t: Tables) -> DataFrame:
    hour = F.window("ts", "1 hour")["start"]
    best = kv.top_per_period(t.events, hour, "user_id", F.sum(money("value")), 3)
    return best.select("period", "user_id", F.col("score").cast("double").alias("score"), "place")


# ---- leaderboards --------------------------------------------------------------------------------------------------

SCORES_SQL = "scores AS (SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS score FROM events GROUP BY user_id)"
RANKED_SQL = f"""
      {SCORES_SQL},
      ranked AS (SELECT user_id, score, row_number() OVER (ORDER BY score DESC, user_id DESC) - 1 AS rank_from_top,
                        row_number() OVER (ORDER BY score, user_id) - 1 AS rank_from_bottom FROM scores)"""


def board(t: Tables) -> DataFrame:
    return leaderboard.scores(t.events, "user_id", money("value"))


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.col("score").cast("double"))


@query(
    "leaderboard_top",
    f"WITH {SCORES_SQL} SELECT user_id, CAST(score AS DOUBLE) AS score, row_number() OVER (ORDER BY scores.score DESC, user_id DESC) - 1 AS rank FROM scores ORDER BY scores.score DESC, user_id DESC LIMIT 10",
)
def leaderboard_top(t: Tables) -> DataFrame:
    return shown(leaderboard.top(board(t), "user_id", 10))


@query(
    "leaderboard_bottom",
    f"WITH {SCORES_SQL} SELECT user_id, CAST(score AS DOUBLE) AS score, row_number() OVER (ORDER BY scores.score, user_id) - 1 AS rank FROM scores ORDER BY scores.score, user_id LIMIT 10",
)
def leaderboard_bottom(t: Tables) -> DataFrame:
    return shown(leaderboard.bottom(board(t), "user_id", 10))


@query(
    "leaderboard_score_range",
    f"WITH {SCORES_SQL} SELECT user_id, CAST(score AS DOUBLE) AS score FROM scores WHERE score BETWEEN 3000 AND 4000",
)
def leaderboard_score_range(t: Tables) -> DataFrame:
    return shown(leaderboard.score_range(board(t), 3000, 4000)).orderBy("score", "user_id")


@query(
    "leaderboard_rank",
    f"WITH {RANKED_SQL} SELECT user_id, CAST(score AS DOUBLE) AS score, rank_from_top, rank_from_bottom FROM ranked",
)
def leaderboard_rank(t: Tables) -> DataFrame:
    return shown(leaderboard.ranks(board(t), "user_id"))


@query(
    "leaderboard_lookup",
    f"""
    WITH {RANKED_SQL}
    SELECT user_id, CAST(score AS DOUBLE) AS score, rank_from_top FROM ranked
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def leaderboard_lookup(t: Tables) -> DataFrame:
    """Standing of the customers in debt; those who never played give no row."""
    wanted = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    found = leaderboard.lookup(leaderboard.ranks(board(t), "user_id"), wanted, "user_id")
    return shown(found).drop("rank_from_bottom")


@query(
    "leaderboard_around",
    f"""
    WITH {RANKED_SQL}
    SELECT c.user_id AS center, r.user_id, CAST(r.score AS DOUBLE) AS score, r.rank_from_top
    FROM ranked c JOIN ranked r ON r.rank_from_top BETWEEN c.rank_from_top - 2 AND c.rank_from_top + 2
    WHERE c.user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def leaderboard_around(t: Tables) -> DataFrame:
    wanted = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    near = leaderboard.around(leaderboard.ranks(board(t), "user_id"), wanted, "user_id", 2)
    return shown(near).select("center", "user_id", "score", "rank_from_top")


@query(
    "leaderboard_bump",
    """
    WITH bumped AS (SELECT user_id, sum(p) AS score FROM (
      SELECT user_id, CAST(value AS DECIMAL(18,2)) AS p FROM events
      UNION ALL SELECT user_id, 300 FROM events WHERE event_type = 'purchase') GROUP BY user_id)
    SELECT user_id, CAST(score AS DOUBLE) AS score, row_number() OVER (ORDER BY score DESC, user_id DESC) - 1 AS rank_from_top
    FROM bumped
    """,
)
def leaderboard_bump(t: Tables) -> DataFrame:
    """Every purchase is worth 300 more points; rank again."""
    bought = t.events.where("event_type = 'purchase'")
    deltas = leaderboard.scores(bought, "user_id", F.lit(300).cast("decimal(18,2)"))
    ranked = leaderboard.ranks(leaderboard.bump(board(t), deltas, "user_id"), "user_id")
    return shown(ranked).drop("rank_from_bottom")
