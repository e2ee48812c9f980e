import random

import pytest
from pyspark.sql import functions as F
from samples import at, bag, rows

from weftline.operators import keyvalue as kv, leaderboard, limiter
from weftline.sources.command_log import COMMAND_SCHEMA


def log(spark, *commands):
    """(key, op, field, value, seconds, ttl) in order of arrival."""
    return spark.createDataFrame(
        [(k, op, f, v, at(s), i, ttl) for i, (k, op, f, v, s, ttl) in enumerate(commands)], COMMAND_SCHEMA
    )


def test_counter(spark):
    hits = spark.createDataFrame([("page", 1)] * 3, "key string, by int")
    assert bag(kv.counter(hits, ["key"], value=F.col("by"))) == [("page", 3)]
    more = hits.unionByName(spark.createDataFrame([("page", 10)], "key string, by int"))
    assert bag(kv.counter(more, ["key"], value=F.col("by"))) == [("page", 13)]


def test_record(spark):
    commands = log(
        spark,
        ("boat:7", "set", "harbour", "Vardo", 0, None),
        ("boat:7", "set", "flag", "blue", 0, None),
        ("boat:7", "set", "crew", "4", 0, None),
        ("boat:7", "set", "crew", "6", 1, None),
        ("boat:7", "incr", "trips", "1", 2, None),
        ("boat:7", "incr", "trips", "3", 3, None),
        ("boat:7", "del", "flag", None, 4, None),
    )
    assert bag(kv.record_fields(commands), "field", "value") == [("crew", "6"), ("harbour", "Vardo"), ("trips", "4")]


def test_increments_start_again_after_set_and_del(spark):
    commands = log(
        spark,
        ("k", "incr", "a", "5", 0, None),
        ("k", "set", "a", "10", 1, None),
        ("k", "incr", "a", "1", 1, None),
        ("k", "incr", "b", "5", 0, None),
        ("k", "del", "b", None, 1, None),
        ("k", "incr", "b", "2", 2, None),
        ("k", "incr", "c", "1", 2, None),
        ("k", "del", "c", None, 3, None),
    )
    assert bag(kv.record_fields(commands), "field", "value") == [("a", "11"), ("b", "2")]


def test_expiry(spark):
    commands = log(
        spark,
        ("none", "set", None, "v", 0, None),
        ("short", "set", None, "v", 0, 10),
        ("edge", "set", None, "v", 0, 60),
        ("long", "set", None, "v", 0, 100),
        ("kept", "set", None, "v", 0, 10),
        ("kept", "persist", None, None, 9, None),
        ("late", "set", None, "v", 0, 10),
        ("late", "persist", None, None, 10, None),
        ("gone", "set", None, "v", 0, None),
        ("gone", "del", None, None, 5, None),
        ("renewed", "set", None, "v", 0, 10),
        ("renewed", "set", None, "w", 50, 20),
        ("future", "set", None, "v", 70, None),
        ("reset", "persist", None, None, 1, None),
        ("reset", "set", None, "v", 2, 5),
    )
    alive = kv.alive_as_of(commands, F.lit(at(60)))
    assert bag(alive) == [("kept", "v", -1), ("long", "v", 40), ("none", "v", -1), ("renewed", "w", 10)]


def test_first_writer_and_latest(spark):
    locks = spark.createDataFrame([("l", "w2", 5, 2), ("l", "w1", 5, 1), ("l", "w3", 9, 3)], "k string, w string, ts int, seq int")
    assert bag(kv.first_writer(locks, ["k"], ["ts", "seq"], ["w"])) == [("l", "w1")]
    assert bag(kv.latest(locks, ["k"], ["ts", "seq"], ["w"])) == [("l", "w3")]


def test_exists(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "k string")
    store = spark.createDataFrame([("a",), ("a",)], "key string")
    assert bag(kv.exists(wanted, "k", store, "key")) == [("a", True), ("b", False)]


def test_recent_and_queue(spark):
    news = spark.createDataFrame([("n", f"H{i}", i) for i in range(1, 8)], "k string, h string, seq int")
    assert rows(kv.recent(news, ["k"], ["seq"], 5).orderBy("pos"), "h") == [("H7",), ("H6",), ("H5",), ("H4",), ("H3",)]
    jobs = spark.createDataFrame(
        [("q", "saw", 1), ("q", "sand", 2), ("q", "paint", 3)], "q string, job string, seq int"
    )
    placed = kv.queue_positions(jobs, ["q"], ["seq"])
    assert rows(placed.orderBy("fifo"), "job") == [("saw",), ("sand",), ("paint",)]
    assert rows(placed.orderBy("lifo"), "job")[0] == ("paint",)


def test_presence(spark):
    actions = [("owl", "+"), ("fox", "+"), ("elk", "+"), ("owl", "+")]
    frame = spark.createDataFrame([("on", u, a, i) for i, (u, a) in enumerate(actions)], "s string, u string, a string, seq int")
    adds, removes = F.col("a") == "+", F.col("a") == "-"
    assert kv.members(frame, "s", "u", ["seq"], adds, removes).count() == 3
    left = frame.unionByName(spark.createDataFrame([("on", "fox", "-", 9)], frame.schema))
    assert bag(kv.members(left, "s", "u", ["seq"], adds, removes), "u") == [("elk",), ("owl",)]


def test_stock_and_audit(spark):
    stock = spark.createDataFrame([("plank", 12), ("bolt", 4)], "sku string, stock long")
    after, audit = kv.stock_and_audit(spark.createDataFrame([("plank", 3)], "sku string, q long"), stock, "sku", "q")
    assert bag(after) == [("bolt", 4), ("plank", 9)]
    assert rows(audit, "entry") == [('{"type":"sale","sku":"plank"}',)]


# ---- rate limits ---------------------------------------------------------------------------------------------------


def hits(spark, *seconds):
    return spark.createDataFrame([("ip", at(s), i) for i, s in enumerate(seconds)], "who string, ts timestamp, id long")


def test_limit_within_one_window(spark):
    done = limiter.limit_from_first_hit(hits(spark, 0, 1, 2, 3, 4), "who", "ts", "id", 3, 10).orderBy("id")
    assert rows(done, "count", "allowed") == [(1, True), (2, True), (3, True), (4, False), (5, False)]
    assert rows(done, "ttl_s") == [(10,), (9,), (8,), (7,), (6,)]


def test_window_ends_at_its_length(spark):
    done = limiter.limit_from_first_hit(hits(spark, 0, 9.9, 10, 19.9, 20), "who", "ts", "id", 3, 10).orderBy("id")
    assert rows(done, "count") == [(1,), (2,), (1,), (2,), (1,)]


def test_refused_hits_keep_counting(spark):
    done = limiter.limit_from_first_hit(hits(spark, *range(12)), "who", "ts", "id", 1, 100).orderBy("id")
    assert rows(done, "count")[-1] == (12,)


def brute_force(table, width):
    out, open_window = {}, {}
    for key, t, i in sorted(table, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in open_window or t >= open_window[key][0] + width:
            open_window[key] = [t, 0]
        open_window[key][1] += 1
        out[i] = tuple(open_window[key])
    return out


@pytest.mark.parametrize("width", [3, 50, 100_000])
@pytest.mark.parametrize("limit", [None, 60])
def test_limiter_against_brute_force(spark, width, limit):
    """Bursts with equal moments, quiet times, a hot key and hits without a key."""
    rng = random.Random(width)
    table, now = [], 0
    for i in range(1500):
        now += rng.choice([0, 0, 0, 1, 1, 2, 30]) if i % 400 else 5000
        table.append((rng.choice(["hot"] * 5 + [None] * 2 + ["b", "c"]), now, i))
    frame = spark.createDataFrame([(k, at(t), i) for k, t, i in table], "k string, ts timestamp, id long").repartition(4)
    done = limiter.limit_from_first_hit(frame, "k", "ts", "id", 2, width, limit)
    got = done.select("id", F.unix_timestamp("window_start") - F.unix_timestamp(F.lit(at(0))), "count").collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute_force(table, width)


def test_fixed_and_sliding(spark):
    frame = hits(spark, 1, 59, 61, 62, 119, 121)
    fixed = kv.limit_per_window(frame, ["who"], "ts", "id", "1 minute", 2).orderBy("id")
    assert rows(fixed, "count", "allowed") == [(1, True), (2, True), (1, True), (2, True), (3, False), (1, True)]
    sliding = kv.limit_sliding(frame, ["who"], "ts", 60, 2).orderBy("id")
    assert rows(sliding, "count") == [(1,), (2,), (3,), (3,), (4,), (4,)]


# ---- leaderboards --------------------------------------------------------------------------------------------------


def test_board(data):
    five = data.scores.limit(5)
    assert rows(leaderboard.top(five, "player", 3), "player") == [("carol",), ("eve",), ("alice",)]
    assert rows(leaderboard.bottom(five, "player", 3), "player") == [("bob",), ("dan",), ("alice",)]
    assert bag(leaderboard.score_range(five, 1000, 1800), "player") == [("alice",), ("dan",)]
    ranked = leaderboard.ranks(five, "player")
    assert rows(ranked.where("player = 'alice'"), "rank_from_bottom", "rank_from_top") == [(2, 2)]


def test_bump_lookup_around(data, spark):
    deltas = spark.createDataFrame([("dan", 500.0), ("new", 1.0)], data.scores.schema)
    board = leaderboard.bump(data.scores, deltas, "player")
    ranked = leaderboard.ranks(board, "player")
    wanted = spark.createDataFrame([("dan",), ("nobody",)], "player string")
    assert rows(leaderboard.lookup(ranked, wanted, "player"), "score", "rank_from_top") == [(1700.0, 2)]
    near = leaderboard.around(ranked, wanted, "player", 1).orderBy("rank_from_top")
    assert rows(near, "rank_from_top", "player") == [(1, "eve"), (2, "dan"), (3, "frank")]
    best = spark.createDataFrame([("carol",)], "player string")
    assert rows(leaderboard.around(ranked, best, "player", 1).orderBy("rank_from_top"), "player") == [("carol",), ("eve",)]
    assert bag(board.where("player = 'new'"), "score") == [(1.0,)]


def test_ties_follow_the_member(spark):
    board = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.0)], "m string, score double")
    assert rows(leaderboard.top(board, "m", 3), "m") == [("b",), ("a",), ("c",)]
    ranked = leaderboard.ranks(board, "m").orderBy("rank_from_top")
    assert rows(ranked, "m", "rank_from_bottom") == [("b", 2), ("a", 1), ("c", 0)]


@pytest.mark.parametrize("limit", [None, 10])
def test_many_boards(spark, limit):
    frame = spark.range(200).select(
        (F.col("id") % 3).alias("b"), F.concat(F.lit("m"), "id").alias("m"), (F.col("id") * 7 % 11).alias("score")
    )
    ranked = leaderboard.ranks(frame, "m", ["b"], limit)
    table = [tuple(r) for r in frame.collect()]
    for b, m, score, top, bottom in rows(ranked, "b", "m", "score", "rank_from_top", "rank_from_bottom"):
        others = [(s, n) for c, n, s in table if c == b]
        assert top == sum(o > (score, m) for o in others) and bottom == sum(o < (score, m) for o in others)
