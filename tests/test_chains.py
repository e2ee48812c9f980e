import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import at

from weftline.operators import chains, keyvalue as kv, limiter
from weftline.sources.command_log import COMMAND_SCHEMA


def brute(table):
    """(key, at, id, until) -> id: (place, place of the accepted row, its time)."""
    out, state = {}, {}
    for key, t, i, until in sorted(table, key=lambda r: (str(r[0]), r[1], r[2])):
        place, open_row = state.get(key, (0, None))
        place += 1
        if open_row is None or t >= open_row[2]:
            open_row = (place, t, until)
        state[key] = place, open_row
        out[i] = (place, open_row[0], open_row[1])
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [None, 40])
def test_chains_of_any_length(spark, seed, limit):
    """Ends that lie before their start, ties, endless rows, quiet times; folded and by pointer doubling."""
    rng = random.Random(seed)
    table, now = [], 0
    for i in range(900):
        now += rng.choice([0, 0, 1, 1, 2, 40])
        length = rng.choice([0, -3, 1, 2, 5, 100, 100_000 if seed == 1 else 3])
        table.append((rng.choice(["hot"] * 6 + [None, "b"]), now, i, now + length))
    rng.shuffle(table)
    frame = spark.createDataFrame(table, "k string, t long, id long, until long").repartition(3)
    done = chains.chain(frame, ["k"], "t", "id", "until", limit).collect()
    assert {r.id: (r[chains.PLACE], r[chains.FIRST], r[chains.START]) for r in done} == brute(table)


def test_spans_over_batches():
    rng = np.random.default_rng(3)
    for _ in range(200):
        t = np.cumsum(rng.integers(0, 4, 30))
        until = t + rng.integers(-2, 12, 30)
        want = brute([("k", int(a), i, int(b)) for i, (a, b) in enumerate(zip(t, until))])
        cut = int(rng.integers(1, 29))
        first = chains.spans(t[:cut], until[:cut], None, None)
        second = chains.spans(t[cut:], until[cut:], int(until[:cut].max()), int(until[first[-1]]))
        got = [*first, *[x + cut if x >= 0 else first[-1] for x in second]]
        assert [x + 1 for x in got] == [want[i][1] for i in range(30)]


def test_hot_key_with_a_window_wider_than_many_slices(spark):
    """20,000 hits of one key; a window covers more than ten slices."""
    frame = spark.range(0, 20_000, 1, 8).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("ts"), "id")
    done = limiter.limit_from_first_hit(frame, "k", "ts", "id", 3, 3_000, group_limit=500)
    got = done.select("id", F.unix_timestamp("window_start").alias("w"), "count", "allowed").collect()
    assert len(got) == 20_000
    assert all(r.w == r.id // 3_000 * 3_000 and r["count"] == r.id % 3_000 + 1 and r.allowed == (r.id % 3_000 < 3) for r in got)
    marks = chains.marked(frame.select(F.lit("hot").alias("__g"), F.col("id").alias("at"), (F.col("id") + 3_000).alias("until"), (F.col("id") + 1).alias("__n")), 500)
    assert sorted(r["__n"] for r in marks.collect()) == [1 + 3_000 * k for k in range(7)]


@pytest.mark.parametrize("limit", [None, 20])
def test_leases(spark, limit):
    rng = random.Random(9)
    table = [(rng.choice("aab"), rng.randrange(400), i, rng.choice([5, 30, 200, None if i > 150 else 1])) for i in range(200)]
    frame = spark.createDataFrame([(k, at(t), i, s) for k, t, i, s in table] + [("a", None, 999, 5)], "k string, ts timestamp, id long, s int")
    want, state = {}, {}
    for k, t, i, s in sorted(table, key=lambda r: (r[0], r[1], r[2])):
        if k in state and (want[state[k]][2] is None or t < want[state[k]][2]):
            want[state[k]][3] += 1
        else:
            state[k] = i
            want[i] = [k, t, None if s is None else t + s, 0]
    start = F.unix_timestamp(F.lit(at(0)))
    held = limiter.leases(frame, ["k"], "ts", "id", F.col("s"), limit)
    got = held.select("id", "k", F.unix_timestamp("lease_start") - start, F.unix_timestamp("lease_end") - start, "refused").collect()
    assert {r[0]: list(r[1:]) for r in got} == want


@pytest.mark.parametrize("limit", [None, 12])
def test_answers_at_any_moment(spark, limit):
    """Against a store that runs the commands one by one: expiry, renewal, deletion, persisting in time and too late."""
    rng = random.Random(limit or 1)
    commands = [(rng.choice("aab"), rng.choice(["set", "set", "del", "persist"]), None, str(i), rng.randrange(60), rng.choice([None, 1, 5, 20])) for i in range(120)]
    log = spark.createDataFrame([(k, op, f, v, at(s), i, ttl) for i, (k, op, f, v, s, ttl) in enumerate(commands)], COMMAND_SCHEMA)

    def answer(key, moment):
        value, ends = None, None
        for k, op, _, v, s, ttl in [c for _, c in sorted(enumerate(commands), key=lambda x: (x[1][4], x[0]))]:
            if k != key or s > moment:
                continue
            if value is not None and ends is not None and s >= ends:
                value = None
            if op == "set":
                value, ends = v, None if ttl is None else s + ttl
            elif op == "del":
                value = None
            elif value is not None:
                ends = None
        if value is None or (ends is not None and moment >= ends):
            return (None, -2)
        return (value, -1 if ends is None else ends - moment)

    asked = [(k, m) for k in ("a", "b", "never") for m in range(-1, 90, 3)]
    wanted = spark.createDataFrame([(k, at(m)) for k, m in asked], "key string, m timestamp")
    got = kv.ttl_answers(kv.validity(log, limit), wanted, "m", limit).select("key", F.unix_timestamp("m") - F.unix_timestamp(F.lit(at(0))), "value", "ttl_s").collect()
    assert {(r[0], r[1]): (r[2], r[3]) for r in got} == {(k, m): answer(k, m) for k, m in asked}
    assert {r.ttl_s for r in got} >= {-1, -2}
