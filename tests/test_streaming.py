import random

import pytest
from pyspark.sql import functions as F
from samples import at, bag

from weftline.operators import limiter
from weftline.operators.keyvalue import latest
from weftline.operators.ordered import sessionize
from weftline.operators.views import BucketedAggregate, BucketedLatest, IncrementalAggregate, LatestTable
from weftline.sources.command_log import COMMAND_SCHEMA, command_stream
from weftline.sources.snapshots import Snapshots
from weftline.session import scratch_path
from weftline.streaming import arrivals, first_seen, runs, windows
from weftline.streaming.limiter import limit_stream

SCHEMA = "id long, who string, ts timestamp, v long"


@pytest.fixture(scope="module")
def table():
    rng = random.Random(5)
    now, out = 0, []
    for i in range(400):
        now += rng.choice([0, 5, 20, 40, 300])
        out.append((i, rng.choice(["hot"] * 4 + ["a", "b", None]), at(now), rng.randrange(10)))
    return out


def files(spark, folder, *parts):
    """One parquet file per part, to be read one per micro-batch in this order."""
    import os

    for n, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        for name in folder.iterdir():  # the source orders files by modification time
            if name.suffix == ".parquet" and not name.name.startswith("done"):
                os.utime(name, (1_000_000 + n, 1_000_000 + n))
                name.rename(folder / f"done-{n}.parquet")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")


def in_batches(spark, folder, table, n=5):
    size = -(-len(table) // n)
    return files(spark, folder, *[table[i : i + size] for i in range(0, len(table), size)])


def test_tumbling_counts_over_batches(spark, tmp_path, table):
    whole = spark.createDataFrame(table, SCHEMA)
    values = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    want = windows.tumbling(whole, "ts", "1 minute", "0 seconds", ["who"], **values)
    stream = in_batches(spark, tmp_path, table)
    got, progress = runs.run_to_close(stream, "ts", lambda e: windows.tumbling(e, "ts", "1 minute", "0 seconds", ["who"], **values))
    assert bag(got) == bag(want)
    assert runs.dropped_rows(progress) == 0 and len([p for p in progress if p["numInputRows"]]) >= 5


def test_sliding_counts_over_batches(spark, tmp_path, table):
    def build(events):
        return windows.sliding(events, "ts", "4 minutes", "1 minute", "1 minute", ["who"], n=F.count(F.lit(1)))

    got = runs.run_updates(build(in_batches(spark, tmp_path, table)), ["window_start", "who"])
    assert bag(got) == bag(build(spark.createDataFrame(table, SCHEMA)))


def test_sessions_over_batches(spark, tmp_path, table):
    known = [r for r in table if r[1]]

    def build(events):
        return windows.sessions(events, "ts", "2 minutes", "0 seconds", ["who"], n=F.count(F.lit(1)))

    got, _ = runs.run_to_close(in_batches(spark, tmp_path, known), "ts", build)
    numbered = sessionize(spark.createDataFrame(known, SCHEMA), ["who"], "ts", "id", F.expr("INTERVAL 2 MINUTES"))
    want = numbered.groupBy("who", "session_no").agg(
        F.min("ts").alias("a"), (F.max("ts") + F.expr("INTERVAL 2 MINUTES")).alias("b"), F.count("*").alias("n")
    )
    assert bag(got) == bag(want.drop("session_no"))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    first = [(1, "a", at(0), 1), (2, "a", at(600), 1)]
    second = [(3, "a", at(601), 1)]
    late = [(4, "a", at(5), 1), (5, "a", at(602), 1)]
    stream = files(spark, tmp_path, first, second, late)

    def build(events):
        return windows.tumbling(events, "ts", "1 minute", "1 minute", ["who"], n=F.count(F.lit(1)))

    got, progress = runs.run_to_close(stream, "ts", build)
    assert bag(got) == bag(build(spark.createDataFrame(first + second + late[1:], SCHEMA)))
    assert runs.dropped_rows(progress) == 1


def test_rows_within_the_delay_still_count(spark, tmp_path):
    stream = files(spark, tmp_path, [(1, "a", at(0), 1), (2, "a", at(100), 1)], [(3, "a", at(50), 1)])
    got, progress = runs.run_to_close(
        stream, "ts", lambda e: windows.tumbling(e, "ts", "1 minute", "5 minutes", ["who"], n=F.count(F.lit(1)))
    )
    assert sorted(r.n for r in got.collect()) == [1, 2] and runs.dropped_rows(progress) == 0


def test_first_seen_forgets_after_the_delay(spark, tmp_path):
    parts = [
        [(1, "a", at(0), 1), (2, "a", at(1), 1)],
        [(3, "a", at(5), 1)],
        [(4, "b", at(1000), 1)],
        [(5, "b", at(1001), 1)],  # forgets "a", whose time is over since the batch before
        [(6, "a", at(1002), 1)],
    ]
    (tmp_path / "in").mkdir()
    first = windows.first_seen(files(spark, tmp_path / "in", *parts), "ts", "1 minute", ["who"])
    runs.append_to(first.select("who", "ts"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = bag(spark.read.parquet(str(tmp_path / "out")).groupBy("who").count())
    assert got == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("width", [60, 900])
def test_limiter_stream_equals_batch(spark, tmp_path, table, width):
    (tmp_path / "in").mkdir()
    stream = limit_stream(in_batches(spark, tmp_path / "in", table), "who", "ts", "id", 2, width, "10 minutes")
    runs.append_to(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = spark.read.parquet(str(tmp_path / "out"))
    whole = spark.createDataFrame(table, SCHEMA)
    want = limiter.limit_from_first_hit(whole, "who", "ts", "id", 2, width)
    columns = ["id", "who", F.col("window_start").cast("timestamp").alias("w"), "count", "allowed"]
    assert bag(got.select(*columns)) == bag(want.select(*columns))


def test_limiter_stream_keeps_null_and_empty_keys_apart(spark):
    rows = [(1, None, at(0), 1), (2, "", at(1), 1), (3, None, at(2), 1), (4, "none", at(3), 1), (5, "a", None, 1), (6, "", at(4), 1)]
    feed = arrivals.in_pieces(spark.createDataFrame(rows, SCHEMA), "ts", 1, F.lit(0))
    folder = scratch_path(spark, "limits")
    runs.append_to(limit_stream(feed.stream, "who", "ts", "id", 1, 60, "10 minutes"), f"{folder}/out", f"{folder}/checkpoint", feed)
    got = {r.id: (r.who, r["count"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {1: (None, 1), 2: ("", 1), 3: (None, 2), 4: ("none", 1), 6: ("", 2)}


def test_latest_and_totals_over_batches_and_replays(spark, tmp_path, table):
    (tmp_path / "in").mkdir()
    stream = in_batches(spark, tmp_path / "in", table)
    newest = LatestTable(Snapshots(spark, str(tmp_path / "latest")), ["who"], ["ts", "id"], compact_after=2)
    totals = IncrementalAggregate(Snapshots(spark, str(tmp_path / "totals")), ["who"], {"s": "v"}, "n", compact_after=2)

    newest_parted = BucketedLatest(spark, str(tmp_path / "latest-parted"), ["who"], ["ts", "id"], 3)
    totals_parted = BucketedAggregate(spark, str(tmp_path / "totals-parted"), ["who"], {"s": "v"}, "n", 3)

    def merge(rows, batch):
        newest.merge(rows, f"batch-{batch}")
        totals.merge(rows, f"batch-{batch}")
        newest_parted.merge(rows, batch)
        totals_parted.merge(rows, batch)

    runs.run_merging(stream, merge, str(tmp_path / "first"))
    runs.run_merging(stream, merge, str(tmp_path / "again"))  # every batch is delivered a second time
    whole = spark.createDataFrame(table, SCHEMA)
    assert bag(newest.read(), "who", "id") == bag(latest(whole, ["who"], ["ts", "id"], ["id"]))
    assert bag(totals.read()) == bag(whole.groupBy("who").agg(F.sum("v").alias("s"), F.count("*").alias("n")))
    assert bag(newest_parted.read(), "who", "id") == bag(newest.read(), "who", "id")
    assert bag(totals_parted.read()) == bag(totals.read())


def test_command_files_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"key":"k","op":"set","value":"1","ts":"2025-01-01T00:00:00Z","seq":1}\n'
        '{"key":"k","op":"incr","value":"2","ts":"2025-01-01T00:00:01Z","seq":2,"ttl_s":5}\n'
    )
    runs.append_to(command_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert [f.name for f in got.schema] == [f.name for f in COMMAND_SCHEMA]
    assert bag(got, "op", "seq", "ttl_s") == [("incr", 2, 5), ("set", 1, None)]


def test_arrivals_are_micro_batches(spark, table):
    """Every arrival is seen by a run of its own, whatever its number of files; rows come in the order of their arrival."""
    whole = spark.createDataFrame(table, SCHEMA).repartition(3)
    feed = arrivals.in_pieces(whole, "ts", 4, F.when(F.col("id") % 5 == 0, 900).otherwise(0))
    seen = []
    runs.run_merging(feed.stream, lambda rows, _: seen.append([(r.id, r.ts) for r in rows.collect()]), scratch_path(spark, "seen"), feed)
    parts = [p for p in seen if p]
    assert len(parts) >= 4 and sorted(i for p in parts for i, _ in p) == [r[0] for r in table]
    assert any(max(t for _, t in a) > min(t for _, t in b) for a, b in zip(parts, parts[1:]))
    on_time = [[t for i, t in p if i % 5] for p in parts]
    assert all(max(a) < min(b) for a, b in zip(on_time, on_time[1:]) if a and b)
    empty = arrivals.in_pieces(whole.where("id < 0"), "ts", 4, F.lit(0))
    assert list(empty) == []


def test_drops_are_rows_behind_the_watermark(spark, table):
    """What the windows counted and what arrived differ by the rows that the engine refused."""
    rows = [(i, "a", at(86_400 * (i // 10)), 1) for i in range(200)]
    feed = arrivals.by_days(spark.createDataFrame(rows, SCHEMA), "ts", 4, F.when(F.col("id") % 10 == 3, 9).otherwise(0))
    result, progress = runs.run_to_close(feed.stream, "ts", lambda e: windows.tumbling(e, "ts", "1 day", "1 hour", ["who"], n=F.count(F.lit(1))), feed)
    came = {}
    for i, _, _, _ in rows:
        came.setdefault((i // 10 + (9 if i % 10 == 3 else 0)) // 4, []).append(i // 10)
    late, mark = 0, -1.0
    for _, days in sorted(came.items()):
        late += sum(d + 1 <= mark for d in days)
        mark = max(mark, max(days) - 1 / 24)
    got = windows.drops(spark.createDataFrame(rows, SCHEMA), result, ["who"], "n").collect()
    assert [tuple(r) for r in got] == [("a", 200, 200 - late, late)]
    assert late > 0 and runs.dropped_rows(progress) > 0


def test_first_within_a_time_to_live(spark):
    """By event time whatever order rows come in; a key that was not first for a while is first again, by several batches."""
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "b", None]), at(rng.randrange(4_000)), 1) for i in range(120)] + [(500, "a", None, 1)]
    whole = spark.createDataFrame(rows, SCHEMA)
    feed = arrivals.in_pieces(whole, "ts", 3, F.when(F.col("id") % 3 == 0, 100).otherwise(0))
    with first_seen.timers(spark):
        got, _ = runs.run_to_close(feed.stream, "ts", lambda e: first_seen.first_within(e, "ts", "id", ["who"], 600, "200 seconds"), feed)
    want, seen = [], {}
    for i, who, ts, _ in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[0])):
        if who not in seen or (ts - seen[who]).total_seconds() >= 600:
            seen[who] = ts
            want.append((who, i))
    assert bag(got, "who", "id") == sorted(want, key=repr) and len(want) > 10


def many_keys(spark):
    rng = random.Random(8)
    rows = [(2**60 + i if i % 50 else None, rng.choice([None, "", "none", *map(str, range(60))]), at(rng.randrange(4_000)), 1) for i in range(1_500)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_first_within_shares_a_state_among_keys(spark):
    rows, whole = many_keys(spark)
    feed = arrivals.in_pieces(whole, "ts", 3, F.when(F.col("id") % 3 == 0, 100).otherwise(0))
    with first_seen.timers(spark):
        got, progress = runs.run_to_close(feed.stream, "ts", lambda e: first_seen.first_within(e, "ts", "id", ["who"], 600, "200 seconds", buckets=4), feed)
    want, seen = [], {}
    for i, who, ts, _ in sorted(rows, key=lambda r: (r[2], r[0] is None, r[0])):
        if who not in seen or (ts - seen[who]).total_seconds() >= 600:
            seen[who] = ts
            want.append((who, i))
    assert bag(got, "who", "id") == sorted(want, key=repr) and len(want) > 200
    assert 0 < max(op["numRowsUpdated"] for p in progress for op in p["stateOperators"]) < 63


def test_limiter_stream_shares_a_state_among_keys(spark):
    rows, whole = many_keys(spark)
    feed, folder = arrivals.in_pieces(whole, "ts", 3, F.lit(0)), scratch_path(spark, "shared")
    limited = limit_stream(feed.stream, "who", "ts", "id", 2, 600, "10 minutes", buckets=4)
    progress = runs.append_to(limited, f"{folder}/out", f"{folder}/checkpoint", feed)
    want, opened = [], {}
    for i, who, ts, _ in sorted(rows, key=lambda r: (r[2], r[0] is None, r[0])):
        start, count = opened.get(who, (None, 0))
        opened[who] = (ts, 1) if start is None or (ts - start).total_seconds() >= 600 else (start, count + 1)
        want.append((i, who, opened[who][1], opened[who][1] <= 2))
    assert bag(spark.read.parquet(f"{folder}/out"), "id", "who", "count", "allowed") == sorted(want, key=repr)
    assert 0 < max(op["numRowsTotal"] for p in progress for op in p["stateOperators"]) <= 4
