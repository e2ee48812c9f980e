"""Key-value patterns over logs: counters, latest values, records, expiry, limits, recent items, presence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.scalars import epoch_micros
from weftline.operators.ordered import OrderedGroups, join_same, range_totals, top_per_group
from weftline.plans.slicing import By, sort_columns

SECOND = 1_000_000


def counter(log: DataFrame, keys: Sequence[str | Column], **deltas: Column) -> DataFrame:
    """Sums of the deltas per key, one output column each; a key that never occurs is not listed and counts as 0."""
    return log.groupBy(*keys).agg(*[F.sum(delta).alias(out) for out, delta in deltas.items()])


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last write per key, by the greatest ``order`` values."""
    return _pick(F.max_by, log, keys, order, columns)


def first_writer(log: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first write per key; later ones are refused."""
    return _pick(F.min_by, log, keys, order, columns)


def _pick(by, log: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    chosen = by(F.struct(*columns), F.struct(*order)).alias("__row")
    return log.groupBy(*keys).agg(chosen).select(*keys, *[f"__row.{c}" for c in columns])


def record_fields(log: DataFrame) -> DataFrame:
    """Current fields of each record as (key, field, value), from a command log with set, del and incr.

    The last set or del of a field fixes its base (0 after a del or without either); later increments add to it. A field
    whose last word is del is gone. The result stays tall: a record may have any number of fields.
    """
    at = F.struct("ts", "seq")
    settled = log.where(F.col("op").isin("set", "del")).groupBy("key", "field").agg(
        F.max(at).alias("__at"), F.max_by(F.struct("op", "value"), at).alias("__base")
    )
    bumps = log.where("op = 'incr'").select("key", "field", at.alias("__when"), F.col("value").cast("long").alias("__by"))
    after = join_same(bumps, settled.select("key", "field", "__at"), ["key", "field"], "left")
    added = after.where(F.col("__at").isNull() | (F.col("__when") > F.col("__at"))).groupBy("key", "field").agg(
        F.sum("__by").alias("__sum")
    )
    both = settled.select("key", "field", "__base").join(
        added.withColumnsRenamed({"key": "__key", "field": "__field"}),
        F.col("key").eqNullSafe(F.col("__key")) & F.col("field").eqNullSafe(F.col("__field")),
        "full",
    )
    base = F.when(F.col("__base.op") == "set", F.col("__base.value"))
    grown = (F.coalesce(base.cast("long"), F.lit(0)) + F.col("__sum")).cast("string")
    return both.select(
        F.coalesce("key", "__key").alias("key"),
        F.coalesce("field", "__field").alias("field"),
        F.when(F.col("__sum").isNotNull(), grown).otherwise(base).alias("value"),
    ).where(F.col("value").isNotNull())


def alive_as_of(log: DataFrame, as_of: Column) -> DataFrame:
    """Keys alive at a moment with (key, value, remaining_s); ``remaining_s`` is -1 for a key without expiry.

    The log holds set (with or without ``ttl_s``), del and persist. A persist that comes while the key is alive removes
    its expiry. A key lives while ``ts + ttl_s`` lies after ``as_of``.
    """
    seen = log.where(F.col("ts") <= as_of)
    at = F.struct("ts", "seq")
    writes = seen.where(F.col("op").isin("set", "del")).groupBy("key").agg(
        F.max(at).alias("__at"), F.max_by(F.struct("op", "value", "ts", "ttl_s"), at).alias("w")
    )
    live = writes.where("w.op = 'set'")
    ends = epoch_micros("w.ts") + F.col("w.ttl_s") * SECOND
    kept = seen.where("op = 'persist'").select("key", at.alias("__when"))
    held = join_same(kept, live.select("key", "__at", ends.alias("__ends")), ["key"])
    held = held.where((F.col("__when") > F.col("__at")) & (epoch_micros("__when.ts") < F.col("__ends")))
    state = join_same(live, held.select("key").distinct().withColumn("__kept", F.lit(True)), ["key"], "left")
    endless = F.col("w.ttl_s").isNull() | F.coalesce("__kept", F.lit(False))
    left = F.call_function("div", ends - epoch_micros(as_of), F.lit(SECOND))
    alive = state.where(endless | (ends > epoch_micros(as_of)))
    return alive.select("key", F.col("w.value").alias("value"), F.when(endless, F.lit(-1)).otherwise(left).alias("remaining_s"))


def validity(log: DataFrame, limit: int | None = None) -> DataFrame:
    """The command log folded into intervals: (key, since, until, value, expires), times in microseconds.

    From ``since`` on and before ``until`` the key holds ``value``; ``until`` is null for the last one. ``expires`` is the end of its life as
    known in the interval, null without expiry: a set with ``ttl_s`` that is persisted while alive gives two intervals. A key that was
    deleted or has expired is in none. Commands of one key count in the order of (ts, seq).
    """
    write = F.col("op").isin("set", "del")
    known = log.where(write | (F.col("op") == "persist"))
    epochs = OrderedGroups(known, ["key"], ["ts", "seq"], limit).running({"__epoch": ("sum", write.cast("long"))}).df
    persisted = F.min(F.when(F.col("op") == "persist", epoch_micros("ts"))).alias("__kept")
    first = F.first(F.when(write, F.struct("op", "value", epoch_micros("ts").alias("at"), "ttl_s")), ignorenulls=True).alias("w")
    states = epochs.where("__epoch > 0").groupBy("key", "__epoch").agg(first, persisted)
    following = {"__next": lambda w: F.lead("w.at").over(w)}
    chained = OrderedGroups(states, ["key"], ["__epoch"], limit).neighbours(following, after=1).df.where("w.op = 'set'")
    dies = F.col("w.at") + F.col("w.ttl_s") * SECOND
    kept = F.when(F.col("__kept") < F.least(dies, "__next"), F.col("__kept"))
    piece = lambda since, until, expires: F.struct(since.alias("since"), until.alias("until"), expires.alias("expires"))
    pieces = F.array(
        piece(F.col("w.at"), F.least("__next", kept, dies), dies),
        piece(kept, F.col("__next"), F.lit(None).cast("long")),
    )
    each = chained.select("key", F.col("w.value").alias("value"), F.explode(pieces).alias("p")).select("key", "p.since", "p.until", "value", "p.expires")
    return each.where(F.col("since").isNotNull() & (F.col("until").isNull() | (F.col("since") < F.col("until"))))


def ttl_answers(intervals: DataFrame, wanted: DataFrame, moment: str, limit: int | None = None) -> DataFrame:
    """For every wanted (key, moment) the value and the seconds left: -1 without expiry, -2 (and no value) when the key is gone or
    was never there.

    Requests and intervals of a key are sorted together, and the last start carries over to the requests after it, in slices
    if a key has very many; the interval is then joined by its start.
    """
    starts = intervals.select("key", F.col("since").alias("__at"), F.lit(0).alias("__kind"), "since", F.lit(None).cast("timestamp_ntz").alias("__moment"))
    asked = wanted.select("key", epoch_micros(moment).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("since"), F.col(moment).cast("timestamp_ntz").alias("__moment"))
    last = OrderedGroups(starts.unionByName(asked), ["key"], ["__at", "__kind"], limit).running({"__since": ("max", "since")}).df.where("__kind = 1")
    found = last.select("key", "__moment", "__at", F.col("__since").alias("since"))
    both = join_same(found, intervals, ["key", "since"], "left").withColumn("__alive", F.col("since").isNotNull() & (F.col("until").isNull() | (F.col("__at") < F.col("until"))))
    left = F.when(F.col("expires").isNull(), F.lit(-1)).otherwise(F.call_function("div", F.col("expires") - F.col("__at"), F.lit(SECOND)))
    return both.select("key", F.col("__moment").alias(moment), F.when(F.col("__alive"), F.col("value")).alias("value"), F.when(F.col("__alive"), left).otherwise(F.lit(-2)).cast("long").alias("ttl_s"))


def exists(wanted: DataFrame, key: str, store: DataFrame, store_key: str, out: str = "found") -> DataFrame:
    """Each wanted key with a flag whether the store has it."""
    known = store.select(F.col(store_key).alias("__known")).distinct()
    joined = wanted.join(known, F.col(key) == F.col("__known"), "left")
    return joined.withColumn(out, F.col("__known").isNotNull()).drop("__known")


def limit_per_window(
    hits: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, window: str, limit: int
) -> DataFrame:
    """Clock-aligned windows: adds ``window_start``, the hit's ``count`` within it, and ``allowed``."""
    placed = hits.withColumn("window_start", F.window(ts, window)["start"])
    numbered = OrderedGroups(placed, [*keys, "window_start"], [ts, tiebreak]).number("count").df
    return numbered.withColumn("allowed", F.col("count") <= limit)


def limit_sliding(hits: DataFrame, keys: Sequence[str], ts: str, seconds: int, limit: int) -> DataFrame:
    """Hits of the key in the last ``seconds`` up to and including this moment, and whether that is within the limit."""
    placed = hits.withColumn("__at", epoch_micros(ts))
    counted = range_totals(placed, keys, "__at", seconds * SECOND, {"count": ("count", F.lit(1))})
    return counted.drop("__at").withColumn("allowed", F.col("count") <= limit)


def recent(log: DataFrame, keys: Sequence[str], order: Sequence[str | By], n: int, out: str = "pos") -> DataFrame:
    """The last ``n`` entries per key, newest first (position 0)."""
    newest = [e.reversed() for e in sort_columns(order)]
    return top_per_group(log, keys, newest, n, out).withColumn(out, F.col(out) - 1)


def queue_positions(items: DataFrame, keys: Sequence[str], order: Sequence[str | By]) -> DataFrame:
    """Position of every item in its queue when taken oldest first (``fifo``) and newest first (``lifo``), from 0."""
    numbered = OrderedGroups(items, keys, order).number("fifo", start=0).df
    sizes = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return join_same(numbered, sizes, keys).withColumn("lifo", F.col("__n") - 1 - F.col("fifo")).drop("__n")


def members(log: DataFrame, key: str, member: str, order: Sequence[str], adds: Column, removes: Column) -> DataFrame:
    """Members present per set after replaying adds and removes: those whose last action is an add."""
    actions = log.withColumn("__add", F.when(adds, True).when(removes, False)).where(F.col("__add").isNotNull())
    last = latest(actions, [key, member], order, ["__add"])
    return last.where("__add").drop("__add")


def top_per_period(
    rows: DataFrame, period: Column, member: str, score: Column, n: int, period_out: str = "period"
) -> DataFrame:
    """The ``n`` members with the highest score in each period, ties by member."""
    scores = rows.groupBy(period.alias(period_out), member).agg(score.alias("score"))
    return top_per_group(scores, [period_out], [By("score", ascending=False), member], n, "place")


def stock_and_audit(sales: DataFrame, stock: DataFrame, sku: str, quantity: str) -> tuple[DataFrame, DataFrame]:
    """(stock after the sales, one audit row per sale): both follow from the same rows, so they cannot disagree.

    Write them as one version of a ``TableSet``, and a replay of the batch changes neither.
    """
    sold = sales.groupBy(F.col(sku).alias("__sku")).agg(F.sum(quantity).alias("__sold"))
    left = stock.join(sold, F.col(sku) == F.col("__sku"), "left")
    after = left.withColumn("stock", F.col("stock") - F.coalesce("__sold", F.lit(0))).drop("__sku", "__sold")
    audit = sales.select(F.to_json(F.struct(F.lit("sale").alias("type"), F.col(sku).alias("sku"))).alias("entry"), "*")
    return after, audit
