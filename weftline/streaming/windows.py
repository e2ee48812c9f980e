"""Windowed streaming aggregations. Each works on a batch DataFrame as well, which is how they are tested.

All of them aggregate partially before the shuffle, so a hot key costs one row per task and window; state is dropped once
the watermark has passed a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.ordered import join_same


def tumbling(events: DataFrame, ts: str, size: str, delay: str, keys: Sequence[str], **values: Column) -> DataFrame:
    """Aggregates per key and clock-aligned window: ``window_start``, keys, values."""
    return _windowed(events.withWatermark(ts, delay), F.window(ts, size), keys, values)


def sliding(
    events: DataFrame, ts: str, size: str, slide: str, delay: str, keys: Sequence[str], **values: Column
) -> DataFrame:
    """Aggregates per key over windows of ``size`` that start every ``slide``."""
    return _windowed(events.withWatermark(ts, delay), F.window(ts, size, slide), keys, values)


def sessions(events: DataFrame, ts: str, gap: str, delay: str, keys: Sequence[str], **values: Column) -> DataFrame:
    """Aggregates per key and session; a session ends when no event came for ``gap``."""
    grouped = events.withWatermark(ts, delay).groupBy(*keys, F.session_window(ts, gap).alias("w"))
    return grouped.agg(*[c.alias(n) for n, c in values.items()]).select(
        *keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *values
    )


def first_seen(events: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """The first row of each key; repeats within ``delay`` of it are dropped.

    Once the watermark has passed that time, the next micro-batch forgets the key, and it counts as new again.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def drops(arrived: DataFrame, windows: DataFrame, keys: Sequence[str], hits: str) -> DataFrame:
    """Per key: rows that arrived, rows that the windows counted, and rows that were dropped because they came too late.

    The engine reports dropped groups of rows, not rows; both sides are aggregated before they are joined.
    """
    came = arrived.groupBy(*keys).agg(F.count(F.lit(1)).alias("arrived"))
    taken = windows.groupBy(*keys).agg(F.sum(hits).alias("counted"))
    counted = F.coalesce("counted", F.lit(0))
    return join_same(came, taken, keys, "left").select(*keys, "arrived", counted.alias("counted"), (F.col("arrived") - counted).alias("dropped"))


def _windowed(events: DataFrame, window: Column, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    grouped = events.groupBy(window.alias("w"), *keys).agg(*[c.alias(n) for n, c in values.items()])
    return grouped.select(F.col("w.start").alias("window_start"), *keys, *values)
