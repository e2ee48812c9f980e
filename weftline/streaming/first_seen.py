"""The first row of a key within a time to live, by event time, with a state and a timer per bucket of keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.streaming.buckets import BUCKETS, STATE, in_buckets, key_columns, opened_by, ordered, packed, unpacked

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What comes in, and what is yielded.
ROW = ["key", "t", "id", "has_id"]


class _First(StatefulProcessor):
    """The state holds the last first row of every key of the bucket, as ``open``, and the rows that the watermark has not passed yet.

    A row is judged once the watermark has passed it, as nothing earlier can come then. The timer stands at the earliest waiting
    row or end of a time to live, where a key is forgotten.
    """

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("kept", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = pd.DataFrame.from_records([tuple(r[c] for c in ROW) for r in rows], columns=ROW)
        yield from self._judge([new.assign(open=False)], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._judge([], timerValues.getCurrentWatermarkInMs())

    def _judge(self, new: list[pd.DataFrame], watermark_ms: int) -> Iterator[Row]:
        kept = [unpacked(self.state.get())] if self.state.exists() else []
        if not kept and not new:
            return
        rows, number = ordered(pd.concat(kept + new, ignore_index=True))
        passed = max(0, watermark_ms) * 1000
        judged = (rows["t"] < passed).to_numpy() | rows["open"].to_numpy(bool)
        settled, of = rows[judged], number[judged]
        first = opened_by(of, settled["t"].to_numpy(), self.ttl)
        found = settled[(first == np.arange(len(first))) & ~settled["open"].to_numpy(bool)]
        for values in zip(*(found[c].tolist() for c in ROW)):
            yield Row(**dict(zip(ROW, values)))
        # The last first row of each key, within whose time to live a row can only be a repeat.
        last = np.flatnonzero(np.r_[of[1:] != of[:-1], True]) if len(of) else of
        seen = settled.iloc[first[last]].assign(open=True)
        until = np.full(len(rows), -(2**63))
        until[of[last]] = seen["t"].to_numpy() + self.ttl
        waiting = rows[~judged & (rows["t"].to_numpy() >= until[number])]
        left = pd.concat([seen[seen["t"] + self.ttl > passed], waiting], ignore_index=True)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if left.empty:
            self.state.clear()
        else:
            self.state.update(packed(left))
            self.handle.registerTimer(max(int((left["t"] + self.ttl * left["open"]).min()) // 1000 + 1, watermark_ms + 1))

    def close(self) -> None:
        pass


@contextmanager
def timers(spark: SparkSession):
    """State and timers of a bucket need the RocksDB store; other queries keep the session's setting."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def first_within(
    events: DataFrame, ts: str, tiebreak: str, keys: Sequence[str], ttl_s: int, delay: str, buckets: int = BUCKETS
) -> DataFrame:
    """(keys, tiebreak, ts) of every row that no row of its key precedes by less than ``ttl_s`` seconds since the key's last such row.

    The first row of a key is first, rows less than the time to live after it are repeats, the next one after that is first
    again, and so on. Rows are judged in the order of (ts, tiebreak) once the watermark has passed them, whatever order they come
    in; a row behind the watermark is dropped by the engine, one without time is left out. A key is forgotten ``ttl_s`` after
    its last first row. The state of a bucket of keys holds what came within ``delay`` and one micro-batch. Run it with ``timers``.
    """
    timed = events.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    prepared = in_buckets(timed, ts, tiebreak, keys, buckets)
    first = prepared.groupBy("bucket").transformWithState(_First(ttl_s * 1_000_000), "key string, t long, id long, has_id boolean", "Append", "EventTime")
    types = {f.name: f.dataType for f in events.schema.fields}
    number = F.when(F.col("has_id"), F.col("id")).cast(types[tiebreak])
    return first.select(*key_columns("key", keys, events.schema), number.alias(tiebreak), F.timestamp_micros("t").alias(ts))
