"""The first-hit rate limiter on a stream, with one small state per bucket of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.operators.limiter import SECOND
from weftline.streaming.buckets import BUCKETS, STATE, in_buckets, key_columns, opened_by, ordered, packed, unpacked


def limit_stream(
    hits: DataFrame, key: str, ts: str, tiebreak: str, limit: int, window_s: int, delay: str, buckets: int = BUCKETS
) -> DataFrame:
    """Each hit with ``window_start``, ``count`` and ``allowed``, as in the batch limiter.

    Hits are ordered within a micro-batch; a hit that arrives in a later batch than its successors counts into the window
    open at that time. Hits without time are left out, a null key is a key of its own. The state holds the start and count of the
    open window of every key of a bucket; a window is dropped once the watermark has passed its end. A task holds the hits of one
    bucket of one micro-batch; bound the batch with ``maxFilesPerTrigger`` (or ``maxBytesPerTrigger``) on the source.
    """
    width = window_s * SECOND

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = unpacked(state.get) if state.exists else None
        watermark = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            new = pd.concat(list(batches)).drop(columns=["bucket", "ts"])
            rows, number = ordered(pd.concat([kept, new.assign(open=False, count=1)], ignore_index=True))
            t, is_open = rows["t"].to_numpy(), rows["open"].to_numpy(bool)
            start = opened_by(number, t, width)
            rows["start"], rows["count"] = t[start], np.arange(len(t)) - start + rows["count"].to_numpy()[start]
            out = rows[~is_open]
            yield out[["id", "has_id", "key", "start", "count"]]
            last = rows[np.r_[number[1:] != number[:-1], True]]
            kept = last.assign(t=last["start"], id=0, has_id=True, open=True)[["key", "t", "id", "has_id", "open", "count"]]
        kept = kept[kept["t"] + width > watermark * 1000]
        if kept.empty:
            state.remove()
        else:
            state.update(packed(kept))
            state.setTimeoutTimestamp(max(int(kept["t"].min() + width) // 1000 + 1, watermark + 1))

    timed = hits.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    prepared = in_buckets(timed, ts, tiebreak, [key], buckets).withColumnRenamed(ts, "ts")
    folded = prepared.groupBy("bucket").applyInPandasWithState(
        fold,
        "id long, has_id boolean, key string, start long, count long",
        STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    types = {f.name: f.dataType for f in hits.schema.fields}
    return folded.select(
        F.when(F.col("has_id"), F.col("id")).cast(types[tiebreak]).alias(tiebreak),
        *key_columns("key", [key], hits.schema),
        F.timestamp_micros("start").alias("window_start"),
        "count",
        (F.col("count") <= limit).alias("allowed"),
    )
