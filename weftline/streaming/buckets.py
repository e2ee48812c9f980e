"""Keys of a stream in buckets. A state and a call of Python per key cost milliseconds for a key of any size; here the keys of a bucket share both,
and what is done for one key is done for all keys of the bucket at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

#: A task holds the rows of one bucket of one micro-batch, and the open rows of its keys.
BUCKETS = 1024
#: State of a bucket: rows in Arrow's form.
STATE = "open binary"
#: A key keeps its microseconds.
FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def in_buckets(rows: DataFrame, ts: str, tiebreak: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """(key, t, id, has_id, bucket, ts): the keys as one text, the time in microseconds; null keys are keys like any other."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    # -0.0 and 0.0 are one key.
    values = [(F.col(k) + 0.0 if isinstance(types[k], (FloatType, DoubleType)) else F.col(k)).alias(k) for k in keys]
    coded = rows.select(
        F.to_json(F.struct(*values), FORMATS).alias("key"),
        F.unix_micros(ts).alias("t"),
        F.coalesce(F.col(tiebreak).cast("long"), F.lit(0)).alias("id"),
        F.col(tiebreak).isNotNull().alias("has_id"),
        F.col(ts),
    )
    return coded.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))


def key_columns(text: str, keys: Sequence[str], schema: StructType) -> list[Column]:
    """The keys again, from their text."""
    parsed = F.from_json(text, StructType([schema[k] for k in keys]), FORMATS)
    return [parsed[k].alias(k) for k in keys]


def packed(rows: pd.DataFrame) -> tuple[bytes]:
    """Rows as the value of a state."""
    batch, sink = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return (sink.getvalue().to_pybytes(),)


def unpacked(value: tuple) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(value[0])).read_pandas()


def ordered(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """Rows by key and (t, id), an ``open`` row of the state before all others of its key, and the number of the key of every row."""
    number = pd.factorize(rows["key"])[0]
    order = np.lexsort((rows["id"], ~rows["has_id"].to_numpy(bool), rows["t"], ~rows["open"].to_numpy(bool), number))
    return rows.iloc[order].reset_index(drop=True), number[order]


def opened_by(number: np.ndarray, t: np.ndarray, width: int) -> np.ndarray:
    """For rows in order, the row that opened the window of each: the first row of a key opens one, and the first row ``width`` or more
    after an opening row opens the next. All keys take a step at a time."""
    n = len(t)
    # Where the window of each row ends: the rows of this key and those before it with an earlier time.
    order = np.lexsort((np.repeat([1, 0], n), np.concatenate((t, t + width)), np.concatenate((number, number))))
    is_row = order < n
    after = np.empty(n, np.int64)
    after[order[~is_row] - n] = np.cumsum(is_row)[~is_row]
    first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if n else np.empty(0, np.int64)
    at, last = first, np.r_[first[1:], n]
    opens = np.zeros(n, bool)
    while len(at):
        opens[at] = True
        at, more = after[at], after[at] < last
        at, last = at[more], last[more]
    return np.maximum.accumulate(np.where(opens, np.arange(n), 0))
