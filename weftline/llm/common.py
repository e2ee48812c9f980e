"""What the training-data operators share: word rules, hashing, stored steps and checked broadcasts."""

from __future__ import annotations

from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from weftline.session import cut_lineage, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word between blanks (space, tab to carriage return), and a word of letters, digits and non-ASCII characters.
BLANK_WORD, PLAIN_WORD = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Byte tables for ``bytes.translate``: lower case A-Z; the second also turns whatever cannot be in a plain word to blanks.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PLAIN_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: A table of at most this many narrow rows may be broadcast; it is counted first.
BROADCAST_ROWS = 100_000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on: small Arrow batches, shuffle files gone after each step."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z to lower case and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def id_remainder(doc_id: Column, by: int = 5) -> Column:
    """crc32 of the id's text, modulo ``by``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast after counting that it has at most ``rows`` rows; otherwise leave it to the planner."""
    return F.broadcast(stored) if stored.limit(rows + 1).count() <= rows else stored


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: lost executors cost one step, and shuffle files of the step are freed."""
    prepared(df.sparkSession)
    return cut_lineage(df)


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over unsigned integers: equal in, equal out, and every bit depends on every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all windows of ``width`` consecutive word hashes (unsigned 64-bit), in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k : k + n]
    return mixed(out)


#: A fixed 64-bit value per byte, and the factor between places, for hashes of words over bytes.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 0xD6E8FEB86659FD93
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def word_hashes(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words between blanks, and where each starts and ends in ``body``."""
    a = np.frombuffer(body, np.uint8)
    inside = ~_BLANK[a]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    size = ends - starts
    place = np.flatnonzero(inside)
    powers = np.full(int(size.max()), _STEP, np.uint64).cumprod(dtype=np.uint64)
    values = _BYTE[a[place]] * powers[place - np.repeat(starts, size)]
    sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(size)[:-1])))
    return mixed(sums + size.astype(np.uint64)), starts, ends


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the (a, b) edges: (node, component), the component being its smallest node.

    Labels spread to neighbours and then jump to their label's label, so the number of rounds grows with the logarithm of
    a component's width. Each round is a stored table; only the number of changed labels reaches the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        of = labels.withColumnsRenamed({"node": "b", "component": "seen"})
        seen = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        before = labels
        lower = stored(labels.join(seen, "node", "left").select("node", F.least("component", "seen").alias("component"), F.col("component").alias("old")))
        top = lower.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        labels = stored(lower.join(top, "component", "left").select("node", F.coalesce("jump", "component").alias("component"), "old"))
        forget(before, lower)
        changed = labels.filter("component != old").limit(1).count()
        labels = labels.drop("old")
        if not changed:
            forget(both)
            return labels


def beside(*needed: str):
    """For operators that pass other columns through: these get neutral names while ``fn`` runs, so that they cannot clash.

    An input column with the name of one that the operator adds is replaced by it.
    """

    def wrap(fn):
        @wraps(fn)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            names = {c: f"__{k}" for k, c in enumerate(docs.columns) if c not in needed}
            out = fn(docs.withColumnsRenamed(names), *args, **kwargs)
            back = {new: old for old, new in names.items() if new in out.columns and old not in out.columns}
            taken = [new for old, new in names.items() if new in out.columns and old in out.columns]
            return out.drop(*taken).withColumnsRenamed(back)

        return run

    return wrap
