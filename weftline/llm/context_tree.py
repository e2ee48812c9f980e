"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions; a decision is seen in the contexts of the 0 to ``DEPTH`` bytes before it. Each node
(context, earlier decisions of the byte) keeps a Krichevsky-Trofimov estimate, and the weighted tree mixes the estimates of all
depths: a node's own block probability against the product of its children's. The corpus statistics are counts of byte
windows, summed per task before they are shuffled; the tree is then built upwards, one grouping per depth, and mixed downwards,
one join per depth. Every node is used, whatever their number: all byte windows of the texts get their probability in Spark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import LOWER_BYTES, forget, id_remainder, stored, utf8

DEPTH = 5
#: Byte windows whose probabilities scoring holds in memory, the most frequent ones; the others are joined.
MODEL_WINDOWS = 1_000_000
#: Words whose counts scoring holds in memory at most; the others are joined.
TOP_WORDS = 200_000
#: Words or byte windows that a task sums up before it hands them on.
HELD = 300_000
#: Slots in a scoring task for byte windows that were looked up before.
SLOTS = 1 << 20
#: log10 probabilities are whole numbers of this unit, so that sums are the same in any order; none is above 0.
UNIT, FAR = 1 << 30, 1


def windows(bodies: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(windows, ends): for each byte of each text, and one end byte 0, the byte and the ``depth`` bytes before it.

    A text begins after zero bytes. ``ends`` has the number of windows up to each text's end.
    """
    pad = bytes(depth)
    a = np.frombuffer(b"".join(pad + b + b"\0" for b in bodies) or pad, np.uint8).astype(np.uint64)
    n = max(0, len(a) - depth)
    w = a[depth:].copy()
    for k in range(1, depth + 1):
        w |= a[depth - k : depth - k + n] << np.uint64(8 * k)
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    starts = np.cumsum(sizes + depth) - sizes - depth
    inside = np.ones(n, bool)
    for k in range(depth):  # windows that end in the zeros before a text
        inside[starts[1:] - depth + k] = False
    return w[inside], np.cumsum(sizes)


def _log_gamma(x):
    """ln of the gamma function for x >= 1/2, by its series at x + 6; good to ten digits."""
    y, product = x + 6, x
    for k in range(1, 6):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def count_windows(bodies: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(window, n, all): over the texts in the column ``body`` that are not ``held_out``, and over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        for batch in batches:
            texts = [b.as_py().translate(LOWER_BYTES) for b in batch.column("body")]
            out = batch.column("held_out").to_pylist()
            for row, wanted in enumerate((False, True)):
                for part in _parts([t for t, o in zip(texts, out) if o == wanted]):
                    k, c = np.unique(windows(part, depth)[0], return_counts=True)
                    more = np.zeros((2, len(k)), np.int64)
                    more[row] = c
                    keys, back = np.unique(np.concatenate((keys, k)), return_inverse=True)
                    both = np.concatenate((counts, more), axis=1)
                    counts = np.array([np.bincount(back, x, len(keys)) for x in both]).astype(np.int64).reshape(2, -1)
                    if len(keys) > 4 * HELD:
                        yield _counted(keys, counts)
                        keys, counts = keys[:0], counts[:, :0]
        yield _counted(keys, counts)

    each = bodies.select("body", "held_out").mapInArrow(run, "window long, n long, all long")
    return each.groupBy("window").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts[0]), pa.array(counts[0] + counts[1])], names=["window", "n", "all"])


def _parts(texts: list[bytes], limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts in groups of about ``limit`` bytes, so that arrays over their bytes stay small."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def tree(counted: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """Nodes of the weighted tree from window counts, a stored table for each depth from 0: context (latest byte lowest), earlier
    (the byte's earlier bits after a leading 1), a and b (zeros and ones seen) and value.

    ``value`` is the mixed probability that the next bit is 1 if this is the deepest node that training has seen. With p the
    estimate of a node and stop its own weight, it is sum + rest * p, the sum and the rest being those of the path above.
    """
    bits = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")
    each = counted.select((F.col("window").bitwiseAND(255)).alias("byte"), F.shiftrightunsigned("window", 8).alias("context"), "n", bits)
    bit = F.expr("(byte >> (7 - k)) & 1")
    level = each.select("context", F.expr("(1L << k) | (byte >> (8 - k))").alias("earlier"), "n", bit.alias("bit"))
    level = level.groupBy("context", "earlier").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("b"))
    level = level.withColumn("below", F.lit(None).cast("double"))
    kept = []
    for d in range(depth, -1, -1):
        if d < depth:
            context = F.col("context").bitwiseAND((1 << 8 * d) - 1).alias("context")
            level = level.groupBy(context, "earlier").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("below"))
        own = _log_gamma(F.col("a") + 0.5) + _log_gamma(F.col("b") + 0.5) - _log_gamma(F.col("a") + F.col("b") + 1.0) - math.log(math.pi)
        level = level.withColumn("own", own)
        larger, smaller = F.greatest("own", "below"), F.least("own", "below")
        mixed = larger + F.log1p(F.exp(smaller - larger)) - math.log(2)
        level = stored(level.withColumn("weighted", F.when(F.col("below").isNull(), F.col("own")).otherwise(mixed)))
        kept.append(level)
    p = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1.0)
    # 1 - stop as a fraction of its own: near 0 it would be lost in the difference.
    ratio = F.exp(F.greatest(F.lit(-700.0), F.least(F.col("below") - F.col("own"), F.lit(700.0))))
    stop, go = 1 / (1 + ratio), ratio / (1 + ratio)
    nodes = []
    for d, level in enumerate(reversed(kept)):
        if d:
            above = nodes[-1].select(F.col("context").alias("parent"), "earlier", F.col("sum").alias("_sum"), F.col("rest").alias("_rest"))
            parent = F.col("context").bitwiseAND((1 << 8 * (d - 1)) - 1)
            level = level.withColumn("parent", parent).join(above, ["parent", "earlier"])
        else:
            level = level.withColumns({"_sum": F.lit(0.0), "_rest": F.lit(1.0)})
        value = F.col("_sum") + F.col("_rest") * p
        path = [(F.col("_sum") + F.col("_rest") * stop * p).alias("sum"), (F.col("_rest") * go).alias("rest")] if d < depth else []
        nodes.append(stored(level.select("context", "earlier", "a", "b", value.alias("value"), *path)))
    forget(*kept)
    return nodes


def _units(log10):
    return F.round(log10 * UNIT).cast("long")


def window_values(counted: DataFrame, nodes: list[DataFrame], depth: int = DEPTH) -> DataFrame:
    """(window, value): log10 probability of the byte after its context, in units, of every window of ``counted``."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("nodes")
            flat = lists.flatten()
            earlier, value = flat.field("earlier").to_numpy(zero_copy_only=False), flat.field("value").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            key = row * 256 + earlier
            order = np.argsort(key)
            key, value = key[order], value[order]
            last = earlier >= 128
            ends = [np.flatnonzero(last & (flat.field(c).to_numpy(zero_copy_only=False) > 0)) for c in ("a", "b")]
            of = np.concatenate([row[e] for e in ends])
            byte = np.concatenate([2 * earlier[e] - 256 + bit for bit, e in enumerate(ends)])
            total = np.zeros(len(of))
            for k in range(8):
                p = value[np.searchsorted(key, of * 256 + ((1 << k) | (byte >> (8 - k))))]
                total += np.log10(np.where((byte >> (7 - k)) & 1 == 1, p, 1 - p))
            window = batch.column("context").to_numpy()[of] << 8 | byte
            yield pa.RecordBatch.from_arrays([pa.array(window), pa.array(np.rint(total * UNIT).astype(np.int64))], names=["window", "value"])

    leaves = nodes[depth].groupBy("context").agg(F.collect_list(F.struct("earlier", "a", "b", "value")).alias("nodes"))
    seen = leaves.mapInArrow(spelled, "window long, value long")
    # Windows that training has not seen: each bit takes its deepest node, or even odds.
    bits = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")
    each = counted.filter("n = 0").select("window", (F.col("window").bitwiseAND(255)).alias("byte"), F.shiftrightunsigned("window", 8).alias("of"), bits)
    each = each.select("window", "of", F.expr("(1L << k) | (byte >> (8 - k))").alias("earlier"), F.expr("(byte >> (7 - k)) & 1").alias("bit"), F.lit(None).cast("double").alias("p"))
    for d in range(depth, -1, -1):
        each = each.withColumn("context", F.col("of").bitwiseAND((1 << 8 * d) - 1)).join(nodes[d].select("context", "earlier", "value"), ["context", "earlier"], "left")
        each = each.select("window", "of", "earlier", "bit", F.coalesce("p", "value").alias("p"))
    p = F.coalesce("p", F.lit(0.5))
    unseen = each.groupBy("window").agg(F.sum(_units(F.log10(F.when(F.col("bit") == 1, p).otherwise(1 - p)))).alias("value"))
    return seen.unionAll(unseen)


class Windows:
    """The held windows in a sorted array with their log10 probabilities in units."""

    def __init__(self, window: np.ndarray, known: np.ndarray, depth: int = DEPTH):
        self.window, self.known, self.depth = window, known, depth
        self.seen = np.full(SLOTS, np.uint64(2**64 - 1))
        self.value = np.zeros(SLOTS, np.int64)

    def looked_up(self, window: np.ndarray) -> np.ndarray:
        if not len(self.window):
            return np.full(len(window), FAR)
        at = np.searchsorted(self.window, window)
        at[at == len(self.window)] = 0
        return np.where(self.window[at] == window, self.known[at], FAR)

    def score(self, bodies: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        """Per lower-cased text: the sum over its held windows and the end's, and (window, k) of the others."""
        sums, places, keys, times, before = [], [], [], [], 0
        for part in _parts(bodies, 1 << 19):
            w, ends = windows(part, self.depth)
            slot = ((w * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
            value = self.value[slot]
            new = np.flatnonzero(self.seen[slot] != w)
            if len(new):
                key, back = np.unique(w[new], return_inverse=True)
                fresh = self.looked_up(key)
                value[new] = fresh[back]
                at = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
                at, one = np.unique(at, return_index=True)
                self.value[at], self.seen[at] = fresh[one], key[one]
            far = np.flatnonzero(value == FAR)
            value[far] = 0
            sums.append(np.add.reduceat(value, np.concatenate(([0], ends[:-1]))))
            of = np.searchsorted(ends, far, "right")
            order = np.lexsort((w[far], of))
            of, far = of[order], w[far][order]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(of) != 0) | (far[1:] != far[:-1])))[: len(of)])
            places.append(before + of[first])
            keys.append(far[first])
            times.append(np.diff(np.append(first, len(of))))
            before += len(part)
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        offsets = np.searchsorted(join(places, np.int64), np.arange(len(bodies) + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(join(keys, np.uint64).view(np.int64)), pa.array(join(times, np.int64))], names=["window", "k"])
        return join(sums, np.int64), pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _threshold(rows: DataFrame, count: str, limit: int) -> int:
    """The smallest count such that at most ``limit`` rows have it or more; from a histogram of powers of 1.02, not the rows."""
    step = F.floor(F.log(F.col(count).cast("double")) / math.log(1.02))
    bins = rows.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.min(count).alias("least")).collect()
    least, held = 2**63 - 1, 0
    for r in sorted(bins, key=lambda r: -r.bin):
        held += r.rows
        if held > limit:
            return least
        least = r.least
    return 1


def count_words(bodies: DataFrame) -> DataFrame:
    """(word, c): lower-cased words between blanks and the end token (the empty word) over all texts in ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for b in batch.column("body"):
                held.update(b.as_py().translate(LOWER_BYTES).split())
                held[b""] += 1
                if len(held) > HELD:
                    yield _words(held)
                    held.clear()
        yield _words(held)

    return bodies.select("body").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _words(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "c"])


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, code_length.

    Learns from rows whose id remainder is not 1. ``base_score`` is the smoothed word model; ``score`` is the tree's log10
    probability of the lower-cased text and its end; ``code_length`` is bits per byte. Null texts are empty; an
    empty text has its end as the only token. A null id counts as an empty one. With nothing to learn from, every bit costs one bit. An
    empty table gives no rows. Equal rows get equal results.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", utf8(F.col("text")).alias("body")).withColumn("held_out", id_remainder(F.col("doc_id")) == 1)
    train = rows.filter("NOT held_out").select("body")
    counted = stored(count_windows(rows, depth))
    nodes = tree(counted.filter("n > 0"), depth)
    values = stored(window_values(counted, nodes, depth))
    often = counted.filter(F.col("all") >= _threshold(counted, "all", MODEL_WINDOWS)).select("window")
    arrays = values.join(often, "window").toArrow()
    order = np.argsort(arrays["window"].to_numpy().astype(np.uint64))
    known_windows = spark.sparkContext.broadcast((arrays["window"].to_numpy().astype(np.uint64)[order], arrays["value"].to_numpy()[order]))
    del arrays, order
    forget(counted, *nodes)

    words = stored(count_words(train))
    totals = words.agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    n, v = totals.n or 0, totals.v
    frequent = words.filter(F.col("c") >= _threshold(words, "c", TOP_WORDS)).toArrow()
    top = spark.sparkContext.broadcast(dict(zip(frequent["word"].to_pylist(), frequent["c"].to_pylist())))
    del frequent
    base = math.log10(n + 0.5 * (v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = top.value, {w: math.log10(c + 0.5) for w, c in top.value.items()}
        lm = Windows(*known_windows.value, depth)
        for batch in batches:
            tokens, n_known, sums, rest, sizes = [], [], [], [], []
            bodies = [b.as_py().translate(LOWER_BYTES) for b in batch.column("body")]
            for body in bodies:
                split = body.split()
                split.append(b"")
                hits = [logs[w] for w in split if w in known]
                rare = Counter(w for w in split if w not in known)
                tokens.append(len(split))
                n_known.append(len(hits))
                sums.append(math.fsum(hits))
                rest.append([{"word": w, "k": k} for w, k in rare.items()])
                sizes.append(len(body))
            near, far = lm.score(bodies)
            columns = [
                batch.column("doc_id"), batch.column("held_out"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()),
                pa.array(sums, pa.float64()), pa.array(near), far, pa.array(rest, pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "digest", "bytes", "n_tokens", "n_known", "base", "near", "far", "rare"])

    schema = "doc_id long, held_out boolean, digest long, bytes long, n_tokens long, n_known long, base double, near long, far array<struct<window:long,k:long>>, rare array<struct<word:binary,k:long>>"
    first = rows.withColumn("digest", F.xxhash64("body")).mapInArrow(run, schema)
    first = stored(first.withColumn("row", F.monotonically_increasing_id()))
    # The words that are not in memory: once per document (equal rows share the answer), joined with their counts.
    each = first.select("doc_id", "digest", F.explode("rare").alias("r")).select("doc_id", "digest", "r.word", "r.k").distinct()
    counts = words.select("word", "c")
    found = each.join(counts, "word", "left").groupBy("doc_id", "digest").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("also")
    )
    found = found.withColumnsRenamed({"doc_id": "of", "digest": "of_digest"})
    # And the windows that are not in memory: whole units, so equal rows get equal sums in any order.
    lost = first.select("row", F.explode("far").alias("f")).select("row", "f.window", "f.k").join(values, "window")
    lost = lost.groupBy("row").agg(F.sum(F.col("k") * F.col("value")).alias("farther"))
    first = first.drop("rare", "far").join(lost, "row", "left").withColumn("score", (F.col("near") + F.coalesce("farther", F.lit(0))) / UNIT)
    out = first.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * base).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / (F.col("bytes") + 1)).alias("code_length"),
    )
