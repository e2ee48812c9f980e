"""Substring dedup: remove word runs that an earlier document holds as well, found through difference-cover anchors.

Two documents that share ``WINDOW`` consecutive words need not share any of a few fixed positions. But with a set of
residues whose differences cover every residue modulo ``PERIOD``, some place inside the shared run lies on a cover position in
both documents at once. So it is enough to hash the windows of ``ANCHOR`` = WINDOW - PERIOD + 1 words that start at cover
positions, about a fifth of all. Where such an anchor stands in two documents, the full windows around it are hashed in turn, and the
smallest document of each full window decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import forget, mixed, stored, utf8, window_hashes, word_hashes

WINDOW, PERIOD = 50, 31
#: Six residues whose 30 differences are all residues but 0 modulo 31 (fixed values).
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1


def cover_places(n: int) -> np.ndarray:
    """The first words of the anchors of a document of ``n`` words, in order."""
    rounds = np.arange(max(0, n) // PERIOD + 1)[:, None] * PERIOD + np.array(COVER)
    places = rounds.ravel()
    return places[places + ANCHOR <= n]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(parts: list[np.ndarray], kind: type) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *parts]).astype(kind, copy=False)))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: words, two hashes of all words, the digest of the whole word sequence, the anchors."""
    for batch in batches:
        n, a, b, digest, anchors = [], [], [], [], []
        for body in batch.column("body"):
            body = body.as_py()
            h, _, _ = word_hashes(body)
            n.append(len(h))
            whole = window_hashes(h, len(h)) if len(h) < 2 else _sequence(h)
            a.append(int(whole[0]) if len(h) else 0)
            b.append(int(mixed(h + np.uint64(1)).sum(dtype=np.uint64)) if len(h) else 0)
            digest.append(hashlib.sha256(b" ".join(body.split())).hexdigest())
            if len(h) < WINDOW:
                anchors.append(np.zeros(0, np.int64))
            else:
                anchors.append(window_hashes(h, ANCHOR)[cover_places(len(h))].view(np.int64))
        columns = [batch.column("doc_id"), pa.array(n, pa.int64()), _signed(np.array(a, np.uint64)), _signed(np.array(b, np.uint64)), pa.array(digest, pa.string()), _lists(anchors, np.int64)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig_a", "sig_b", "digest", "anchors"])


def _sequence(h: np.ndarray) -> np.ndarray:
    """One hash of the words in their order."""
    powers = np.full(len(h), 0x9E3779B97F4A7C15, np.uint64).cumprod(dtype=np.uint64)
    return mixed((mixed(h) * powers).sum(dtype=np.uint64).reshape(1))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document with shared anchors: the full windows around them."""
    for batch in batches:
        starts, hashes = [], []
        for body, marks in zip(batch.column("body"), batch.column("marks")):
            h, _, _ = word_hashes(body.as_py())
            wanted = np.zeros(len(h) - WINDOW + 2, np.int32)
            at = cover_places(len(h))[np.array(marks.as_py(), np.int64)]
            np.add.at(wanted, np.maximum(at - (PERIOD - 1), 0), 1)
            np.add.at(wanted, np.minimum(at, len(h) - WINDOW) + 1, -1)
            here = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
            starts.append(here.astype(np.int32))
            hashes.append(window_hashes(h, WINDOW)[here].view(np.int64))
        columns = [*(batch.column(c) for c in ("doc_id", "sig_a", "body")), _lists(starts, np.int32), _lists(hashes, np.int64)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig_a", "body", "starts", "hashes"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document with repeated windows: spans of removed words, and the words that stay, joined by one blank."""
    for batch in batches:
        spans, counts, kept = [], [], []
        for body, starts, places in zip(batch.column("body"), batch.column("starts"), batch.column("repeated")):
            words = body.as_py().split()
            at = np.array(starts.values.to_numpy()[np.array(places.as_py(), np.int64)], np.int64)
            change = np.zeros(len(words) + 1, np.int32)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])])
            counts.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone) if not g))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = [batch.column("doc_id"), batch.column("sig_a"), pa.array(spans, span), pa.array(counts, pa.int64()), pa.array([k.decode() for k in kept], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig_a", "spans", "n_removed", "kept_text"])


def repeated_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans and kept_text.

    A word goes if a window of 50 words over it also starts in a document with a smaller doc_id; windows are judged on the
    input. ``spans`` and ``kept_text`` are null where nothing is removed; where the whole text stands in a smaller
    document, the span is the whole text. Null and empty texts have no words. Rows that share a doc_id do not
    remove each other's words; rows without doc_id neither lose words nor cost others any. An empty table gives no rows.

    A text that several documents hold takes part once, as its smallest document, so a large group of copies is as cheap
    as one document. All groupings are partial sums or minima, and joins may be split, so a run that very many documents share
    does not meet in one task.
    """
    docs = docs.select("doc_id", utf8(F.col("text")).alias("body"))
    base = stored(docs.mapInArrow(_measured, "doc_id long, n long, sig_a long, sig_b long, digest string, anchors array<long>"))
    text_of = ["n", "sig_a", "sig_b"]
    named = base.filter(F.col("doc_id").isNotNull() & (F.col("n") >= WINDOW))
    first = stored(named.groupBy(*text_of).agg(F.min("doc_id").alias("first")))
    # One row per text: anchors travel once for the grouping and once for the join.
    texts = named.join(first, text_of).filter("doc_id = first").dropDuplicates(["doc_id", *text_of])
    anchors = stored(texts.select("doc_id", "sig_a", F.posexplode("anchors").alias("place", "anchor")))
    held = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    shared = stored(held.select("anchor"))
    marked = anchors.join(shared, "anchor").groupBy("doc_id", "sig_a").agg(F.collect_list("place").alias("marks"))
    marked = stored(marked)
    forget(anchors, shared)

    keyed = docs.join(marked.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_with_signature, "doc_id long, sig_a long, body binary")
    wide = keyed.dropDuplicates(["doc_id", "sig_a"]).join(marked, ["doc_id", "sig_a"])
    windows = stored(wide.mapInArrow(_windows, "doc_id long, sig_a long, body binary, starts array<int>, hashes array<long>"))
    each = windows.select("doc_id", "sig_a", F.posexplode("hashes").alias("place", "window"))
    owners = stored(each.groupBy("window").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("window", "lo"))
    later = each.join(owners, "window").filter("lo < doc_id")
    repeated = stored(later.groupBy("doc_id", "sig_a").agg(F.collect_list("place").alias("repeated")))
    forget(owners)
    lost = windows.join(repeated, ["doc_id", "sig_a"]).mapInArrow(
        _removed, "doc_id long, sig_a long, spans array<struct<start:int,end:int>>, n_removed long, kept_text string"
    )
    lost = stored(lost)
    forget(windows, repeated)

    out = base.drop("anchors").join(first, text_of, "left").join(lost, ["doc_id", "sig_a"], "left")
    copy = F.col("first") < F.col("doc_id")
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end")))
    digest = F.when(F.col("n_removed").isNull(), F.col("digest")).otherwise(F.sha2(F.col("kept_text").cast("binary"), 256))
    return out.select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(digest).alias("kept_sha256"),
        F.when(copy, everything).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def _with_signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signs = []
        for body in batch.column("body"):
            h, _, _ = word_hashes(body.as_py())
            whole = window_hashes(h, len(h)) if len(h) < 2 else _sequence(h)
            signs.append(int(whole[0]) if len(h) else 0)
        columns = [batch.column("doc_id"), _signed(np.array(signs, np.uint64)), batch.column("body")]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig_a", "body"])
