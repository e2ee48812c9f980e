"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton of a block of items recognises every run of words that occurs in some item. Documents stream through it word
by word; the longest matching length says at each word whether a window of an item ends here. Items come in blocks of a
bounded number of words, so what is broadcast is bounded; documents pass once per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weftline.llm.common import LOWER_BYTES, PLAIN_BYTES, beside, stored, utf8

WINDOW = 10
#: Words of test items in one automaton.
BLOCK_WORDS = 200_000
#: A hit run of at least this many words is cut from a text; a text of which more than this percentage is hit goes.
CUT_WORDS, COVERAGE_PERCENT = 1, 50


class Automaton:
    """Generalised suffix automaton of word sequences. State 0 is the root."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.items_at: list[set[str]] = [set()]
        ends: list[tuple[int, str, int]] = []
        self.least = window
        for item, words in items:
            if not words:
                continue
            last = 0
            for word in words:
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                self.items_at[last].add(item)
            if len(words) < window:
                ends.append((last, item, len(words)))
                self.least = min(self.least, len(words))
        by_length = sorted(range(1, len(self.len)), key=self.len.__getitem__)
        for state in reversed(by_length):
            if self.link[state] > 0:
                self.items_at[self.link[state]] |= self.items_at[state]
        # Whole short items by the state of their last word, and for each state those along its suffix links.
        self.short: list[tuple[tuple[str, int], ...]] = [()] * len(self.len)
        at: dict[int, set[tuple[str, int]]] = {}
        for state, item, n in ends:
            at.setdefault(state, set()).add((item, n))
        for state in by_length:
            self.short[state] = tuple(sorted(at.get(state, ()))) + self.short[max(self.link[state], 0)]

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        new = self._state(self.len[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(0)
        self.items_at.append(set())
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit runs as (start, end) in words, in order and apart, and the items whose windows occur."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).astype(np.int8), [0]))))
        runs: list[list[int]] = []
        found: set[str] = set()
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.least:
                self._stream(ids[start:end].tolist(), start, runs, found)
        return [(a, b) for a, b in runs], found

    def _stream(self, ids: list[int], offset: int, runs: list[list[int]], found: set[str]) -> None:
        moves, link, lengths, short, window = self.next, self.link, self.len, self.short, self.window
        state = length = 0
        for i, c in enumerate(ids, offset + 1):
            while state and c not in moves[state]:
                state = link[state]
                length = lengths[state]
            if c in moves[state]:
                state = moves[state][c]
                length += 1
            back = 0
            if length >= window:
                back, at = window, state
                while lengths[link[at]] >= window:
                    at = link[at]
                found |= self.items_at[at]
            for item, n in short[state]:
                if n <= length:
                    found.add(item)
                    back = max(back, n)
            if back:
                start = i - back
                while runs and runs[-1][1] >= start:
                    start = min(start, runs.pop()[0])
                runs.append([start, i])


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``block_words`` words; one block at a time reaches the driver."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), utf8(F.col("text")).alias("body")).distinct()
    sizes = items.withColumn("size", F.octet_length("body").cast("long"))
    before = F.sum("size").over(Window.orderBy("item", "body").rowsBetween(Window.unboundedPreceding, -1))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    limit = block_words * 4
    if total <= limit:
        yield [(r.item, bytes(r.body)) for r in items.collect()]
        return
    placed = stored(sizes.withColumn("block", F.floor(F.coalesce(before, F.lit(0)) / limit)).drop("size"))
    for k in range(total // limit + 1):
        if block := [(r.item, bytes(r.body)) for r in placed.filter(F.col("block") == k).collect()]:
            yield block


@beside("text")
def spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row with n_words, ``hit_runs`` (array of (start, end) words) and ``items`` (ids whose windows occur).

    A null text, of a document or an item, has no words; such an item has no window. Items that share an id count as
    one. Without items nothing is hit. Other columns of ``docs`` pass through.
    """
    spark = docs.sparkSession
    schema = docs.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "hit_runs": F.array().cast("array<struct<start:int,end:int>>"),
            "items": F.array().cast("array<string>"),
        }
    ).schema
    out = docs.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields[-3:]})
    blocks = list(_blocks(benchmark, block_words)) or [[]]
    for block in blocks:
        texts = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], texts=texts) -> Iterator[pa.RecordBatch]:
            automaton = Automaton([(item, body.translate(PLAIN_BYTES).split()) for item, body in texts.value], window)
            for batch in batches:
                counts, all_runs, all_items = [], [], []
                body = batch.column("text").cast(pa.large_binary())
                old_runs, old_items = batch.column("hit_runs").to_pylist(), batch.column("items").to_pylist()
                for value, runs0, items0 in zip(body, old_runs, old_items):
                    words = (value.as_py() or b"").translate(PLAIN_BYTES).split()
                    runs, items = automaton.hits(words)
                    if runs0:
                        runs = _union(runs + [(r["start"], r["end"]) for r in runs0])
                    counts.append(len(words))
                    all_runs.append([{"start": a, "end": b} for a, b in runs])
                    all_items.append(sorted(items.union(items0 or ())))
                columns = dict(zip(batch.schema.names, batch.columns))
                columns["n_words"] = pa.array(counts, pa.int64())
                columns["hit_runs"] = pa.array(all_runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                columns["items"] = pa.array(all_items, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        out = out.mapInArrow(run, schema)
    return out


def _union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def n_hit():
    return F.aggregate("hit_runs", F.lit(0), lambda a, r: a + r["end"] - r["start"]).cast("long")


def items_digest():
    return F.sha2(F.array_join("items", ",").cast("binary"), 256)


@beside("text")
def cut(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cut_words: int = CUT_WORDS, coverage: int = COVERAGE_PERCENT) -> DataFrame:
    """``docs`` without contaminated text: hit runs of at least ``cut_words`` words are removed from ``text``.

    Documents of which more than ``coverage`` percent of the words are hit go. What lies between two kept words stays as
    it was; a run goes together with the blanks after it. Texts without a hit are untouched.
    """
    hit = spans.__wrapped__(docs, benchmark, window).filter(100 * n_hit() <= coverage * F.col("n_words"))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, runs in enumerate(batch.column("hit_runs").to_pylist()):
                runs = [r for r in runs if r["end"] - r["start"] >= cut_words]
                if not runs:
                    continue
                body = texts[k].encode()
                places = [m.span() for m in word.finditer(body.translate(LOWER_BYTES))]
                kept, at = [], 0
                for r in runs:
                    kept.append(body[at : places[r["start"]][0]])
                    at = places[r["end"]][0] if r["end"] < len(places) else len(body)
                texts[k] = (b"".join(kept) + body[at:]).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return hit.drop("n_words", "items").mapInArrow(run, schema)
