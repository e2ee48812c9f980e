"""Line dedup by pairwise alignment: partners share blocks or rare lines, patience diff aligns them, and the later document
loses the aligned common blocks.

Only blocks of ``BLOCK_WORDS`` words count, so the anchors of patience diff are the shortest runs of lines with so many words that
are unique in both documents. Matches grow to equal neighbouring lines, however often these occur, and the gaps between them are
searched again, where more runs are unique; what the earlier document holds in another order, or less often, is found by one more pass
over the runs. So the work on a pair grows with its lines.

A later document is compared with the first holder of each of its shortest runs, and of each of its rare lines. Every line of a
block that any earlier document holds is in such a run, and the run's first holder has it whole, so one partner a line or run is enough, however many documents share it. A document has at most
three times as many partners as lines; whichever copy of a passage is not the first is removed against the first.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import LOWER_BYTES, beside, forget, stored, utf8

#: Only blocks of at least this many words are removed.
BLOCK_WORDS = 20
#: A line of fewer words is rare unless more texts than both hold it: a number, and a share of all texts. Such lines beyond find no
#: partners, but take part in every alignment; their blocks are found through runs, which have no limit.
RARE_DOCS, RARE_SHARE = 1_000, 0.5
KEY = ["doc_id", "digest", "check"]
LINES = "array<struct<number:int,key:long,words:int>>"
MARKS = "array<struct<key:long,words:int,places:array<int>>>"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with digest and check: together 96 bits that tell texts apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"digest": F.xxhash64(text), "check": F.hash(text)})


def block_runs(words: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of several lines with ``BLOCK_WORDS`` words, from each line on and up to each line."""
    total = [0, *accumulate(words)]
    runs = set()
    for i, before in enumerate(total):
        runs.add((i, bisect_left(total, before + BLOCK_WORDS)))
        runs.add((bisect_right(total, before - BLOCK_WORDS) - 1, i))
    return sorted((i, j) for i, j in runs if i >= 0 and j <= len(words) and j - i > 1)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines with words: line number, key (hash of its lower-cased words), words; and as marks the different lines with all
    their places, and the different runs of lines with the hash of their keys as key, without words and places."""
    for batch in batches:
        rows, marks = [], []
        for body in batch.column("body"):
            lines, places = [], defaultdict(list)
            for number, line in enumerate(body.as_py().translate(LOWER_BYTES).split(b"\n")):
                if words := line.split():
                    key = xxhash.xxh64_intdigest(b" ".join(words))
                    lines.append({"number": number, "key": key - (key >> 63 << 64), "words": len(words)})
                    places[lines[-1]["key"], len(words)].append(len(lines) - 1)
            rows.append(lines)
            keys = array("q", [x["key"] for x in lines])
            hashes = {xxhash.xxh64_intdigest(keys[i:j].tobytes()) for i, j in block_runs([x["words"] for x in lines])}
            each = [{"key": key, "words": words, "places": at} for (key, words), at in places.items()]
            marks.append(each + [{"key": h - (h >> 63 << 64), "words": 0, "places": []} for h in hashes])
        line = pa.struct([("number", pa.int32()), ("key", pa.int64()), ("words", pa.int32())])
        mark = pa.struct([("key", pa.int64()), ("words", pa.int32()), ("places", pa.list_(pa.int32()))])
        columns = [*(batch.column(c) for c in KEY), pa.array(rows, pa.list_(line)), pa.array(marks, pa.list_(mark))]
        yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "lines", "marks"])


def aligned(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest series of (place here, place there) that rises on both sides; ``pairs`` come in order of the first."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, there) in enumerate(pairs):
        pile = bisect_left(tops, there)
        if pile == len(tops):
            tops.append(there)
            at.append(i)
        else:
            tops[pile], at[pile] = there, i
        back.append(at[pile - 1] if pile else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _runs(at: dict[int, int], words: list[int], low: int, high: int, done: set[int]) -> dict[tuple[int, ...], list[int]]:
    """The shortest runs with ``BLOCK_WORDS`` words between two places that are not done as a whole: their lines, and where they start."""
    out = defaultdict(set)
    for side, step in ((range(low, high), 1), (range(high - 1, low - 1, -1), -1)):
        for i in side:
            run, size, j, new = [], 0, i, False
            while size < BLOCK_WORDS and low <= j < high and (line := at.get(j)) is not None:
                run.append(line)
                size += words[line]
                new |= j not in done
                j += step
            if size >= BLOCK_WORDS and new:
                out[tuple(run[::step])].add(min(i, j - step))
    return {run: sorted(x) for run, x in out.items()}


def matched(here: dict[int, int], there: dict[int, int], words: list[int]) -> list[tuple[int, int]]:
    """Pairs of places that patience diff aligns, in no order, by runs that are unique in both documents; the documents are given
    as the line at each place that both share, ``words`` has the size of each line. A gap without such runs is left."""
    out: list[tuple[int, int]] = []
    gaps = [(-1, max(here, default=-1) + 1, -1, max(there, default=-1) + 1)]
    while gaps:
        low, high, low_there, high_there = gaps.pop()
        ours = _runs(here, words, low + 1, high, set())
        theirs = _runs(there, words, low_there + 1, high_there, set()) if ours else {}
        anchors = [(x[0], y[0]) for run, x in ours.items() if len(x) == 1 and len(y := theirs.get(run, ())) == 1]
        if not anchors:
            continue
        for x, y in aligned(sorted(anchors)):
            if x <= low or y <= low_there:
                continue
            first, first_there = x, y
            while first - 1 > low and first_there - 1 > low_there and first - 1 in here and here[first - 1] == there.get(first_there - 1):
                first, first_there = first - 1, first_there - 1
            gaps.append((low, first, low_there, first_there))
            while x + 1 < high and y + 1 < high_there and x + 1 in here and here[x + 1] == there.get(y + 1):
                x, y = x + 1, y + 1
            out += zip(range(first, x + 1), range(first_there, y + 1))
            low, low_there = x, y
        gaps.append((low, high, low_there, high_there))
    return out


def blocks(here: dict[int, int], there: dict[int, int], words: list[int]) -> list[int]:
    """Places here of all lines in blocks of enough words that both documents hold: those that the alignment finds, and in one
    more pass over the shortest runs those that come in another order or more often than there."""
    done: set[int] = set()
    run: list[tuple[int, int]] = []
    for x, y in [*sorted(matched(here, there, words)), (-1, -1)]:
        if run and (x, y) != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(words[here[i]] for i, _ in run) >= BLOCK_WORDS:
                done |= {i for i, _ in run}
            run = []
        run.append((x, y))
    if left := _runs(here, words, 0, max(here, default=-1) + 1, done):
        known = _runs(there, words, 0, max(there, default=-1) + 1, set())
        done |= {place + k for run, places in left.items() if run in known for place in places for k in range(len(run))}
    return sorted(done)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of documents: places of the lines in aligned blocks of enough words."""
    for batch in batches:
        gone = []
        for shared in batch.column("shared").to_pylist():
            here, there = ({x: k for k, s in enumerate(shared) for x in s[side]} for side in ("here", "there"))
            gone.append(blocks(here, there, [s["words"] for s in shared]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), pa.array(gone, pa.list_(pa.int32()))], names=[*KEY, "places"])


def common_blocks(docs: DataFrame) -> DataFrame:
    """The blocks of every row, see ``_found``."""
    return _found(docs)[0]


def _found(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(rows, the stored tables that they read). One row per row of ``docs``: doc_id, digest, check, n_lines, n_words, n_removed_lines, n_removed_words, removed.

    ``removed`` are line numbers from 0, lines without words included in the count but never removed. Lines are equal when their
    lower-cased words are. Later means a larger doc_id. A text that stands in a smaller document as it is goes wholly, if
    it has ``BLOCK_WORDS`` words. Blocks are runs of lines that a partner holds as they are, wherever they stand in it. Null texts are empty. Rows that share a doc_id are not compared, and rows without doc_id
    neither lose nor cost lines. An empty table gives no rows.
    """
    rows = keyed(docs.select("doc_id", "text")).select(*KEY, utf8(F.col("text")).alias("body"))
    texts = stored(rows.mapInArrow(_split, f"doc_id long, digest long, check int, lines {LINES}, marks {MARKS}"))
    named = texts.filter("doc_id IS NOT NULL")
    first = stored(named.groupBy("digest", "check").agg(F.min("doc_id").alias("first")))
    single = named.join(first, ["digest", "check"]).filter("doc_id = first").dropDuplicates(KEY)
    marks = stored(single.select(*KEY, F.explode("marks").alias("mark")).select(*KEY, "mark.key", "mark.words", "mark.places"))
    lines = marks.filter("words > 0")
    rare = max(RARE_DOCS, int(RARE_SHARE * first.count()))
    holder = F.min(F.struct(*KEY)).alias("holder")
    short = F.max("words").between(1, BLOCK_WORDS - 1).alias("short")
    held = marks.groupBy("key").agg(holder, F.count(F.lit(1)).alias("docs"), short).filter((F.col("docs") > 1) & (~F.col("short") | (F.col("docs") <= rare)))
    held = stored(held.select("key", "holder"))  # on its own, so that a key that very many texts hold can be split in the join
    partner = [F.col(f"holder.{c}").alias(f"of_{c}") for c in KEY]
    pairs = stored(marks.join(held, "key").filter("holder.doc_id < doc_id").select(*KEY, *partner).distinct())
    there = lines.select(*[F.col(c).alias(f"of_{c}") for c in KEY], "key", F.col("places").alias("there"))
    shared = pairs.join(lines, KEY).join(there, [*(f"of_{c}" for c in KEY), "key"])
    each = shared.groupBy(*KEY, *(f"of_{c}" for c in KEY)).agg(F.collect_list(F.struct(F.col("places").alias("here"), "there", "words")).alias("shared"))
    gone = each.select(*KEY, "shared").mapInArrow(_common, "doc_id long, digest long, check int, places array<int>")
    gone = stored(gone.groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")).filter(F.size("places") > 0))
    forget(pairs, marks, held)

    total = lambda of: F.aggregate(of, F.lit(0).cast("long"), lambda a, x: a + x["words"])
    out = texts.join(first, ["digest", "check"], "left").join(gone, KEY, "left").withColumn("n_words", total("lines"))
    copy = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= BLOCK_WORDS)
    some = F.filter("lines", lambda x, i: F.array_contains("places", i))
    lost = F.when(copy, F.col("lines")).when(F.col("places").isNotNull(), some).otherwise(F.slice("lines", 1, 0))
    rows = out.withColumn("lost", lost).select(
        *KEY,
        F.size("lines").cast("long").alias("n_lines"),
        "n_words",
        F.size("lost").cast("long").alias("n_removed_lines"),
        total("lost").alias("n_removed_words"),
        F.transform("lost", lambda x: x["number"]).alias("removed"),
    )
    return rows, [texts, first, gone]


@beside("doc_id", "text")
def without_common_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; documents of which nothing is left go, texts without a hit stay as
    they are. Documents that had no words to begin with stay."""
    rows, tables = _found(docs)
    found = stored(rows.filter("n_removed_lines > 0").select(*KEY, "removed", (F.col("n_removed_lines") == F.col("n_lines")).alias("empty")).dropDuplicates(KEY))
    forget(*tables)
    joined = keyed(docs).join(found, KEY, "left").filter("empty IS NULL OR NOT empty")
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("removed", i)), "\n")
    return joined.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept)).select(docs.columns)
