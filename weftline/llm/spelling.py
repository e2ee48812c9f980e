"""Spelling variants by a relational trie frontier.

The words of the corpus make a trie whose edges are a distributed table (node, labels); a node is named by its prefix. States (word,
node, shift) walk it level by level: a state of a level is joined with the edges of its node and becomes the states of the next one.
``shift`` says how far the place in the word is ahead of the node's depth, so a deleted letter is a shift of one. A state that has
spent its edit and reached the end of its word names the neighbour.

Two things keep the frontier narrow. An edit in the second half of a word leaves its first half as it is, and one in the first half
leaves the second as it is, so each word walks two tries, of the words and of the reversed words, and may be edited in the second half
of its way only. And being near is symmetric: a replaced letter is found from the word with the smaller letter, an inserted one
from the longer word.

Words of more than ``LEVELS`` letters do not walk. They are compared through a hash of the word without each of its letters,
which is as exact and needs no levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import forget, lowered, stored
from weftline.session import scratch_path

LETTERS = r"[A-Za-zÀ-ÿ]"
#: A run whose hash this number divides loses a letter.
TYPO = 31
MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
#: Longest word that walks the trie.
LEVELS = 64
#: Modulus and base of the polynomial hash over letters.
PRIME, BASE = (1 << 61) - 1, 911382323


def words(docs: DataFrame, typo: int = TYPO, letters: int = MIN_LETTERS, least: int = MIN_COUNT) -> DataFrame:
    """(word, n): the runs of letters after the deletions, with their number, if long and frequent enough."""
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({LETTERS}{{{letters},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run")).select("id", lowered(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % typo == 0, cut).otherwise(F.col("run"))
    kept = runs.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= letters)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _letter(word: str, place) -> F.Column:
    """The letter at a place from 0; empty after the end."""
    return F.substr(word, F.lit(place + 1) if isinstance(place, int) else place + 1, F.lit(1))


def edges(turned: DataFrame, lowest: int) -> str:
    """Write the trie's edges: (depth, node, labels) for nodes of at least ``lowest`` letters, a folder for each depth."""
    path = scratch_path(turned.sparkSession, "trie")
    place = F.explode(F.sequence(F.lit(lowest), F.length("word") - 1)).alias("depth")
    steps = turned.select("word", place).select("depth", F.substr("word", F.lit(1), F.col("depth")).alias("node"), F.substr("word", F.col("depth") + 1, F.lit(1)).alias("label"))
    steps.groupBy("depth", "node").agg(F.collect_set("label").alias("labels")).write.partitionBy("depth").parquet(path)
    return path


def frontier(table: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(word, other): pairs of words in the trie that are one edit apart, ``other`` having the larger letter or fewer letters; and
    the stored levels, to be forgotten once the pairs are used.

    Candidates are verified by the caller's join with the words: a state at the end of its word names a node, which need not be
    a word. A word stands with a sign in front that tells its direction, so both tries are one table.
    """
    spark = table.sparkSession
    both = F.explode(F.array(F.concat(F.lit(">"), "word"), F.concat(F.lit("<"), F.reverse("word")))).alias("word")
    turned = table.select(both)
    size = F.length("word") - 1
    # Depths count the sign: the letter at place p of a word is at place p + 1 of the turned word.
    start = F.when(F.col("word").startswith(">"), F.floor(size / 2)).otherwise(F.ceil(size / 2)) + 1
    turned = stored(turned.withColumn("start", start.cast("int")))
    low, high = turned.agg(F.min("start"), F.max(F.length("word"))).first()
    if low is None:
        return table.select("word", F.col("word").alias("other")).limit(0), []
    trie = spark.read.schema("node string, labels array<string>, depth int").parquet(edges(turned, low))

    levels: list[DataFrame] = []
    for depth in range(low, high):
        seeds = turned.filter((F.col("start") <= depth) & (F.length("word") > depth))
        seeds = seeds.select("word", F.substr("word", F.lit(1), F.lit(depth)).alias("node"), F.lit(-1).alias("shift"))
        alive = seeds.unionByName(levels[-1].filter(F.length("word") > depth + F.col("shift"))) if levels else seeds
        at = alive.join(trie.filter(F.col("depth") == depth), "node")
        here, after = _letter("word", depth), _letter("word", depth + 1)
        want = _letter("word", depth + F.col("shift"))
        step = lambda label, shift: F.struct(F.concat("node", label).alias("node"), F.lit(shift).cast("int").alias("shift"))
        replaced = F.transform(F.filter("labels", lambda x: x > here), lambda x: step(x, 0))
        # The last letter of a run of equal ones stands for all of them.
        gone = F.when((after != here) & F.array_contains("labels", after), F.array(step(after, 1)))
        matched = F.when(F.array_contains("labels", want), F.array(F.struct(F.concat("node", want).alias("node"), F.col("shift").cast("int").alias("shift"))))
        none = F.filter(replaced, lambda x: F.lit(False))
        to = F.when(F.col("shift") < 0, F.concat(replaced, F.coalesce(gone, none))).otherwise(F.coalesce(matched, none))
        levels.append(stored(at.select("word", F.explode(to).alias("to")).select("word", "to.node", "to.shift")))
    # The last letter deleted: the node is there at once.
    found = turned.select("word", F.substr("word", F.lit(1), F.length("word") - 1).alias("other"))
    for depth, level in enumerate(levels, low + 1):
        found = found.unionByName(level.filter(F.length("word") == depth + F.col("shift")).select("word", F.col("node").alias("other")))
    back = lambda c: F.when(F.col(c).startswith(">"), F.substr(c, F.lit(2))).otherwise(F.reverse(F.substr(c, F.lit(2)))).alias(c)
    return found.select(back("word"), back("other")).distinct(), [turned, *levels]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word the hash of the whole (place -1) and of the word without each of its letters."""
    for batch in batches:
        for word in batch.column("word").to_pylist():
            codes = [ord(c) + 1 for c in word]
            after, power = [0] * (len(codes) + 1), 1
            for i in range(len(codes) - 1, -1, -1):
                after[i], power = (after[i + 1] + codes[i] * power) % PRIME, power * BASE % PRIME
            keys, before, power = [after[0]], 0, pow(BASE, len(codes) - 1, PRIME)
            inverse = pow(BASE, -1, PRIME)
            for i, c in enumerate(codes):
                keys.append((before * power + after[i + 1]) % PRIME)
                before, power = (before * BASE + c) % PRIME, power * inverse % PRIME
            place = list(range(-1, len(codes)))
            size = [len(codes)] + [len(codes) - 1] * len(codes)
            for k in range(0, len(keys), 50_000):
                part = slice(k, k + 50_000)
                columns = [pa.array([word] * len(keys[part])), pa.array(keys[part], pa.int64()), pa.array(size[part], pa.int32()), pa.array(place[part], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "key", "size", "place"])


def long_pairs(table: DataFrame, longest: int = LEVELS) -> DataFrame:
    """(word, other): pairs of which ``word`` has more than ``longest`` letters, by their hashes and then verified."""
    tail = table.filter(F.length("word") >= longest).select("word")
    keys = tail.repartition("word").mapInArrow(_hashed, "word string, key long, size int, place int")
    ours = stored(keys.filter((F.length("word") > longest) | (F.col("place") < 0)))
    cut = ours.filter("place >= 0")
    other = lambda df: df.withColumnRenamed("word", "other")
    shorter = cut.drop("place").join(other(ours.filter("place < 0")).drop("place"), ["key", "size"])
    replaced = cut.join(other(cut), ["key", "size", "place"]).filter(F.col("word") < F.col("other"))
    pairs = shorter.select("word", "other").unionByName(replaced.select("word", "other")).distinct()
    return pairs.filter(F.levenshtein("word", "other", 1) == 1)


def near_words(table: DataFrame, longest: int = LEVELS) -> DataFrame:
    """(word, other, other_n) for every ordered pair of words that are one inserted, deleted or replaced letter apart."""
    walked, levels = frontier(table.filter(F.length("word") <= longest))
    found = walked.join(table.select(F.col("word").alias("other")), "other", "left_semi").unionByName(long_pairs(table, longest))
    links = stored(found.select("word", "other").unionByName(found.select(F.col("other").alias("word"), F.col("word").alias("other"))))
    forget(*levels)
    return links.join(table.withColumnsRenamed({"word": "other", "n": "other_n"}), "other")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words with a form. A form is more frequent by a factor, so there are no cycles; each round doubles
    the way that is looked ahead."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        next_at = stored(at.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(at)
        at = next_at.drop("moved")
        if not next_at.filter("moved").limit(1).count():
            return at


def variants(docs: DataFrame, ratio: int = RATIO, longest: int = LEVELS) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Needs doc_id and text. Null texts have no runs, a null id counts as an empty text in the hash, and repeated rows count each time.
    ``form`` is the most frequent near word (the smallest in code point order of equally frequent ones), if it is at least ``ratio``
    times as frequent. Texts and words of any length are taken whole. An empty table gives no rows; other columns are not looked at.
    """
    table = stored(words(docs))
    near = near_words(table, longest).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    joined = table.join(near, "word", "left")
    chosen = -F.col("best.n") >= ratio * F.col("n")
    rows = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, -F.col("best.n")).alias("form_n")))
    ends = roots(rows.filter("form IS NOT NULL"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
