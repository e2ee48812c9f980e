"""Exact self-join of shingle sets by Jaccard similarity, and its connected components.

A document's set holds the distinct windows of five lower-cased words. Sets are compared through an inverted index over
set prefixes: in any order of the shingles, two sets with similarity of at least 0.8 share a shingle among the first fifth
(and one) of each. The order is by a sketched document frequency, rare first, so long index lists hardly occur; the
sketch has a fixed size and decides speed only.

Relations between sets save work on two levels. In a list, members are blocked by set size, and their positions
bound the overlap, so blocks and pairs that cannot reach the threshold are skipped. Across lists, equal sets share one
set of answers; then every member of a list is compared with the list's first set alone. The answers of members that are similar
to one first set are derived from their differences to it: the counts of these decide about most pairs, and the pairs that they
leave open are found and verified by the shingles by which both differ. Members without a first set in common are compared with each other. So copies never become pairs, and
no link is lost. Where only classes are asked for, members of one component are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import LOWER_BYTES, components, forget, mixed, stored, utf8, window_hashes, word_hashes

WORDS = 5
#: Counters of the frequency sketch, and how many of them one row carries.
SKETCH, SKETCH_BLOCK = 1 << 20, 1 << 16


def shingles(body: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a UTF-8 text; all words as one shingle if there are fewer than ``words``."""
    hashes, _, _ = word_hashes(body.translate(LOWER_BYTES))
    if len(hashes) == 0:
        return hashes
    if len(hashes) < words:
        return mixed(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, words))


def _bodies(batch: pa.RecordBatch, name: str = "body") -> Iterator[bytes]:
    return (x.as_py() or b"" for x in batch.column(name))


def _sketched(docs: DataFrame) -> np.ndarray:
    """Counters of shingle hashes: summed per task, then per block of counters; their number is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SKETCH, np.int64)
        for batch in batches:
            slots = [(shingles(body) & np.uint64(SKETCH - 1)).astype(np.int64) for body in _bodies(batch)]
            if slots:
                counters += np.bincount(np.concatenate(slots), minlength=SKETCH)
        blocks = counters.reshape(-1, SKETCH_BLOCK).astype(np.uint32)
        if counters.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts.as_py(), np.uint32).astype(np.uint64)
        packed = [np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])

    schema = "block int, counts binary"
    rows = docs.select("body").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    order = np.zeros((SKETCH // SKETCH_BLOCK, SKETCH_BLOCK), np.uint32)
    for r in rows:
        order[r.block] = np.frombuffer(r.counts, np.uint32)
    return order.reshape(-1)


def _sets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n, sig_a, sig_b (equal sets have equal ones) and the prefix, rare shingles first."""
    sketch = docs.sparkSession.sparkContext.broadcast(_sketched(docs))
    schema = "doc_id long, n long, sig_a long, sig_b long, prefix array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = sketch.value
        for batch in batches:
            n, a, b, prefixes = [], [], [], []
            for body in _bodies(batch):
                s = shingles(body)
                first = s[np.argsort(frequency[s & np.uint64(SKETCH - 1)], kind="stable")[: len(s) - (4 * len(s) + 4) // 5 + 1]]
                n.append(len(s))
                a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                b.append(int(mixed(s).sum(dtype=np.uint64).view(np.int64)))
                prefixes.append(first.view(np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig_a", "sig_b", "prefix"])

    return docs.mapInArrow(run, schema)


def _similar(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, common, n_a, n_b) of the (a, b) pairs whose whole sets are similar, counted exactly."""
    full = docs.select("doc_id", "body")
    left = pairs.join(full.withColumnsRenamed({"doc_id": "a", "body": "body_a"}), "a")
    both = left.join(full.withColumnsRenamed({"doc_id": "b", "body": "body_b"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, counts = [], []
            for x, y in zip(_bodies(batch, "body_a"), _bodies(batch, "body_b")):
                s, t = shingles(x), shingles(y)
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= 80 * (len(s) + len(t) - common) and common > 0)
                counts.append((common, len(s), len(t)))
            sizes = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            whole = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *sizes], names=["a", "b", "common", "n_a", "n_b"])
            yield whole.filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long, common long, n_a long, n_b long")


def _possible(x: str, y: str):
    """Sizes and positions allow the threshold, if the shared shingle is the first one that both prefixes hold."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * most >= 4 * (n + m))


def _crossing(rows: DataFrame) -> DataFrame:
    """(a, b) of the members of one list that have different labels c, in neighbouring size blocks, if sizes and positions allow
    the threshold."""
    x = rows.select("shingle", "block", F.col("m").alias("x"), F.col("c").alias("cx"))
    y = rows.select("shingle", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), F.col("m").alias("y"), F.col("c").alias("cy"))
    both = x.join(y, ["shingle", "block"]).filter((F.col("cx") < F.col("cy")) & _possible("x", "y"))
    return both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _differences(led: DataFrame, bodies: DataFrame) -> DataFrame:
    """The members (p, node, n, common, n_p, need) with d, the shingles that only one of the member and its first set p holds, those of the
    fewest members of p in front, and ``times``, the number of members of p that differ from it by each of them."""
    full = bodies.select("doc_id", "body")
    left = led.join(full.withColumnsRenamed({"doc_id": "p", "body": "body_a"}), "p")
    both = left.join(full.withColumnsRenamed({"doc_id": "node", "body": "body_b"}), "node")
    names = ["p", "node", "n", "common", "n_p", "need"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, apart = [], []
            for n, common, n_p, x, y in zip(*[batch.column(c).to_pylist() for c in ("n", "common", "n_p")], _bodies(batch, "body_a"), _bodies(batch, "body_b")):
                s, t = shingles(x), shingles(y)
                d = np.setxor1d(s, t, assume_unique=True)
                keep.append(len(s) == n_p and len(t) == n and len(d) == n + n_p - 2 * common)
                apart.append(d.view(np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(d) for d in apart]))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(apart) if apart else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], names=[*names, "d"]).filter(pa.array(keep, pa.bool_()))

    schema = ", ".join(f"{c} long" for c in names) + ", d array<long>"
    found = stored(both.select(*names, "body_a", "body_b").mapInArrow(run, schema).dropDuplicates(["p", "node"]))
    each = found.select(*names, F.explode("d").alias("shingle"))
    held = each.groupBy("p", "shingle").agg(F.count(F.lit(1)).alias("times"))
    ordered = each.join(held, ["p", "shingle"]).groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("d"))
    ranked = stored(ordered.select(*names, F.col("d.shingle").alias("d"), F.col("d.times").alias("times")))
    forget(found)
    return ranked


def _derived(led: DataFrame, bodies: DataFrame) -> DataFrame:
    """(node, links) of the members (p, node, n, common, n_p) of each first set p among themselves, from their computed answers to p.

    What two members share is known from their differences to p: common + common' - n_p shingles, and those by which both differ from p. So
    the counts alone decide about most pairs, and these are counted by kind (members of equal counts) without being listed. Where they leave it open,
    both members must differ from p by at least ``need`` of the same shingles: such pairs meet through an index over prefixes of the
    differences, rare ones first, with positions bounding the overlap, and are verified by their differences, without their texts.
    """
    kinds = led.groupBy("p", "n_p", "n", "common").agg(F.count(F.lit(1)).alias("size"))
    other = kinds.select("p", *[F.col(c).alias(f"{c}_") for c in ("n", "common", "size")])
    least = F.col("common") + F.col("common_") - F.col("n_p")
    most = F.least("common", "common_") + F.least(F.col("n") - F.col("common"), F.col("n_") - F.col("common_"))
    missing = lambda c: 4 * (F.col("n") + F.col("n_")) - 9 * c  # noqa: E731 - ninths of a shingle that an overlap of c lacks
    pairs = stored(kinds.join(other, "p").withColumns({"sure": missing(least) <= 0, "need": F.ceil(missing(least) / 9)}).filter(missing(most) <= 0))
    same = (F.col("n") == F.col("n_")) & (F.col("common") == F.col("common_"))
    sure = pairs.filter("sure").groupBy("p", "n", "common").agg(F.sum(F.col("size_") - same.cast("long")).alias("links"))
    counted = led.join(sure, ["p", "n", "common"]).select("node", "links")
    needs = pairs.filter("NOT sure").groupBy("p", "n", "common").agg(F.min("need").alias("need"))
    members = _differences(led.join(needs, ["p", "n", "common"]), bodies)
    front = members.select("p", "node", "n", "common", "n_p", F.size("d").alias("long"), F.posexplode(F.expr("slice(arrays_zip(d, times), 1, cast(size(d) - need + 1 as int))")).alias("pos", "s"))
    front = front.filter("s.times > 1").select("p", F.col("s.d").alias("shingle"), "node", "n", "common", "n_p", (F.col("long") - F.col("pos")).alias("rest"))
    y = front.select("p", "shingle", *[F.col(c).alias(f"{c}_") for c in ("node", "n", "common", "rest")])
    met = front.join(y, ["p", "shingle"]).filter((F.col("node") < F.col("node_")) & (missing(least) > 0) & (missing(least + F.least("rest", "rest_")) <= 0))
    met = stored(met.select("node", "node_", "n", "n_", least.alias("least")).distinct())
    both = met.join(members.select("node", "d"), "node").join(members.select(F.col("node").alias("node_"), F.col("d").alias("d_")), "node_")
    found = stored(both.filter(missing(F.col("least") + F.size(F.array_intersect("d", "d_"))) <= 0).select(F.col("node").alias("a"), F.col("node_").alias("b")))
    forget(members, met)
    return counted.unionByName(_ends(found))


def _ends(links: DataFrame) -> DataFrame:
    """(node, links) with a row of 1 for both ends of every link."""
    return links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("links"))


def similarity_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of the documents, see ``_found``; the classes also have n_links."""
    return _found(docs, True)[:2]


def _found(docs: DataFrame, counted: bool = False) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(classes, links, the stored tables that they read): classes is one row per row of ``docs`` with doc_id, n_shingles, component_id; links are
    verified (a, b) pairs between set representatives, enough to connect every class.

    With ``counted``, classes also have n_links, the number of other sets that the row's set is similar to; no link is left out.
    Needs doc_id (long) and text. Null and empty texts have an empty set and are linked with nothing. Rows that share a
    doc_id are one document, whose sets' links count together. Rows without doc_id are linked with nothing and get a null component. An empty table gives
    no rows.
    """
    docs = docs.select("doc_id", utf8(F.col("text")).alias("body"))
    whole = stored(_sets(docs))
    sets = stored(whole.select("doc_id", "n", "sig_a", "sig_b"))
    named = sets.filter("n > 0 AND doc_id IS NOT NULL")
    same = stored(named.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("node")))
    reps = stored(whole.filter("n > 0").join(same, ["n", "sig_a", "sig_b"]).filter("doc_id = node").select("node", "n", "prefix"))
    forget(whole)
    postings = reps.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    # Most shingles are in one set's prefix: the lists of several are found first, and only their rows are written.
    lists = stored(postings.groupBy("shingle").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("shingle", "lo"))
    rows = stored(postings.join(lists, "shingle"))
    forget(reps, lists)
    firsts = rows.filter("node = lo").groupBy("shingle").agg(F.min(F.struct("node", "n", "pos")).alias("p"))
    shared = stored(rows.join(firsts, "shingle").select("shingle", F.struct("node", "n", "pos").alias("m"), "p"))
    forget(rows)
    near = shared.filter("m.node > p.node").filter(_possible("p", "m"))
    first = stored(near.select(F.col("p.node").alias("a"), F.col("m.node").alias("b")).distinct())
    candidates = shared.select(F.col("m.node").alias("doc_id")).distinct()
    bodies = stored(docs.join(candidates, "doc_id", "left_semi"))
    links = stored(_similar(first, bodies))

    # Members of a list meet unless one set's answers cover both: as to their component, or, to count links, as to the first set that both
    # are similar to.
    leader = stored(links.groupBy(F.col("b").alias("node")).agg(F.min(F.struct("a", "common", "n_b", "n_a")).alias("l")).select("node", F.col("l.a").alias("component"), F.col("l.common").alias("common"), F.col("l.n_b").alias("n"), F.col("l.n_a").alias("n_p")))
    label = leader.select("node", "component") if counted else components(links)
    labelled = stored(
        shared.select("shingle", "m", F.col("m.node").alias("node"))
        .join(label, "node", "left")
        .select("shingle", "m", F.coalesce("component", "node").alias("c"), F.floor(F.log(F.col("m.n").cast("double")) / F.log(F.lit(1.25))).alias("block"))
    )
    forget(shared)
    mixed_lists = labelled.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("shingle")
    open_rows = stored(labelled.join(mixed_lists, "shingle"))
    forget(labelled)
    pairs = _crossing(open_rows)
    second = stored(pairs.join(first, ["a", "b"], "left_anti"))
    more = stored(_similar(second, bodies))
    tables = [links, more]
    if counted:
        led = leader.withColumnRenamed("component", "p")
        ends = [leader.select(F.col("node").alias(c), F.col("component").alias(f"l_{c}")) for c in ("a", "b")]
        apart = links.join(ends[0], "a", "left").join(ends[1], "b", "left").filter(F.col("l_a").isNull() | F.col("l_b").isNull() | (F.col("l_a") != F.col("l_b")))
        each = _derived(led, bodies).unionByName(_ends(apart)).unionByName(_ends(more))
        number = stored(each.groupBy("node").agg(F.sum("links").alias("n_links")))
        tables.append(number)
    forget(first, second, open_rows, bodies, leader)
    links = links.unionByName(more)
    label = components(links)

    # A component is named by its smallest document; a representative is the smallest document of its set.
    classes = same.join(label, "node", "left")
    if counted:
        classes = classes.join(number, "node", "left")
    extra = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if counted else []
    classes = classes.select("n", "sig_a", "sig_b", F.coalesce("component", "node").alias("component_id"), *extra)
    of_rows = sets.select("doc_id", "n", "sig_a", "sig_b").join(classes, ["n", "sig_a", "sig_b"], "left")
    alone = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    extra = [F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")] if counted else []
    return of_rows.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"), *extra), links, [sets, same, label, *tables]


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose class has a smaller document; texts without words are classes of their own.

    Rows that repeat an id and a text, also without id, stay once (whichever of them, if other columns differ); rows that share
    an id and differ in text are kept or go together. An empty table stays empty. Other columns pass through, whatever their names.
    """
    key = {"__key": F.xxhash64("doc_id", "text"), "__check": F.hash("doc_id", "text")}
    classes, _, tables = _found(docs)
    gone = stored(classes.filter("component_id < doc_id").select("doc_id").distinct())
    forget(*tables)
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    again = stored(docs.select("doc_id", "text").withColumns(key).groupBy(*key).count().filter("count > 1").select(*key))
    if not again.limit(1).count():
        return kept
    keyed = kept.withColumns(key)
    once = keyed.join(again, [*key], "left_semi").dropDuplicates([*key])
    return keyed.join(again, [*key], "left_anti").unionByName(once).select(docs.columns)
