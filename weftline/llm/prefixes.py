"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns. All paths are dealt out by range: splitters from a bounded sample cut the sorted order of
(path, conv_id) into shards. The trie of the splitter paths is the skeleton, which is broadcast. A node outside it has all its
members in one shard, so the shard finishes it in one pass over its sorted paths with one open node per depth. For a skeleton node a
shard gives partial aggregates, and these are reduced: sums, smallest member, and the members that end there as chunks of text
in order. So a first turn that everybody uses, or a conversation with very many copies, is spread over shards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import BLANK_WORD, small, stored

#: A rebuilt conversation starts with up to SHARED - 1 turns of the first conversation of its FAMILY.
FAMILY, SHARED = 20, 4
#: Bytes of a turn in a path: digest of role and text, number of words.
STEP = 20
#: A splitter has at most so many turns; there is one splitter a shard, and so many sampled paths per splitter.
SPLITTER_TURNS, SAMPLED = 64, 16
#: Bytes of ids in one chunk.
CHUNK = 32_000
ROW = "kind int, shard int, seq long, depth long, least long, n long, children long, leaves long, saved long, digest string, chunk binary, skeleton int, above int, parent long"
DONE, PARTIAL, ENDS = 0, 1, 2


def turn_paths(rows: DataFrame) -> DataFrame:
    """(conv_id, steps): the turns of every conversation in order, each as hexadecimal digest and number of words."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(BLANK_WORD)).cast("long")), 8, "0")
    turns = rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.concat(digest, words).alias("step")).alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda x: x["step"]).alias("steps"))


def rebuilt(paths: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """(conv_id, path): the first turns of the family's first conversation, then the own turns after as many."""
    firsts = paths.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("first"), F.slice("steps", 1, shared).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    both = paths.join(firsts, F.col("conv_id") - F.col("conv_id") % family == F.col("first"), "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), taken)
    steps = F.concat(head, F.slice("steps", taken + 1, F.size("steps")))
    return both.select("conv_id", F.unhex(F.array_join(steps, "")).alias("path"))


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 cuts of the sorted order, from a bounded sample. They decide who does the work, not the result."""
    rows = paths.count()
    some = paths.sample(False, min(1.0, SAMPLED * shards / max(1, rows)), 7) if rows > SAMPLED * shards else paths
    cut = F.substring("path", 1, SPLITTER_TURNS * STEP).alias("path")
    found = sorted((bytes(r.path), r.conv_id) for r in some.select(cut, "conv_id").limit(4 * SAMPLED * shards).collect())
    return sorted({found[len(found) * k // shards] for k in range(1, shards)}) if found else []


class Skeleton:
    """The trie of the splitter paths; node 0 is the root."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.cuts = cuts
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.words = [-1], [0], [0]
        for path, _ in cuts:
            node = 0
            for k in range(0, len(path), STEP):
                step = path[k : k + STEP]
                if (node, step) not in self.child:
                    self.child[node, step] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                    self.words.append(int.from_bytes(step[16:], "big"))
                node = self.child[node, step]


class _Node:
    """An open node of a shard."""

    __slots__ = ("step", "skeleton", "n", "least", "children", "leaves", "saved", "ends", "held")

    def __init__(self, step: bytes, skeleton: int):
        self.step, self.skeleton = step, skeleton
        self.n = self.children = self.leaves = self.saved = self.held = 0
        self.least: int | None = None
        self.ends = hashlib.sha256() if skeleton < 0 else []

    def end(self, conv_id: int) -> None:
        self.n += 1
        self.least = conv_id if self.least is None else min(self.least, conv_id)
        if self.skeleton < 0:
            self.ends.update((f",{conv_id}" if self.held else str(conv_id)).encode())
            self.held = 1
        else:
            self.ends.append(conv_id)
            self.held += len(str(conv_id)) + 1


def _batches(rows: Iterator[tuple], size: int = 4000) -> Iterator[pa.RecordBatch]:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in ROW.split(", ")]
    pack = lambda held: pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pack(held)
            held = []
    if held:
        yield pack(held)


def _walked(skeleton) -> object:
    """One pass over the sorted paths of the shards of a task: finished nodes after their descendants, partial skeleton nodes,
    and chunks of the ids that end at skeleton nodes."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        child = skeleton.value.child
        stack: list[_Node] = []
        shard, last, seq = -1, None, 0

        def chunk(node: _Node) -> tuple:
            text, node.ends, node.held = ",".join(map(str, node.ends)).encode(), [], 0
            return (ENDS, shard, seq, None, None, None, None, None, None, None, text, node.skeleton, None, None)

        def close() -> Iterator[tuple]:
            nonlocal seq
            node, depth = stack.pop(), len(stack)
            above = stack[-1] if stack else None
            if node.skeleton >= 0:
                if node.ends:
                    seq += 1
                    yield chunk(node)
                seq += 1
                yield (PARTIAL, shard, seq, depth, node.least, node.n, node.children, node.leaves, node.saved, None, None, node.skeleton, None, None)
            else:
                node.leaves = node.leaves or 1
                node.saved += (node.n - 1) * int.from_bytes(node.step[16:], "big")
                seq += 1
                yield (DONE, shard, seq, depth, node.least, node.n, node.children, node.leaves, node.saved, node.ends.hexdigest(), None, None, above.skeleton, None)
                above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
            if above is not None:
                above.n += node.n
                above.least = node.least if above.least is None else min(above.least, node.least)

        for batch in batches:
            for number, path, conv_id in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "conv_id"))):
                if number != shard:
                    while stack:
                        yield from close()
                    shard, last = number, None
                    stack.append(_Node(b"", 0))
                if path != last:
                    same = 0
                    while same + 1 < len(stack) and stack[same + 1].step == path[same * STEP : (same + 1) * STEP]:
                        same += 1
                    while len(stack) > same + 1:
                        yield from close()
                    for k in range(same * STEP, len(path), STEP):
                        step = path[k : k + STEP]
                        stack.append(_Node(step, child.get((stack[-1].skeleton, step), -1)))
                    last = path
                top = stack[-1]
                top.end(conv_id)
                if top.skeleton >= 0 and top.held >= CHUNK:
                    seq += 1
                    yield chunk(top)
        while stack:
            yield from close()

    return lambda batches: _batches(walk(batches))


def _with_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard in reverse: a node comes right before its subtree, so its smallest member is known to its children."""
    least: dict[int, int] = {}
    for batch in batches:
        parent = []
        for kind, depth, own in zip(*(batch.column(c).to_pylist() for c in ("kind", "depth", "least"))):
            parent.append(least.get(depth - 1) if kind == DONE else None)
            if kind != ENDS:
                least[depth] = own
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(parent, pa.int64())], names=batch.schema.names)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the chunks of each skeleton node, which come in order; memory is one digest."""
    node, digest, nodes, digests = None, None, [], []
    for batch in batches:
        for number, chunk in zip(batch.column("skeleton").to_pylist(), batch.column("chunk").to_pylist()):
            if number != node:
                if node is not None:
                    nodes, digests = [*nodes, node], [*digests, digest.hexdigest()]
                node, digest = number, hashlib.sha256(chunk)
            else:
                digest.update(b"," + chunk)
    if node is not None:
        nodes, digests = [*nodes, node], [*digests, digest.hexdigest()]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array(digests, pa.string())], names=["skeleton", "digest"])


def _reduced(skeleton: Skeleton, partial: DataFrame) -> list[tuple]:
    """(skeleton, depth, least, parent, n, children, leaves, saved) of the skeleton nodes, from the sums of their partial rows.

    There are at most SPLITTER_TURNS + 1 nodes a splitter, so this runs in the driver, children before parents.
    """
    total = lambda c: F.sum(c).alias(c)
    sums = partial.groupBy("skeleton").agg(F.min("least").alias("least"), *map(total, ("n", "children", "leaves", "saved")))
    at = {r.skeleton: [r.least, r.n, r.children, r.leaves, r.saved] for r in sums.collect()}
    for node in sorted(at, reverse=True):  # a child has a larger number than its parent
        own = at[node]
        own[3] = own[3] or 1
        own[4] += (own[1] - 1) * skeleton.words[node]
        if node:
            above = at[skeleton.parent[node]]
            above[2], above[3], above[4] = above[2] + 1, above[3] + own[3], above[4] + own[4]
    up = lambda k: at[skeleton.parent[k]][0] if k else None
    return [(k, skeleton.depth[k], x[0], up(k), *x[1:]) for k, x in at.items()]


def prefix_trie(rows: DataFrame, family: int = FAMILY, shared: int = SHARED, shards: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Needs conv_id, turn, role and text. Null role or text is empty, a null turn comes first, equal turns of a conversation come
    in the order of their digest (md5 of the role's length, a colon, role and text), and repeated rows are turns of their own.
    Rows without conv_id take no part. A conversation is held as one row of 20 bytes a turn, texts of any length are only
    digests. An empty table gives no rows, not even a root. Other columns are not looked at.
    """
    spark = rows.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = stored(rebuilt(turn_paths(rows), family, shared))
    local = Skeleton(splitters(paths, shards))
    skeleton = spark.sparkContext.broadcast(local)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = skeleton.value.cuts
        for batch in batches:
            number = [bisect_right(cuts, x) for x in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("path"), pa.array(number, pa.int32())], names=["conv_id", "path", "shard"])

    dealt = paths.mapInArrow(deal, "conv_id long, path binary, shard int")
    local_order = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    walked = local_order.mapInArrow(_walked(skeleton), ROW).sortWithinPartitions("shard", F.desc("seq"))
    nodes = stored(walked.mapInArrow(_with_parents, ROW))

    sums = _reduced(local, nodes.filter(F.col("kind") == PARTIAL))
    names = "skeleton int, depth long, least long, parent long, n long, children long, leaves long, saved long"
    tops = stored(spark.createDataFrame(sums, names))
    chunks = nodes.filter(F.col("kind") == ENDS).select("skeleton", "shard", "seq", "chunk")
    ends = chunks.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "seq").mapInArrow(_ends, "skeleton int, digest string")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    out = ["least", "depth", "parent", "n", "children", "leaves", "saved", "digest"]
    top = tops.join(ends, "skeleton", "left").withColumn("digest", F.coalesce("digest", nothing)).select(*out)
    over = tops.select(F.col("skeleton").alias("above"), F.col("least").alias("over"))
    done = nodes.filter(F.col("kind") == DONE).join(small(over), "above", "left").withColumn("parent", F.when(F.col("above") >= 0, F.col("over")).otherwise(F.col("parent"))).select(*out)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return done.unionByName(top).withColumnsRenamed(dict(zip(out, names)))
