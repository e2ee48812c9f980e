"""Exact top-k search by inner product with the three-phase uniform threshold.

The components of the vectors are split into groups; each group gives every vector a local score, and a score is the sum of the
local ones. Phase one gathers, per query and group, the list of the highest local scores and the least one, and the exact scores of
the vectors in these lists: the k-th of them is a score that the answer reaches. Phase two broadcasts the cutoff that follows
from it, the same distance above the least local score for every group, and collects the local scores that reach it; a vector that
reaches it in no group cannot be in the answer. Bounds on what was not collected leave few vectors, and phase three resolves
their scores exactly.

Queries pass in blocks of a bounded size; vectors never move in phases one and two. Equal vectors take part once, with their
smallest ids, so copies neither meet in one task nor multiply what is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weftline.llm.common import forget, stored

K, EVERY, SCALE = 5, 50, 256
#: Groups of components: more groups mean shorter local vectors and a weaker cutoff.
GROUPS = 2
#: Query vectors in one block, in bytes; and scores that a task computes at once.
BLOCK_BYTES, CELLS = 16 << 20, 1 << 21


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows that take part: floor(scale * x) of every component as a whole number."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return rows.filter(F.col("vec_id").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(node, vector, ids): the different vectors, numbered, each with its ``ids`` smallest ids. Stored.

    The limit of the window holds before the shuffle too, so a vector with very many copies sends ``ids`` rows a task.
    """
    nth = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= ids)
    each = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return stored(each.withColumn("node", F.monotonically_increasing_id()))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _most(x: np.ndarray, y: np.ndarray) -> int:
    """A bound on the size of an inner product of two rows, which must fit 64 bits."""
    largest = lambda a: max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))
    most = largest(x) * largest(y) * x.shape[1]
    if most >= 2**63:
        raise OverflowError("an inner product may need more than 64 bits")
    return most


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``x`` with all of ``y``: in floating point where every sum stays below 2**53."""
    if _most(x, y) < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x @ y.T


class Block:
    """The queries of one block, and the local scores of a batch of vectors against them."""

    def __init__(self, queries: np.ndarray, matrix: np.ndarray, groups: int):
        self.queries, self.matrix = queries, matrix
        edges = np.linspace(0, matrix.shape[1], min(groups, max(1, matrix.shape[1])) + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges, edges[1:])]

    def rows(self, batch: pa.RecordBatch) -> np.ndarray:
        return _matrix(batch.column("vector"), self.matrix.shape[1])

    def local(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(group, nodes, local scores of these nodes against all queries), a bounded number of scores at once."""
        step = max(1, CELLS // max(1, len(self.queries)))
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                piece = batch.slice(k, step)
                rows = self.rows(piece)
                for part, at in enumerate(self.parts):
                    yield part, piece.column("node").to_numpy(), products(rows[:, at], self.matrix[:, at])


def _columns(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in schema.split(", ")])


def _gathered(points: DataFrame, block, k: int) -> DataFrame:
    """Phase one in each task: per query and group the ``k`` highest local scores, each with the task's least one."""
    schema = "query long, part int, node long, score long, least long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for part, nodes, scores in b.local(batches):
            least, at = scores.min(0), np.broadcast_to(nodes[:, None], scores.shape)
            if part in lists:
                before, at_before, least_before = lists[part]
                scores, at, least = np.vstack([before, scores]), np.vstack([at_before, at]), np.minimum(least, least_before)
            top = np.argpartition(-scores, min(k, len(scores)) - 1, axis=0)[:k]
            lists[part] = np.take_along_axis(scores, top, 0), np.take_along_axis(at, top, 0), least
        for part, (scores, at, least) in lists.items():
            n = len(scores)
            yield _columns(schema, np.tile(b.queries, n), np.full(scores.size, part, np.int32), at.ravel(), scores.ravel(), np.tile(least, n))

    return points.select("node", "vector").mapInArrow(run, schema)


def _collected(points: DataFrame, block, cutoffs) -> DataFrame:
    """Phase two: the local scores that reach the cutoff, as their distance from what a score that stays below it has at most
    (above) and at least (below); ``gap`` is the difference of the two over all groups."""
    schema = "query long, node long, above long, below long, gap long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, (cut, least) = block.value, cutoffs.value
        gap = (cut - 1 - least).sum(0)
        for part, nodes, scores in b.local(batches):
            i, q = np.nonzero(scores >= cut[part])
            found = scores[i, q]
            yield _columns(schema, b.queries[q], nodes[i], found - cut[part][q] + 1, found - least[part][q], gap[q])

    return points.select("node", "vector").mapInArrow(run, schema)


def _resolved(pairs: DataFrame, points: DataFrame, block) -> DataFrame:
    """(query, node, ids, score) with the exact score of every pair."""
    schema = "query long, node long, ids array<long>, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        for batch in batches:
            mine, rows = b.matrix[np.searchsorted(b.queries, batch.column("query").to_numpy())], b.rows(batch)
            _most(rows, mine)
            score = np.einsum("ij,ij->i", rows, mine)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("query", "node", "ids")), pa.array(score)], names=["query", "node", "ids", "score"])

    return pairs.join(points, "node").select("query", "node", "ids", "vector").mapInArrow(run, schema)


def _best(rows: DataFrame, by: list, k: int, *keys: str) -> DataFrame:
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter(F.col("nth") <= k).drop("nth")


def _block_answers(points: DataFrame, wanted: DataFrame, dims: int, k: int, groups: int) -> DataFrame:
    """The three phases for the queries (node, vector) of one block: (query, node, ids, score), stored."""
    context = points.sparkSession.sparkContext
    rows = wanted.select("node", "vector").toArrow()
    queries = rows.column("node").to_numpy()
    order = np.argsort(queries)
    b = Block(queries[order], _matrix(rows.column("vector").combine_chunks(), dims)[order], groups)
    block = context.broadcast(b)

    lists = stored(_gathered(points, block, k))
    least = lists.groupBy("query", "part").agg(F.min("least").alias("least"))
    seen = _best(lists, [F.desc("score"), "node"], k, "query", "part").select("query", "node").distinct()
    known = _resolved(seen, points, block).groupBy("query").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    reached = known.select("query", F.get("scores", F.lit(k - 1)).alias("reached"))
    table = least.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("part", "least"))).alias("least")).join(reached, "query").collect()
    lows = np.zeros((len(b.parts), len(queries)), np.int64)
    cut = np.zeros_like(lows)
    for row in table:
        at = np.searchsorted(b.queries, row.query)
        lows[:, at] = [x.least for x in row.least]
        # Fewer vectors than asked for: everything is collected.
        slack = 0 if row.reached is None else row.reached - int(lows[:, at].sum())
        cut[:, at] = lows[:, at] - (-slack // len(b.parts))
    forget(lists)

    found = _collected(points, block, context.broadcast((cut, lows)))
    sums = stored(found.groupBy("query", "node").agg(F.sum("above").alias("above"), F.sum("below").alias("below"), F.first("gap").alias("gap")))
    kth = _best(sums, [F.desc("below")], k, "query").groupBy("query").agg(F.when(F.count("*") == k, F.min("below")).alias("kth"))
    open_pairs = sums.join(kth, "query").filter(F.col("kth").isNull() | (F.col("above") + F.col("gap") >= F.col("kth"))).select("query", "node")
    answers = stored(_best(_resolved(open_pairs, points, block), [F.desc("score"), F.get("ids", F.lit(0)), "node"], k, "query"))
    forget(sums)
    return answers


def nearest(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, groups: int = GROUPS) -> DataFrame:
    """The ``k`` rows with the highest inner product for every query row: query_id, rank, vec_id, score.

    Needs vec_id and embedding (array of numbers). Queries are the rows whose vec_id is divisible by ``every``; every other row
    is a candidate, also one that repeats the query's id or vector. Equal scores rank by vec_id; a repeated row takes a rank
    each time, and a repeated query row gets its answer each time. Rows without vec_id, without vector, or with a null or
    non-finite component take no part; a shorter vector counts as filled with zeros, an empty one scores 0. With fewer
    candidates than ``k`` all are returned; an empty table gives no rows. Other columns are not looked at.
    """
    spark, ids = rows.sparkSession, k + 1
    taking = usable(rows, scale)
    points = distinct_vectors(taking, ids)
    asked = taking.filter(F.col("vec_id") % every == 0).join(points.select("vector", "node"), "vector").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    asked = stored(asked.withColumn("row", F.monotonically_increasing_id()))
    dims = max(1, points.agg(F.max(F.size("vector"))).first()[0] or 0)
    queries = asked.select(F.col("query").alias("node")).distinct()
    blocks = -(-queries.count() * dims * 8 // BLOCK_BYTES)
    wanted = stored(points.join(queries, "node", "left_semi").withColumn("block", F.pmod(F.xxhash64("node"), F.lit(max(1, blocks)))).select("node", "vector", "block"))
    parts = [_block_answers(points, wanted.filter(F.col("block") == i), dims, ids, groups) for i in range(blocks)]
    schema = "query long, node long, ids array<long>, score long"
    answers = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)

    each = asked.join(answers, "query").select("row", "query_id", "score", (F.col("node") == F.col("query")).alias("own"), "ids", F.posexplode("ids").alias("place", "vec_id"))
    itself = F.col("own") & (F.col("place") + 1 == F.array_position("ids", F.col("query_id")))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = each.filter(~itself).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
