"""Walks over trees and graphs given as edge tables, one level per round.

Only the frontier of the last round is joined with the edges. Every round is written to the shared folder, so the plan
does not grow and a lost executor costs at most one round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftline.session import cut_lineage, task_count

ROUNDS_KEPT = 16  # rounds that may pile up in one union before they are written as one table


def descendants(
    nodes: DataFrame, node: str, parent: str, roots: Column, max_depth: int | None = None
) -> DataFrame:
    """All rows below the roots with their ``depth``; children of a root have depth 1, the root itself is left out.

    ``roots`` is a condition on ``nodes``. The walk ends at an empty level or ``max_depth``. The rows must form a tree, in which no
    branch is longer than there are nodes: for data with cycles use ``reachable``; here they raise an error.
    """
    tree = nodes.select(F.col(node).alias("__node"), F.col(parent).alias("__parent")).where(F.col("__parent").isNotNull())
    frontier = nodes.where(roots).select(F.col(node).alias("__at"))
    levels, depth = [], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = tree.join(frontier, F.col("__parent") == F.col("__at")).select(
            F.col("__node").alias("__at"), F.lit(depth).alias("depth")
        )
        step = cut_lineage(step)
        if step.isEmpty():
            break
        if depth % ROUNDS_KEPT == 0 and depth > tree.count():
            raise ValueError("the rows have a cycle")
        levels.append(step)
        if len(levels) == ROUNDS_KEPT:
            levels = [cut_lineage(reduce(DataFrame.unionByName, levels))]
        frontier = step.select("__at")
    if not levels:
        return nodes.where(F.lit(False)).withColumn("depth", F.lit(0))
    found = reduce(DataFrame.unionByName, levels)
    return nodes.join(found, nodes[node] == F.col("__at")).drop("__at")


def reachable(edges: DataFrame, source: str, target: str, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes that can be reached from ``seeds`` (one column) along the edges, with the least number of steps as ``depth``.

    The seeds have depth 0. Nodes seen before are removed from each new frontier, so cycles end the walk.
    """
    # Stored once: every round reads the distinct edges, not what they were made from.
    links = cut_lineage(edges.select(F.col(source).alias("__from"), F.col(target).alias("node")).distinct())
    seed = seeds.columns[0]
    visited = cut_lineage(seeds.select(F.col(seed).alias("node")).distinct().withColumn("depth", F.lit(0)))
    frontier, depth = visited, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        ahead = links.join(frontier.select(F.col("node").alias("__at")), F.col("__from") == F.col("__at"), "left_semi")
        new = ahead.select("node").distinct().join(visited.select("node"), "node", "left_anti")
        frontier = cut_lineage(new.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
        if depth % ROUNDS_KEPT == 0:
            visited = cut_lineage(visited)
    return visited


def paths(
    edges: DataFrame, source: str, target: str, starts: DataFrame, hops: int, ends: DataFrame | None = None
) -> DataFrame:
    """(start, end, hops, path) of the walks of 1 to ``hops`` edges from the named start nodes, to any node or to the named ends.

    ``starts`` and ``ends`` have one column. There is one row per (start, end, hops); ``path`` lists the nodes of one such walk, found by
    parent pointers: of several ways into a node on one level the smallest is kept, so parallel ways do not multiply. With
    ``ends`` the walk goes from both sides and meets in the middle, so neither side goes further than half the way; of several nodes
    where they meet the smallest is kept, and ways are looked for only where somebody selects ``path``. Without them
    it goes forward only. Either way the work grows with the named nodes and their surroundings, not with all pairs.
    """
    links = edges.select(F.col(source).alias("__from"), F.col(target).alias("__to")).where("__from IS NOT NULL AND __to IS NOT NULL")
    if ends is None:
        links = cut_lineage(links.distinct())
        ahead = _levels(links, starts, "__from", "__to", hops)
        found = [_traced(ahead, n).select("origin", F.col("node").alias("end"), F.lit(n).alias("hops"), "way") for n in range(1, hops + 1)]
        return reduce(DataFrame.unionByName, found).withColumnsRenamed({"origin": "start", "way": "path"})
    # Parallel edges need no pass of their own: a level has every node once.
    links = cut_lineage(links)
    ahead = _reached(links, starts, "__from", "__to", -(-hops // 2))
    back = _reached(links, ends, "__to", "__from", hops // 2)
    found = []
    for n in range(1, hops + 1):
        left, right = -(-n // 2), n // 2
        met = ahead[left].withColumnRenamed("origin", "start").join(back[right].withColumnRenamed("origin", "end"), "node")
        met = met.groupBy("start", "end").agg(F.min("node").alias("__met"))
        met = _way(_way(met, "start", ahead, links, "__from", "__to", left), "end", back, links, "__to", "__from", right)
        path = F.concat(F.reverse("__way_start"), F.slice("__way_end", F.lit(2), F.size("__way_end")))
        found.append(met.select("start", "end", F.lit(n).alias("hops"), path.alias("path")))
    return reduce(DataFrame.unionByName, found)


def paths_up_to(edges: DataFrame, source: str, target: str, hops: int) -> DataFrame:
    """Distinct (start, end, hops) of the walks of 1 to ``hops`` edges from every start node: one row per pair, for small graphs."""
    return paths(edges, source, target, edges.select(source), hops).select("start", "end", "hops")


def _levels(links: DataFrame, seeds: DataFrame, here: str, there: str, hops: int) -> list[DataFrame]:
    """Stored levels 0.. of a walk: (origin, node, parent), once per origin and node."""
    first = seeds.select(F.col(seeds.columns[0]).alias("node")).where("node IS NOT NULL").distinct()
    levels = [cut_lineage(first.select(F.col("node").alias("origin"), "node", F.col("node").alias("parent")))]
    for _ in range(hops):
        step = levels[-1].select("origin", F.col("node").alias("parent")).join(links, F.col("parent") == F.col(here))
        levels.append(cut_lineage(step.groupBy("origin", F.col(there).alias("node")).agg(F.min("parent").alias("parent"))))
    return levels


def _reached(links: DataFrame, seeds: DataFrame, here: str, there: str, hops: int) -> list[DataFrame]:
    """Stored levels 0.. of a walk: (origin, node), once each, without parents: a hash aggregate of two columns and no sort.

    Rows are dealt out before the aggregate, as most differ, to as many tasks as the links need.
    """
    tasks = task_count(links)
    first = seeds.select(F.col(seeds.columns[0]).alias("node")).where("node IS NOT NULL").distinct()
    levels = [cut_lineage(first.select(F.col("node").alias("origin"), "node"))]
    for _ in range(hops):
        step = levels[-1].join(links, F.col("node") == F.col(here)).select("origin", F.col(there).alias("node"))
        levels.append(cut_lineage(step.repartition(tasks, "origin", "node").distinct()))
    return levels


def _way(met: DataFrame, origin: str, levels: list[DataFrame], links: DataFrame, here: str, there: str, n: int) -> DataFrame:
    """Adds the nodes from ``__met``, a node of level ``n``, back to the origin as an array ``__way_<origin>``.

    Every lookup is a left join by the whole key of an aggregate, which the optimizer leaves out where the array is not selected.
    """
    way = f"__way_{origin}"
    out = met.withColumn(way, F.array("__met")).withColumn("__at", F.col("__met"))
    for level in reversed(levels[:n]):
        step = level.select(F.col("origin").alias("__o"), F.col("node").alias("__up")).join(links, F.col("__up") == F.col(here))
        up = step.groupBy("__o", F.col(there).alias("__n")).agg(F.min("__up").alias("__up"))
        joined = out.join(up, (F.col(origin) == F.col("__o")) & (F.col("__at") == F.col("__n")), "left")
        out = joined.select(*met.columns, F.concat(way, F.array("__up")).alias(way), F.col("__up").alias("__at"))
    return out.drop("__at")


def _traced(levels: list[DataFrame], n: int) -> DataFrame:
    """(origin, node, way) of level ``n``: the nodes from the origin on, along the parent pointers."""
    out = levels[n].select("origin", "node", F.array("node").alias("way"), F.col("parent").alias("__at"))
    for level in reversed(levels[:n]):
        up = level.select(F.col("origin").alias("__o"), F.col("node").alias("__n"), F.col("parent").alias("__up"))
        joined = out.join(up, (F.col("origin") == F.col("__o")) & (F.col("__at") == F.col("__n")))
        out = joined.select("origin", "node", F.concat(F.array("__at"), "way").alias("way"), F.col("__up").alias("__at"))
    return out.select("origin", "node", "way")
