import random

import pytest
from pyspark.sql import functions as F
from samples import bag

from weftline.operators import recursion
from weftline.plans.catalog import QUERIES


def test_everyone_below_ada(data):
    below = recursion.descendants(data.employees, "id", "manager_id", F.col("name") == "Ada")
    assert bag(below, "depth", "name") == [(1, "Bella"), (1, "Cleo"), (2, "Dev"), (2, "Eli"), (3, "Fatou")]
    assert bag(recursion.descendants(data.employees, "id", "manager_id", F.col("name") == "Ada", max_depth=1), "name") == [
        ("Bella",),
        ("Cleo",),
    ]


def test_a_leaf_has_nobody_below(data):
    below = recursion.descendants(data.employees, "id", "manager_id", F.col("name") == "Fatou")
    assert below.count() == 0 and "depth" in below.columns


def test_a_deep_chain_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(recursion, "ROUNDS_KEPT", 3)
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(8)], "id int, p int")
    below = recursion.descendants(chain, "id", "p", F.col("id") == 0)
    assert bag(below, "id", "depth") == [(i, i) for i in range(1, 8)]
    edges = chain.where("p is not null")
    seeds = spark.createDataFrame([(0,)], "n int")
    assert bag(recursion.reachable(edges, "p", "id", seeds)) == [(i, i) for i in range(8)]


def test_cycles_end_the_walk(spark):
    rng = random.Random(1)
    links = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    seen, frontier, depth = {0: 0, 1: 0}, {0, 1}, 0
    while frontier:
        depth += 1
        frontier = {b for a, b in links if a in frontier} - set(seen)
        seen.update(dict.fromkeys(frontier, depth))
    edges = spark.createDataFrame(links, "a int, b int")
    seeds = spark.createDataFrame([(0,), (1,)], "n int")
    assert bag(recursion.reachable(edges, "a", "b", seeds)) == sorted(seen.items(), key=repr)
    near = recursion.reachable(edges, "a", "b", seeds, max_depth=2)
    assert bag(near) == sorted([(n, d) for n, d in seen.items() if d <= 2], key=repr)


@pytest.mark.parametrize("hops", [1, 3])
def test_bounded_paths(spark, hops):
    links = [(1, 2), (2, 3), (3, 1), (1, 3), (3, 4), (4, 5)]
    want, step = set(), set(links)
    for n in range(1, hops + 1):
        want |= {(a, b, n) for a, b in step}
        step = {(a, d) for a, b in step for c, d in links if b == c}
    edges = spark.createDataFrame(links * 2, "a int, b int")
    assert bag(recursion.paths_up_to(edges, "a", "b", hops)) == sorted(want, key=repr)


@pytest.mark.parametrize("hops", [1, 2, 3, 5])
def test_paths_between_named_nodes(spark, hops):
    """From given starts, forward only and from both ends; the path is a walk of the graph with that many edges."""
    rng = random.Random(hops)
    links = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(22)})
    starts, goals = [0, 3, 7, 99], [1, 3, 8]
    want, step = set(), {(a, a) for a in starts}
    for n in range(1, hops + 1):
        step = {(a, d) for a, b in step for c, d in links if b == c}
        want |= {(a, b, n) for a, b in step}
    edges = spark.createDataFrame(links * 2 + [(None, 1), (2, None)], "a int, b int")
    named = lambda nodes: spark.createDataFrame([(x,) for x in [*nodes, nodes[0], None]], "x int")
    for ends, expected in ((None, want), (named(goals), {w for w in want if w[1] in goals})):
        got = recursion.paths(edges, "a", "b", named(starts), hops, ends).collect()
        assert sorted((r.start, r.end, r.hops) for r in got) == sorted(expected)
        for r in got:
            assert len(r.path) == r.hops + 1 and (r.path[0], r.path[-1]) == (r.start, r.end)
            assert all(edge in links for edge in zip(r.path, r.path[1:]))


def test_ways_nobody_selects_are_not_looked_for(spark):
    """Without the path, each number of hops is one join of two levels and an aggregate that needs no sort."""
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c")], "x string, y string")
    named = lambda node: spark.createDataFrame([(node,)], "n string")
    found = recursion.paths(edges, "x", "y", named("a"), 3, named("d"))
    assert bag(found, "hops", "path") == [(2, ["a", "c", "d"]), (3, ["a", "b", "c", "d"])]
    plan = found.select("start", "end", "hops")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3 and "min(" not in plan


def test_every_customer_is_a_start(spark, tmp_path):
    """The query leaves no customer out, whatever the balance."""
    rows = [(k, f"name {k}", 1, [None, -5.0, 9_950.0][k % 3], "x") for k in range(30)]
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "customer.parquet"))
    want = []
    for start in range(30):
        at, way = start, [start]
        while at > 0 and len(way) <= 3:
            at = (at - 1) // 4
            way.append(at)
            want.append((start, at, len(way) - 1, ">".join(map(str, way))))
    got = QUERIES["graph_path_1_3"](spark, str(tmp_path))
    assert bag(got, "start", "end", "hops", "path") == sorted(want, key=repr)


def test_a_cycle_in_a_tree_is_refused(spark):
    nodes = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "id int, up int")
    with pytest.raises(ValueError, match="cycle"):
        recursion.descendants(nodes, "id", "up", F.col("id") == 1)
