"""Subqueries, chained expressions, recursion and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weftline.functions.scalars import money
from weftline.operators import aggregates, recursion, views
from weftline.plans.registry import query
from weftline.plans.relational_queries import LIFETIME_VALUE, cond_agg_case, customer_tree
from weftline.session import scratch_path, task_count
from weftline.sources.snapshots import Snapshots
from weftline.sources.tables import Tables


@query(
    "cte_chained",
    """
    WITH totals AS (
      SELECT r_name, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey GROUP BY r_name),
    overall AS (SELECT CAST(sum(total) AS DOUBLE) / count(*) AS mean FROM totals)
    SELECT r_name, CAST(total AS DOUBLE) AS total FROM totals, overall WHERE CAST(total AS DOUBLE) > mean
    """,
)
def cte_chained(t: Tables) -> DataFrame:
    """Regions whose revenue beats the mean over regions. Orders are summed per customer before the dimensions join."""
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("paid"))
    located = (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    # One row per region: the mean is a window over them, so the join runs once.
    totals = located.groupBy("r_name").agg(F.sum("paid").alias("paid"))
    over = Window.partitionBy()
    mean = F.sum("paid").over(over).cast("double") / F.count(F.lit(1)).over(over)
    with_mean = totals.select("r_name", F.col("paid").cast("double").alias("total"), mean.alias("mean"))
    return with_mean.where("total > mean").drop("mean")


@query(
    "scalar_subquery",
    "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice = (SELECT max(p_retailprice) FROM part WHERE p_size < 25)",
)
def scalar_subquery(t: Tables) -> DataFrame:
    highest = t.part.where("p_size < 25").agg(F.max("p_retailprice")).scalar()
    return t.part.where(F.col("p_retailprice") == highest).select("p_partkey", "p_retailprice")


@query(
    "correlated_max",
    """
    SELECT o.o_orderkey, (SELECT max(p.o_orderdate) FROM orders p
                          WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'F') AS last_finished
    FROM orders o
    """,
)
def correlated_max(t: Tables) -> DataFrame:
    """A correlated subquery in the projection; Catalyst turns it into one aggregate and one join."""
    return t.spark.sql(
        """
        SELECT o.o_orderkey, (SELECT max(p.o_orderdate) FROM {orders} p
                              WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'F') AS last_finished
        FROM {orders} o
        """,
        orders=t.orders,
    )


@query(
    "recursive_hierarchy",
    """
    WITH RECURSIVE nodes AS (
      SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN (c_custkey - 1) // 4 END AS parent_id FROM customer),
    below AS (
      SELECT id, parent_id, 1 AS depth FROM nodes WHERE parent_id = 0
      UNION ALL
      SELECT n.id, n.parent_id, b.depth + 1 FROM nodes n JOIN below b ON n.parent_id = b.id)
    SELECT id, parent_id, depth FROM below
    """,
)
def recursive_hierarchy(t: Tables) -> DataFrame:
    return recursion.descendants(customer_tree(t), "id", "parent_id", F.col("id") == 0)


TRADE_EDGES = """
      SELECT DISTINCT 'c' || o_custkey AS a, 's' || l_suppkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


@query(
    "recursive_reach",
    f"""
    WITH RECURSIVE pairs AS ({TRADE_EDGES}),
    edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
    reach AS (
      SELECT 'c' || c_custkey AS node FROM customer WHERE c_acctbal > 9900
      UNION
      SELECT e.b FROM edges e JOIN reach r ON e.a = r.node)
    SELECT node FROM reach
    """,
)
def recursive_reach(t: Tables) -> DataFrame:
    """Who is connected to the richest customers through any order? The graph is full of cycles."""
    tasks = task_count(t.lineitem)
    orders, lines = t.orders.repartition(tasks, "o_orderkey"), t.lineitem.repartition(tasks, "l_orderkey")
    pairs = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.concat(F.lit("c"), "o_custkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b"))
        .repartition(tasks, "a", "b")
        .distinct()
    )
    edges = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seeds = t.customer.where("c_acctbal > 9900").select(F.concat(F.lit("c"), "c_custkey").alias("node"))
    return recursion.reachable(edges, "a", "b", seeds).select("node")


@query(
    "graph_path_1_3",
    """
    WITH e AS (SELECT c_custkey AS a, (c_custkey - 1) // 4 AS b FROM customer WHERE c_custkey > 0),
    s AS (SELECT c_custkey AS start FROM customer)
    SELECT start, b AS end, 1 AS hops, start || '>' || b AS path FROM s JOIN e x ON x.a = start
    UNION ALL SELECT start, y.b, 2, start || '>' || x.b || '>' || y.b FROM s JOIN e x ON x.a = start JOIN e y ON x.b = y.a
    UNION ALL SELECT start, z.b, 3, start || '>' || x.b || '>' || y.b || '>' || z.b
      FROM s JOIN e x ON x.a = start JOIN e y ON x.b = y.a JOIN e z ON y.b = z.a
    """,
)
def graph_path_1_3(t: Tables) -> DataFrame:
    """Where the referrers of every customer lead in up to three steps, and on which way."""
    edges = customer_tree(t).where(F.col("parent_id").isNotNull())
    starts = t.customer.select("c_custkey")
    return recursion.paths(edges, "id", "parent_id", starts, 3).withColumn("path", F.array_join("path", ">"))


@query(
    "graph_path_between",
    """
    WITH p AS (SELECT DISTINCT 'c' || o_custkey AS c, 's' || l_suppkey AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    e AS (SELECT c AS a, s AS b FROM p UNION ALL SELECT s, c FROM p),
    starts AS (SELECT 'c' || c_custkey AS start FROM customer WHERE c_acctbal > 9980),
    ends AS (SELECT 's' || s_suppkey AS goal FROM supplier WHERE s_acctbal > 9000)
    SELECT start, b AS end, 1 AS hops FROM starts JOIN e ON a = start JOIN ends ON b = goal
    UNION ALL
    SELECT DISTINCT start, z.b, 3 FROM starts JOIN e x ON x.a = start JOIN e y ON x.b = y.a JOIN e z ON y.b = z.a JOIN ends ON z.b = goal
    """,
)
def graph_path_between(t: Tables) -> DataFrame:
    """Are the richest customers and suppliers connected by an order, or by a supplier and a customer in between?"""
    tasks = task_count(t.lineitem)
    orders, lines = t.orders.repartition(tasks, "o_orderkey"), t.lineitem.repartition(tasks, "l_orderkey")
    pairs = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.concat(F.lit("c"), "o_custkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b"))
        .repartition(tasks, "a", "b")
        .distinct()
    )
    edges = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    starts = t.customer.where("c_acctbal > 9980").select(F.concat(F.lit("c"), "c_custkey"))
    ends = t.supplier.where("s_acctbal > 9000").select(F.concat(F.lit("s"), "s_suppkey"))
    return recursion.paths(edges, "a", "b", starts, 3, ends).select("start", "end", "hops")


@query("view_filter", f"SELECT * FROM ({LIFETIME_VALUE}) WHERE lifetime_value > 2000000")
def view_filter(t: Tables) -> DataFrame:
    views.create_view(cond_agg_case(t), "customer_lifetime_value")
    return t.spark.sql("SELECT * FROM customer_lifetime_value WHERE lifetime_value > 2000000 ORDER BY lifetime_value DESC")


@query(
    "view_join",
    """
    SELECT o_orderkey, c_name, o_totalprice FROM (SELECT * FROM orders WHERE o_orderstatus <> 'O') v
    JOIN customer ON c_custkey = v.o_custkey
    """,
)
def view_join(t: Tables) -> DataFrame:
    active = views.create_view(t.orders.where("o_orderstatus <> 'O'"), "active_orders")
    return active.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("matview_refresh", f"SELECT c_custkey, lifetime_value FROM ({LIFETIME_VALUE})")
def matview_refresh(t: Tables) -> DataFrame:
    """Stored while one status is missing from the base table, then refreshed over all of it."""
    base = {"orders": t.orders.where("o_orderstatus <> 'F'")}

    def define() -> DataFrame:
        shipped = F.col("o_orderstatus") == "F"
        return aggregates.lifetime_value(t.customer, base["orders"], "c_custkey", "o_custkey", shipped, "o_totalprice")

    view = views.MaterializedView(Snapshots(t.spark, scratch_path(t.spark, "matview")), define)
    base["orders"] = t.orders
    view.refresh()
    return view.read().select("c_custkey", F.col("lifetime_value").cast("double").alias("lifetime_value"))


@query(
    "matview_incremental",
    """
    SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
    """,
)
def matview_incremental(t: Tables) -> DataFrame:
    """Two batches of events merged one after the other; the second is delivered twice and counted once."""
    rows = t.events.select("event_type", F.to_date("ts").alias("day"), money("value").alias("amount"))
    early, late = [rows.where(f"day {op} DATE'2024-01-16'") for op in ("<", ">=")]
    totals = views.BucketedAggregate(t.spark, scratch_path(t.spark, "incremental"), ["event_type", "day"], {"total": "amount"}, "events", 16)
    for batch, part in [(1, early), (2, late), (2, late)]:
        totals.merge(part, batch)
    return totals.read().select("event_type", "day", "events", F.col("total").cast("double").alias("total"))
