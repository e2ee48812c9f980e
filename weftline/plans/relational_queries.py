"""Scans, projections, filters, joins, aggregates, sorting and set operations over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import int_div, int_or_null, money, portable_bucket
from weftline.operators import aggregates, joins, paging
from weftline.plans.registry import query
from weftline.sources import tables as src
from weftline.sources.tables import Tables

# ---- scans, sources, sinks -----------------------------------------------------------------------------------------


@query("scan_all", "SELECT * FROM customer")
def scan_all(t: Tables) -> DataFrame:
    return t.customer


@query(
    "inline_values",
    """
    SELECT v.label, count(*) AS orders
    FROM (VALUES ('F', 'shipped'), ('P', 'pending'), ('O', 'open')) AS v(code, label)
    JOIN orders o ON o.o_orderstatus = v.code
    GROUP BY v.label
    """,
)
def inline_values(t: Tables) -> DataFrame:
    labels = src.inline_rows(t.spark, "code string, label string", [("F", "shipped"), ("P", "pending"), ("O", "open")])
    per_code = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return per_code.join(labels, per_code.o_orderstatus == labels.code).select("label", "orders")


@query(
    "number_series",
    """
    SELECT n, count(l_orderkey) AS lines
    FROM generate_series(0, (SELECT max(o_orderkey) FROM orders)) AS s(n)
    LEFT JOIN lineitem ON l_orderkey = n
    GROUP BY n
    """,
)
def number_series(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    series = src.number_series(t.spark, 0, last)
    return joins.count_children(series, t.lineitem, "n", "l_orderkey", "lines")


@query(
    "synth_products",
    """
    SELECT o_orderkey AS id, 'Product ' || o_orderkey AS name, o_orderkey % 20 + 1 AS category_id,
           o_orderkey % 100 + 10 AS price
    FROM orders
    """,
)
def synth_products(t: Tables) -> DataFrame:
    return src.cyclic_products(t.orders.select("o_orderkey"), "o_orderkey", 20, 100, 10)


@query(
    "append_rows",
    """
    SELECT * FROM orders
    UNION ALL
    SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate, 'unset' FROM orders
    WHERE o_orderstatus = 'O'
    """,
)
def append_rows(t: Tables) -> DataFrame:
    again = t.orders.where("o_orderstatus = 'O'").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"),
        "o_custkey",
        F.lit("N").alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
    )
    return src.append_rows(t.orders, again, {"o_orderpriority": F.lit("unset")})


@query("insert_select", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def insert_select(t: Tables) -> DataFrame:
    return src.append_rows(src.like_schema(t.orders), t.orders.where("o_orderpriority = '1-URGENT'"))


# ---- projections and scalar expressions ----------------------------------------------------------------------------


@query("project_columns", "SELECT c_name, c_mktsegment FROM customer")
def project_columns(t: Tables) -> DataFrame:
    return t.customer.select("c_name", "c_mktsegment")


@query("project_alias", "SELECT c.c_name AS customer, c.c_acctbal AS balance FROM customer AS c")
def project_alias(t: Tables) -> DataFrame:
    c = t.customer.alias("c")
    return c.select(F.col("c.c_name").alias("customer"), F.col("c.c_acctbal").alias("balance"))


@query("literal_column", "SELECT 'supplier list' AS section, s_suppkey, s_name FROM supplier")
def literal_column(t: Tables) -> DataFrame:
    return t.supplier.select(F.lit("supplier list").alias("section"), "s_suppkey", "s_name")


@query(
    "arith_expr",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_price,
           l_linenumber + 1 AS next_line
    FROM lineitem
    """,
)
def arith_expr(t: Tables) -> DataFrame:
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        net.cast("double").alias("net_price"),
        (F.col("l_linenumber") + 1).alias("next_line"),
    )


@query(
    "case_when",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'waiting' END AS bucket
    FROM orders
    """,
)
def case_when(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey", F.when(status == "F", "done").when(status == "P", "waiting").alias("bucket")
    )


@query(
    "coalesce_zero",
    """
    SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, 0) AS shipped_total FROM orders
    """,
)
def coalesce_zero(t: Tables) -> DataFrame:
    shipped = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", F.coalesce(shipped, F.lit(0.0)).alias("shipped_total"))


@query(
    "cast_types",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_text, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS urgency,
           TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
    FROM orders
    """,
)
def cast_types(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("cust_text"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("urgency"),
        int_or_null("o_orderpriority").alias("not_a_number"),
    )


@query("string_concat", "SELECT c_custkey, c_mktsegment || ' / ' || c_custkey AS label FROM customer")
def string_concat(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.concat("c_mktsegment", F.lit(" / "), "c_custkey").alias("label"))


@query(
    "modulo_cycle",
    "SELECT o_orderkey, o_orderkey % 7 + 1 AS weekday_slot, (o_orderkey % 50) + 100 AS shelf FROM orders",
)
def modulo_cycle(t: Tables) -> DataFrame:
    n = F.col("o_orderkey")
    return t.orders.select("o_orderkey", src.cyclic(n, 7, 1).alias("weekday_slot"), src.cyclic(n, 50, 100).alias("shelf"))


@query("int_division", "SELECT o_orderkey // 20 AS page, count(*) AS orders FROM orders GROUP BY 1")
def int_division(t: Tables) -> DataFrame:
    return t.orders.groupBy(int_div("o_orderkey", 20).alias("page")).agg(F.count(F.lit(1)).alias("orders"))


@query("sample_every_kth", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0")
def sample_every_kth(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderkey") % 10 == 0).select("o_orderkey", "o_totalprice")


@query(
    "hash_bucket",
    """
    SELECT CAST(('0x' || substr(md5(c_name), 1, 8)) AS BIGINT) % 16 AS bucket, count(*) AS customers
    FROM customer GROUP BY 1
    """,
)
def hash_bucket(t: Tables) -> DataFrame:
    return t.customer.groupBy(portable_bucket(16, F.col("c_name")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("customers")
    )


@query(
    "round_values",
    """
    SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 0) AS BIGINT) AS whole,
           CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS one_digit
    FROM customer
    """,
)
def round_values(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.round(money("c_acctbal"), 0).cast("long").alias("whole"),
        F.round(money("c_acctbal"), 1).cast("double").alias("one_digit"),
    )


@query(
    "default_fill",
    """
    SELECT event_id, COALESCE(CASE WHEN event_type <> 'error' THEN ts END, TIMESTAMP '2024-02-01 00:00:00') AS seen_at
    FROM events
    """,
)
def default_fill(t: Tables) -> DataFrame:
    """A column default. "Now" is passed in as a fixed moment, so a rerun gives the same rows."""
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    return t.events.select("event_id", F.coalesce(known, as_of).alias("seen_at"))


@query("interval_add", "SELECT event_id, ts + INTERVAL 1 HOUR AS expires_at FROM events")
def interval_add(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("expires_at"))


@query(
    "json_round_trip",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def json_round_trip(t: Tables) -> DataFrame:
    fields = t.events.select("event_id", "user_id", "event_type", "value")
    text = fields.select(F.to_json(F.struct(*fields.columns)).alias("doc"))
    return text.select(F.from_json("doc", fields.schema).alias("r")).select("r.*")


# ---- filters -------------------------------------------------------------------------------------------------------


@query("filter_compare", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 5000 AND c_mktsegment <> 'BUILDING'")
def filter_compare(t: Tables) -> DataFrame:
    return t.customer.where((F.col("c_acctbal") >= 5000) & (F.col("c_mktsegment") != "BUILDING")).select(
        "c_custkey", "c_acctbal"
    )


@query("filter_or", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 20000 OR o_totalprice > 450000")
def filter_or(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.where((price < 20000) | (price > 450000)).select("o_orderkey", "o_totalprice")


@query(
    "filter_between",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'
    """,
)
def filter_between(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    low, high = [F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-12-31")]
    return t.orders.where(day.between(low, high)).select("o_orderkey", "o_orderdate")


@query("filter_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in_list(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("like_sensitive", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ed %' AND p_type NOT LIKE '%economy%'")
def like_sensitive(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("%ed %") & ~F.col("p_type").like("%economy%")).select("p_partkey", "p_name")


@query("like_insensitive", "SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%eco_omy%'")
def like_insensitive(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_type").ilike("%eco_omy%")).select("p_partkey", "p_type")


@query(
    "string_affix",
    """
    SELECT p_partkey, starts_with(p_name, 'small') AS small, ends_with(p_name, 'ring') AS ring,
           contains(p_name, 'd b') AS inner_match
    FROM part WHERE starts_with(p_name, 'small') OR ends_with(p_name, 'ring') OR contains(p_name, 'd b')
    """,
)
def string_affix(t: Tables) -> DataFrame:
    name = F.col("p_name")
    tests = {"small": name.startswith("small"), "ring": name.endswith("ring"), "inner_match": name.contains("d b")}
    return t.part.select("p_partkey", *[c.alias(n) for n, c in tests.items()]).where("small OR ring OR inner_match")


@query(
    "filter_null",
    """
    SELECT o_orderkey FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey
    WHERE l_orderkey IS NULL
    """,
)
def filter_null(t: Tables) -> DataFrame:
    keys = t.lineitem.select("l_orderkey").distinct()
    joined = t.orders.join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.where(F.col("l_orderkey").isNull()).select("o_orderkey")


@query("lookup_unique", "SELECT * FROM customer WHERE c_name = 'Customer#000000042'")
def lookup_unique(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_name") == "Customer#000000042")


@query("lookup_must_exist", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 9000 ORDER BY c_custkey LIMIT 1")
def lookup_must_exist(t: Tables) -> DataFrame:
    """The first rich customer; no such customer would be an error."""
    found = src.first_or_raise(t.customer.select("c_custkey", "c_name", "c_acctbal"), F.col("c_acctbal") > 9000, ["c_custkey"])
    return src.inline_rows(t.spark, "c_custkey long, c_name string", [(found["c_custkey"], found["c_name"])])


@query("filter_compound", "SELECT p_partkey, p_type, p_retailprice FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > 950")
def filter_compound(t: Tables) -> DataFrame:
    return t.part.where((F.col("p_type") == "ECONOMY") & (F.col("p_retailprice") > 950)).select(
        "p_partkey", "p_type", "p_retailprice"
    )


# ---- joins ---------------------------------------------------------------------------------------------------------


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey",
)
def join_inner(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice"
    )


@query(
    "join_left",
    "SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey",
)
def join_left(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "l_partkey", "l_quantity"
    )


@query(
    "join_left_on_filter",
    """
    SELECT o_orderkey, l_partkey FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'
    """,
)
def join_left_on_filter(t: Tables) -> DataFrame:
    on = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_returnflag") == "R")
    return t.orders.join(t.lineitem, on, "left").select("o_orderkey", "l_partkey")


@query(
    "cross_scalar",
    """
    SELECT c_custkey, c_acctbal, m.top_balance FROM customer CROSS JOIN (SELECT max(c_acctbal) AS top_balance FROM customer) m
    """,
)
def cross_scalar(t: Tables) -> DataFrame:
    """One value stamped on every row, as a scalar subquery: no join is planned at all."""
    top = t.customer.agg(F.max("c_acctbal").alias("top_balance"))
    return t.customer.select("c_custkey", "c_acctbal", top.scalar().alias("top_balance"))


@query(
    "above_group_avg",
    """
    WITH a AS (SELECT o_orderpriority AS p,
                      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
               FROM orders GROUP BY 1)
    SELECT o_orderkey, o_orderpriority, o_totalprice, avg_price
    FROM orders JOIN a ON p = o_orderpriority WHERE o_totalprice > avg_price
    """,
)
def above_group_avg(t: Tables) -> DataFrame:
    averages = t.orders.groupBy("o_orderpriority").agg(aggregates.exact_avg("o_totalprice").alias("avg_price"))
    return (
        t.orders.join(averages, "o_orderpriority")
        .where(F.col("o_totalprice") > F.col("avg_price"))
        .select("o_orderkey", "o_orderpriority", "o_totalprice", "avg_price")
    )


@query(
    "self_join_parent",
    """
    SELECT c.c_custkey AS member, p.c_custkey AS sponsor, p.c_name AS sponsor_name
    FROM customer c JOIN customer p ON p.c_custkey = CASE WHEN c.c_custkey > 0 THEN (c.c_custkey - 1) // 4 END
    """,
)
def self_join_parent(t: Tables) -> DataFrame:
    members = customer_tree(t).alias("m")
    sponsors = t.customer.alias("s")
    return members.join(sponsors, F.col("m.parent_id") == F.col("s.c_custkey")).select(
        F.col("m.id").alias("member"),
        F.col("s.c_custkey").alias("sponsor"),
        F.col("s.c_name").alias("sponsor_name"),
    )


def customer_tree(t: Tables) -> DataFrame:
    """Customers as a tree of four children per node; the customer with key 0 is the root."""
    key = F.col("c_custkey")
    return t.customer.select(key.alias("id"), F.when(key > 0, int_div(key - 1, 4)).alias("parent_id"))


@query(
    "semi_join",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def semi_join(t: Tables) -> DataFrame:
    finished = t.orders.where("o_orderstatus = 'F'")
    return t.customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "anti_join",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def anti_join(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(
        "o_orderkey", "o_custkey"
    )


@query(
    "join_undeclared_key",
    """
    SELECT event_id, c_name, event_type FROM events JOIN customer ON c_name = 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')
    """,
)
def join_undeclared_key(t: Tables) -> DataFrame:
    """Events and customers share no declared key; the customer name is built from the user number."""
    named = t.events.withColumn("name", F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")))
    return named.join(t.customer, F.col("name") == F.col("c_name")).select("event_id", "c_name", "event_type")


@query(
    "join_bridge",
    """
    SELECT DISTINCT s_name, p_name FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
    """,
)
def join_bridge(t: Tables) -> DataFrame:
    """Many to many through lineitem. The pairs are made distinct before any wide column is attached."""
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    return (
        pairs.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("s_name", "p_name")
        .distinct()
    )


@query(
    "broadcast_lookup",
    """
    SELECT n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name
    """,
)
def broadcast_lookup(t: Tables) -> DataFrame:
    """Group first, then look the names up: the join sees one row per nation."""
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    named = joins.lookup(per_nation, t.nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey")
    return named.select("n_name", "customers")


@query(
    "include_to_one",
    """
    SELECT o_orderkey, c_name AS customer_name, c_mktsegment AS customer_segment
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def include_to_one(t: Tables) -> DataFrame:
    nested = joins.include_one(t.orders, t.customer, "o_custkey", "c_custkey", "customer")
    return nested.select(
        "o_orderkey",
        F.col("customer.c_name").alias("customer_name"),
        F.col("customer.c_mktsegment").alias("customer_segment"),
    )


@query(
    "include_to_many",
    """
    WITH placed AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS place FROM lineitem
    )
    SELECT o_orderkey, CAST(coalesce(place // 3, 0) AS BIGINT) AS page, CAST(count(l_orderkey) AS BIGINT) AS n_items,
           coalesce(string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ',' ORDER BY place), '') AS items
    FROM orders LEFT JOIN placed ON l_orderkey = o_orderkey GROUP BY o_orderkey, page
    """,
)
def include_to_many(t: Tables) -> DataFrame:
    nested = joins.include_many(
        t.orders.select("o_orderkey"),
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "o_orderkey",
        "l_orderkey",
        "items",
        order=["l_linenumber", "l_partkey", "l_suppkey"],
        page_size=3,
    )
    text = F.transform("items", lambda i: F.concat_ws(":", i["l_linenumber"], i["l_partkey"], i["l_suppkey"]))
    return nested.select(
        "o_orderkey", "page", F.size("items").cast("long").alias("n_items"), F.concat_ws(",", text).alias("items")
    )


@query(
    "join_filter_parent",
    """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY'
    """,
)
def join_filter_parent(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.where(F.col("c_mktsegment") == "MACHINERY").select("o_orderkey", "c_name")


# ---- aggregates ----------------------------------------------------------------------------------------------------


@query(
    "agg_global",
    """
    SELECT count(*) AS lines, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_qty
    FROM lineitem
    """,
)
def agg_global(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        aggregates.exact_sum("l_extendedprice").alias("gross"),
        aggregates.exact_avg("l_quantity").alias("avg_qty"),
    )


@query(
    "agg_group",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM lineitem GROUP BY 1, 2
    """,
)
def agg_group(t: Tables) -> DataFrame:
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"),
        aggregates.exact_sum("l_quantity").alias("qty"),
        F.sum(net).cast("double").alias("revenue"),
    )


@query(
    "count_with_zero",
    """
    SELECT o_orderkey, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey
    """,
)
def count_with_zero(t: Tables) -> DataFrame:
    return joins.count_children(t.orders.select("o_orderkey"), t.lineitem, "o_orderkey", "l_orderkey", "lines")


@query(
    "group_fd",
    """
    SELECT c_custkey, c_name, c_mktsegment, count(o_orderkey) AS orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_mktsegment
    """,
)
def group_fd(t: Tables) -> DataFrame:
    """Group by the key only; columns that depend on it come along from the parent side."""
    parents = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return joins.count_children(parents, t.orders, "c_custkey", "o_custkey", "orders")


@query(
    "having_count",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12",
)
def having_count(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING n > 12", orders=t.orders
    )


LIFETIME_VALUE = """
    SELECT c_custkey, c_name,
           CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE)
             AS lifetime_value,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS shipped_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name
    """


@query("cond_agg_case", LIFETIME_VALUE)
def cond_agg_case(t: Tables) -> DataFrame:
    return aggregates.lifetime_value(
        t.customer, t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "F", "o_totalprice"
    ).select("c_custkey", "c_name", F.col("lifetime_value").cast("double").alias("lifetime_value"), "shipped_orders")


@query(
    "cond_agg_filter",
    """
    SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS shipped,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS pending
    FROM orders GROUP BY o_orderpriority
    """,
)
def cond_agg_filter(t: Tables) -> DataFrame:
    return t.spark.sql(
        """
        SELECT o_orderpriority,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS shipped,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS pending
        FROM {orders} GROUP BY o_orderpriority
        """,
        orders=t.orders,
    )


@query(
    "pivot_status",
    """
    SELECT o_custkey,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS shipped,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS pending,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS open
    FROM orders GROUP BY o_custkey
    """,
)
def pivot_status(t: Tables) -> DataFrame:
    """The pivot values are given, so Spark needs no extra pass to find them."""
    wide = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "P", "O"]).agg(aggregates.exact_sum("o_totalprice"))
    return wide.withColumnsRenamed({"F": "shipped", "P": "pending", "O": "open"})


@query(
    "agg_of_agg",
    """
    SELECT count(*) AS customers, CAST(sum(total) AS DOUBLE) / count(*) AS avg_total, CAST(max(total) AS DOUBLE) AS max_total
    FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey)
    """,
)
def agg_of_agg(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))
    return per_customer.agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum("total").cast("double") / F.count(F.lit(1))).alias("avg_total"),
        F.max("total").cast("double").alias("max_total"),
    )


@query(
    "top_group_single",
    """
    SELECT o.o_orderkey, o.o_custkey FROM orders o
    WHERE o.o_custkey = (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)
    """,
)
def top_group_single(t: Tables) -> DataFrame:
    return aggregates.rows_of_largest_group(t.orders, "o_custkey", ties=False).select("o_orderkey", "o_custkey")


@query(
    "top_group_ties",
    """
    WITH n AS (SELECT o_custkey, count(*) AS c FROM orders GROUP BY o_custkey)
    SELECT o.o_orderkey, o.o_custkey FROM orders o
    WHERE o.o_custkey IN (SELECT o_custkey FROM n WHERE c = (SELECT max(c) FROM n))
    """,
)
def top_group_ties(t: Tables) -> DataFrame:
    return aggregates.rows_of_largest_group(t.orders, "o_custkey", ties=True).select("o_orderkey", "o_custkey")


@query(
    "distinct_exact",
    "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS visitors FROM events GROUP BY 1",
)
def distinct_exact(t: Tables) -> DataFrame:
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("user_id").alias("visitors"))


@query(
    "distinct_approx",
    "SELECT event_type, count(DISTINCT user_id) AS exact, true AS within_5_percent FROM events GROUP BY event_type",
)
def distinct_approx(t: Tables) -> DataFrame:
    """Daily sketches merged per event type; the merged estimate must lie within five percent of the exact count."""
    estimate = aggregates.merged_distinct(t.events, ["event_type"], F.to_date("ts"), "user_id", "estimate")
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("estimate") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(estimate, "event_type").select("event_type", "exact", close.alias("within_5_percent"))


# ---- sorting and paging --------------------------------------------------------------------------------------------


@query("sort_multi", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY 1, 2 DESC NULLS LAST, 3")
def sort_multi(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").orderBy(
        F.col("c_mktsegment").asc_nulls_first(), F.col("c_acctbal").desc_nulls_last(), "c_custkey"
    )


@query(
    "sort_by_count",
    "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand ORDER BY parts DESC, p_brand",
)
def sort_by_count(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts")).orderBy(F.desc("parts"), "p_brand")


@query("topk_newest", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def topk_newest(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10)


@query("bottomk_oldest", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10")
def bottomk_oldest(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(10)


@query(
    "page_offset",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40",
)
def page_offset(t: Tables) -> DataFrame:
    return paging.page(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], skip=40, take=20)


@query(
    "page_keyset",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 0) ORDER BY o_orderdate, o_orderkey LIMIT 20
    """,
)
def page_keyset(t: Tables) -> DataFrame:
    start = {"o_orderdate": F.lit("1998-01-01").cast("timestamp_ntz"), "o_orderkey": F.lit(0)}
    return paging.page_after(t.orders.select("o_orderkey", "o_orderdate"), start, take=20)


# ---- set operations ------------------------------------------------------------------------------------------------


@query(
    "union_all",
    "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def union_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("nation")).unionByName(
        t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query(
    "union_distinct",
    "SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0",
)
def union_distinct(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k"))
    return returned.union(t.supplier.where("s_acctbal < 0").select("s_suppkey")).distinct()


def _names(t: Tables, brand: str) -> DataFrame:
    return t.part.where(F.col("p_brand") == brand).select("p_name")


@query(
    "set_intersect",
    "SELECT p_name FROM part WHERE p_brand = 'Brand#2' INTERSECT SELECT p_name FROM part WHERE p_brand = 'Brand#3'",
)
def set_intersect(t: Tables) -> DataFrame:
    return _names(t, "Brand#2").intersect(_names(t, "Brand#3"))


@query(
    "set_union",
    "SELECT p_name FROM part WHERE p_brand = 'Brand#2' UNION SELECT p_name FROM part WHERE p_brand = 'Brand#3'",
)
def set_union(t: Tables) -> DataFrame:
    return _names(t, "Brand#2").union(_names(t, "Brand#3")).distinct()


@query(
    "set_difference",
    """
    SELECT p_name, p_size FROM part WHERE p_brand = 'Brand#2' EXCEPT SELECT p_name, p_size FROM part WHERE p_brand = 'Brand#3'
    """,
)
def set_difference(t: Tables) -> DataFrame:
    first, second = [t.part.where(F.col("p_brand") == b).select("p_name", "p_size") for b in ("Brand#2", "Brand#3")]
    return first.subtract(second)


@query("set_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def set_dedupe(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type").distinct()
