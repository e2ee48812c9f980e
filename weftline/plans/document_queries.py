"""JSON documents, arrays and maps over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions import collections as arrays, jsonpath
from weftline.operators import joins, nested
from weftline.plans.registry import query
from weftline.sources.tables import Tables


#: Items in one page of an order's document; small, so that ordinary orders have several pages.
PAGE_ITEMS = 3


def order_docs(t: Tables) -> DataFrame:
    """Orders as JSON documents with nested customer and items, one document per page of ``PAGE_ITEMS`` items."""
    items = joins.include_many(
        t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"),
        "o_orderkey",
        "l_orderkey",
        "items",
        order=["l_linenumber", "l_partkey", "l_suppkey"],
        page_size=PAGE_ITEMS,
    )
    rows = items.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = F.transform(
        "items",
        lambda i: F.struct(
            i["l_linenumber"].alias("line"),
            i["l_partkey"].alias("sku"),
            i["l_suppkey"].alias("supplier"),
            i["l_returnflag"].alias("flag"),
        ),
    )
    doc = F.struct(
        F.col("o_orderkey").alias("order"),
        F.col("o_orderpriority").alias("priority"),
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("customer"),
        lines.alias("items"),
    )
    return rows.select("o_orderkey", "page", F.to_json(doc).alias("doc"))


def parsed_docs(t: Tables) -> DataFrame:
    return order_docs(t).select("o_orderkey", "page", F.parse_json("doc").alias("v"))


def order_heads(t: Tables) -> DataFrame:
    """The first page of each order, for what all its pages carry."""
    return parsed_docs(t).where("page = 0")


@query(
    "json_build",
    f"""
    WITH placed AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS place FROM lineitem
    )
    SELECT o_orderkey, CAST(coalesce(place // {PAGE_ITEMS}, 0) AS BIGINT) AS page, CAST(to_json({{
             'order': o_orderkey, 'priority': o_orderpriority,
             'customer': {{'name': c_name, 'segment': c_mktsegment}},
             'items': coalesce(list({{'line': l_linenumber, 'sku': l_partkey, 'supplier': l_suppkey, 'flag': l_returnflag}}
                                    ORDER BY place) FILTER (WHERE l_orderkey IS NOT NULL), [])}}) AS VARCHAR) AS doc
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN placed ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_orderpriority, c_name, c_mktsegment, page
    """,
)
def json_build(t: Tables) -> DataFrame:
    return order_docs(t).select("o_orderkey", "page", "doc")


@query(
    "json_ingest",
    """
    SELECT 'event' AS source, 'k' AS key, 'BIGINT' AS kind, count(*) AS docs FROM events
    UNION ALL
    SELECT 'order', k, kind, count(*) FROM orders,
           (VALUES ('order', 'BIGINT'), ('priority', 'STRING'), ('customer', 'OBJECT'), ('items', 'ARRAY')) AS f(k, kind)
    GROUP BY k, kind
    """,
)
def json_ingest(t: Tables) -> DataFrame:
    """Documents of different shapes in one column; the fields found and their kinds, per source."""
    events = t.events.select(F.lit("event").alias("source"), F.parse_json("props").alias("v"))
    orders = order_heads(t).select(F.lit("order").alias("source"), "v")
    fields = nested.json_fields(events.unionByName(orders), "v")
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    return fields.groupBy("source", "key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("docs"))


@query(
    "json_get_value",
    """
    SELECT o_orderkey, '"' || c_mktsegment || '"' AS as_json, c_mktsegment AS as_text
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def json_get_value(t: Tables) -> DataFrame:
    v = F.col("v")
    return order_heads(t).select(
        "o_orderkey",
        jsonpath.get_value(v, "customer", "segment").alias("as_json"),
        jsonpath.get_text(v, "customer", "segment").alias("as_text"),
    )


@query("json_get_text", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_get_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(
    "json_nested_path",
    """
    SELECT o_orderkey, c_name AS customer, first_sku
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN (SELECT l_orderkey, first(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS first_sku
               FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    """,
)
def json_nested_path(t: Tables) -> DataFrame:
    return order_heads(t).select(
        "o_orderkey",
        jsonpath.get_text(F.col("v"), "customer", "name").alias("customer"),
        jsonpath.get_as(F.col("v"), "bigint", "items", 0, "sku").alias("first_sku"),
    )


@query(
    "json_filter",
    "SELECT event_id, event_type FROM events WHERE event_type = 'signup' AND json_extract_string(props, '$.k') = '42'",
)
def json_filter(t: Tables) -> DataFrame:
    return t.events.where((F.col("event_type") == "signup") & (F.get_json_object("props", "$.k") == "42")).select(
        "event_id", "event_type"
    )


@query(
    "json_contains",
    """
    SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE c_mktsegment = 'BUILDING'
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_linenumber = 1)
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 4)
    """,
)
def json_contains(t: Tables) -> DataFrame:
    pattern = {"customer": {"segment": "BUILDING"}, "items": [{"flag": "R", "line": 1}, {"line": 4}]}
    return nested.paged_containing(parsed_docs(t), "o_orderkey", "v", pattern, "items")


@query(
    "lateral_items",
    """
    SELECT o_orderkey, o_orderpriority AS priority, l_partkey AS sku, l_linenumber AS line
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def lateral_items(t: Tables) -> DataFrame:
    docs = parsed_docs(t).withColumn("priority", jsonpath.get_text(F.col("v"), "priority"))
    return nested.json_items(docs, "v", ["items"], "item").select(
        "o_orderkey",
        "priority",
        jsonpath.get_as(F.col("item"), "bigint", "sku").alias("sku"),
        jsonpath.get_as(F.col("item"), "int", "line").alias("line"),
    )


@query(
    "json_cast_agg",
    "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total FROM events GROUP BY 1",
)
def json_cast_agg(t: Tables) -> DataFrame:
    k = jsonpath.get_as(F.parse_json("props"), "int", "k")
    return t.events.groupBy("event_type").agg(F.sum(k).alias("total"))


# ---- arrays and maps -----------------------------------------------------------------------------------------------

WORDS = "string_split(p_name, ' ')"


def tagged(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", "p_size", F.split("p_name", " ").alias("tags"))


@query(
    "array_build",
    f"SELECT p_partkey, CASE WHEN p_size > 10 THEN array_to_string({WORDS}, '|') ELSE '' END AS tags FROM part",
)
def array_build(t: Tables) -> DataFrame:
    some = F.when(F.col("p_size") > 10, F.col("tags"))
    return tagged(t).select("p_partkey", F.concat_ws("|", arrays.or_empty(some)).alias("tags"))


@query("array_any", f"SELECT p_partkey FROM part WHERE list_contains({WORDS}, 'red')")
def array_any(t: Tables) -> DataFrame:
    return tagged(t).where(F.array_contains("tags", "red")).select("p_partkey")


@query("array_overlap", f"SELECT p_partkey FROM part WHERE list_has_any({WORDS}, ['small', 'bolt'])")
def array_overlap(t: Tables) -> DataFrame:
    return tagged(t).where(arrays.overlaps(F.col("tags"), ["small", "bolt"])).select("p_partkey")


@query("array_contains_all", f"SELECT p_partkey FROM part WHERE list_has_all({WORDS}, ['small', 'ring'])")
def array_contains_all(t: Tables) -> DataFrame:
    return tagged(t).where(arrays.contains_all(F.col("tags"), ["small", "ring"])).select("p_partkey")


@query(
    "array_length",
    f"SELECT p_partkey, nullif(len(list_filter({WORDS}, lambda w: starts_with(w, 'r'))), 0) AS r_words FROM part",
)
def array_length(t: Tables) -> DataFrame:
    r_words = F.filter("tags", lambda w: w.startswith("r"))
    return tagged(t).select("p_partkey", arrays.length_or_null(r_words).alias("r_words"))


@query("array_unnest", f"SELECT p_partkey, unnest({WORDS}) AS tag FROM part")
def array_unnest(t: Tables) -> DataFrame:
    return nested.unnest(tagged(t), F.col("tags"), "tag").select("p_partkey", "tag")


@query(
    "array_collect",
    """
    SELECT c_custkey, string_agg(p, ',' ORDER BY p) AS priorities, count(*) AS n FROM (
      SELECT DISTINCT o_custkey AS c_custkey, o_orderpriority AS p FROM orders)
    GROUP BY c_custkey
    """,
)
def array_collect(t: Tables) -> DataFrame:
    """A set per customer. It holds at most one entry per priority, so its size does not depend on the orders."""
    sets = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("s")
    )
    return sets.select("c_custkey", F.concat_ws(",", "s").alias("priorities"), F.size("s").cast("long").alias("n"))


@query(
    "list_range",
    """
    SELECT user_id, event_id, -r AS pos FROM (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r <= 3
    """,
)
def list_range(t: Tables) -> DataFrame:
    """The last three elements of each user's list."""
    rows = t.events.select("user_id", "event_id", "ts")
    return nested.list_range(rows, ["user_id"], ["ts", "event_id"], -3, -1).drop("ts")


@query(
    "map_get_all",
    """
    SELECT o_custkey, string_agg(s || '=' || n, ',' ORDER BY s) AS fields, max(CASE WHEN s = 'F' THEN n END) AS finished
    FROM (SELECT o_custkey, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_custkey
    """,
)
def map_get_all(t: Tables) -> DataFrame:
    """All fields of a record, and one of them. A record has one field per status."""
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    records = counts.groupBy("o_custkey").agg(arrays.fields_of("o_orderstatus", "n").alias("m"))
    return records.select(
        "o_custkey", arrays.map_text(F.col("m")).alias("fields"), F.try_element_at("m", F.lit("F")).alias("finished")
    )


@query(
    "wide_row_pages",
    """
    WITH cells AS (SELECT event_type, CAST(user_id AS VARCHAR) AS name, count(*) AS n FROM events GROUP BY 1, 2),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY name) - 1) // 50 AS page FROM cells)
    SELECT event_type, page, string_agg(name || '=' || n, ',' ORDER BY name) AS columns FROM placed GROUP BY 1, 2
    """,
)
def wide_row_pages(t: Tables) -> DataFrame:
    """One wide record per event type with a column per user, in pages of 50 columns."""
    cells = t.events.groupBy("event_type", F.col("user_id").cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    pages = nested.wide_pages(cells, ["event_type"], "name", "n", 50)
    return pages.withColumn("columns", arrays.map_text(F.col("columns")))


@query(
    "wide_row",
    """
    SELECT user_id, day, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS columns
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
    GROUP BY user_id, day
    """,
)
def wide_row(t: Tables) -> DataFrame:
    """Sparse columns per partition key (user, day): one entry per event type that occurred."""
    counts = t.events.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy("user_id", "day").agg(arrays.fields_of("event_type", "n").alias("m"))
    return rows.select("user_id", "day", arrays.map_text(F.col("m")).alias("columns"))
