"""Table changes, integrity checks and ledgers over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money
from weftline.operators import changes, ledger, quality
from weftline.operators.joins import include_many
from weftline.plans.registry import query
from weftline.session import cut_lineage, scratch_path
from weftline.sources.snapshots import Snapshots
from weftline.sources.tables import Tables


@query(
    "update_where",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'R' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    """,
)
def update_where(t: Tables) -> DataFrame:
    big = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    return changes.update_where(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), big, {
        "o_orderstatus": F.lit("R")
    }).drop("o_totalprice")


@query("update_increment", "SELECT p_partkey, p_size + 1 AS p_size FROM part")
def update_increment(t: Tables) -> DataFrame:
    return changes.increment(t.part.select("p_partkey", "p_size"), "p_size")


@query("delete_where", "SELECT c_custkey, c_name FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'FURNITURE')")
def delete_where(t: Tables) -> DataFrame:
    gone = (F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "FURNITURE")
    return changes.delete_where(t.customer, gone).select("c_custkey", "c_name")


@query("truncate_reload", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def truncate_reload(t: Tables) -> DataFrame:
    """A stored table is emptied, keeps its columns, and is filled again with the finished orders."""
    store = Snapshots(t.spark, scratch_path(t.spark, "reload"))
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    store.publish(rows)
    store.clear()
    store.append(rows.where("o_orderstatus = 'F'"))
    return store.read()


@query(
    "archive_split",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 'archive' ELSE 'remaining' END AS part
    FROM orders
    """,
)
def archive_split(t: Tables) -> DataFrame:
    moved = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)
    return changes.archive_tag(t.orders, moved).select("o_orderkey", "part")


@query(
    "upsert_latest",
    """
    SELECT user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
    """,
)
def upsert_latest(t: Tables) -> DataFrame:
    """Profiles as of mid January, overwritten by all later changes."""
    rows = t.events.select("user_id", "event_type", "value", "ts", "event_id")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    base, later = rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)
    return changes.upsert_latest(base, later, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "value")


@query(
    "assign_ids",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + (SELECT max(o_orderkey) FROM orders) AS new_id
    FROM orders
    """,
)
def assign_ids(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    last = t.orders.agg(F.max("o_orderkey"))
    return changes.assign_ids(rows, ["o_orderdate", "o_orderkey"], "new_id", after=last).drop("o_orderdate")


@query(
    "nested_split",
    """
    SELECT p.parent_id, l_partkey AS sku, l_linenumber AS line
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS parent_id FROM orders) p
    JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def nested_split(t: Tables) -> DataFrame:
    """Orders that arrive with their lines nested inside, stored as two tables linked by a new parent id."""
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("sku"), F.col("l_linenumber").alias("line"), "l_suppkey"
    )
    keys = t.orders.select("o_orderkey")
    arrived = include_many(keys, lines, "o_orderkey", "l_orderkey", "lines", order=["line", "sku", "l_suppkey"], page_size=4)
    nested = cut_lineage(arrived)  # nested records come as stored data
    _, children = changes.nested_split(nested, ["o_orderkey"], "lines", "parent_id", part="page")
    return children.select("parent_id", "sku", "line")


@query(
    "cascade_delete",
    """
    SELECT 'customer' AS kind, c_custkey AS id FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT 'order', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def cascade_delete(t: Tables) -> DataFrame:
    parents, children = changes.cascade_delete(t.customer, t.orders, "c_custkey", "o_custkey", F.col("c_acctbal") < 0)
    return parents.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id")).unionByName(
        children.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"))
    )


@query(
    "returning_changed",
    """
    SELECT c_custkey, c_name, 'PREMIUM' AS c_mktsegment FROM customer WHERE c_acctbal > 9000 AND c_mktsegment = 'BUILDING'
    """,
)
def returning_changed(t: Tables) -> DataFrame:
    rich = (F.col("c_acctbal") > 9000) & (F.col("c_mktsegment") == "BUILDING")
    return changes.changed_rows(
        t.customer, rich, {"c_mktsegment": F.lit("PREMIUM")}, ["c_custkey", "c_name", "c_mktsegment"]
    )


# ---- integrity -----------------------------------------------------------------------------------------------------


@query(
    "check_not_null",
    """
    SELECT 'l_partkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NOT NULL AND l_partkey IS NULL) AS violations
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def check_not_null(t: Tables) -> DataFrame:
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return quality.check_not_null(joined, ["l_partkey", "o_orderdate"])


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique(t: Tables) -> DataFrame:
    return quality.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_fk",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def check_fk(t: Tables) -> DataFrame:
    """Lines whose order is missing once pending orders were taken out."""
    kept = t.orders.where("o_orderstatus <> 'P'")
    return quality.check_foreign_key(t.lineitem, "l_orderkey", kept, "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query("check_predicate", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)")
def check_predicate(t: Tables) -> DataFrame:
    return quality.check_predicate(t.customer, F.col("c_acctbal") >= 0).select("c_custkey", "c_acctbal")


@query(
    "quarantine_split",
    """
    SELECT CASE WHEN c_acctbal < 0 THEN 'negative balance' WHEN c_mktsegment = 'FURNITURE' THEN 'closed segment'
                ELSE 'accepted' END AS outcome, c_custkey
    FROM customer
    """,
)
def quarantine_split(t: Tables) -> DataFrame:
    rules = {"negative balance": F.col("c_acctbal") >= 0, "closed segment": F.col("c_mktsegment") != "FURNITURE"}
    clean, refused = quality.quarantine_split(t.customer, rules)
    return clean.select(F.lit("accepted").alias("outcome"), "c_custkey").unionByName(
        refused.select(F.col("reason").alias("outcome"), "c_custkey")
    )


# ---- ledgers -------------------------------------------------------------------------------------------------------

ENTRIES_SQL = """
      e AS (
        SELECT o_orderdate AS batch, o_custkey AS account, -(CAST(floor(o_totalprice) AS BIGINT) % 3000) AS amount FROM orders
        UNION ALL
        SELECT o_orderdate, xor(o_custkey, 1), CAST(floor(o_totalprice) AS BIGINT) % 3000 FROM orders),
      netted AS (
        SELECT * FROM (SELECT batch, account, sum(amount) AS delta, count(*) AS n FROM e GROUP BY 1, 2)
        LEFT JOIN customer ON c_custkey = account),
      alone AS (
        SELECT batch, CAST(sum(n) AS BIGINT) AS entries, CAST(sum(delta) AS BIGINT) AS net,
               bool_and(coalesce(c_acctbal + delta >= 0, false)) AS candidate
        FROM netted GROUP BY batch),
      reserved AS (
        SELECT batch, CAST(c_acctbal AS DECIMAL(18,2)) + sum(delta) OVER (PARTITION BY account ORDER BY batch) AS rest
        FROM netted SEMI JOIN (SELECT batch FROM alone WHERE candidate) USING (batch) WHERE delta < 0),
      judged AS (
        SELECT batch, entries, net, candidate AND batch NOT IN (SELECT batch FROM reserved WHERE rest < 0) AS posted
        FROM alone)"""


def transfers(t: Tables) -> DataFrame:
    """Every order moves money from its customer to the neighbouring account; the orders of a day are one batch."""
    amount = F.floor("o_totalprice") % 3000
    day = F.col("o_orderdate").alias("batch")
    debit = t.orders.select(day, F.col("o_custkey").alias("account"), (-amount).alias("amount"))
    credit = t.orders.select(day, F.col("o_custkey").bitwiseXOR(F.lit(1)).alias("account"), amount.alias("amount"))
    return debit.unionByName(credit)


def accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("account"), money("c_acctbal").alias("balance"))


@query("ledger_post_batch", f"WITH {ENTRIES_SQL} SELECT batch, entries, net, posted FROM judged")
def ledger_post_batch(t: Tables) -> DataFrame:
    """Which days can be posted as a whole, with the check that each day's entries sum to zero."""
    return ledger.judge_batches(accounts(t), transfers(t))


@query(
    "ledger_balances",
    f"""
    WITH {ENTRIES_SQL}
    SELECT c_custkey AS account, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + coalesce(d, 0) AS DOUBLE) AS balance
    FROM customer LEFT JOIN (
      SELECT account, sum(amount) AS d FROM e JOIN judged USING (batch) WHERE posted GROUP BY account) ON account = c_custkey
    """,
)
def ledger_balances(t: Tables) -> DataFrame:
    after = ledger.post_batches(accounts(t), transfers(t))
    return after.select("account", F.col("balance").cast("double").alias("balance"))


SIGNED_SQL = """
      b AS (SELECT event_id, user_id, ts,
                   sum(CASE WHEN event_type = 'purchase' THEN -3 ELSE 1 END * CAST(value AS DECIMAL(18,2)))
                     OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS balance
            FROM events)"""


def balances(t: Tables) -> DataFrame:
    sign = F.when(F.col("event_type") == "purchase", -3).otherwise(1)
    rows = t.events.select("event_id", "user_id", "ts", (sign * money("value")).alias("amount"))
    return ledger.running_balance(rows, "user_id", ["ts", "event_id"], F.col("amount"))


@query(
    "ledger_running_balance",
    f"WITH {SIGNED_SQL} SELECT event_id, user_id, CAST(balance AS DOUBLE) AS balance, balance < 0 AS overdrawn FROM b",
)
def ledger_running_balance(t: Tables) -> DataFrame:
    return balances(t).select(
        "event_id", "user_id", F.col("balance").cast("double").alias("balance"), (F.col("balance") < 0).alias("overdrawn")
    )


@query(
    "ledger_first_violation",
    f"""
    WITH {SIGNED_SQL}
    SELECT user_id, event_id, CAST(balance AS DOUBLE) AS balance FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM b WHERE balance < 0) WHERE r = 1
    """,
)
def ledger_first_violation(t: Tables) -> DataFrame:
    first = ledger.first_violation(balances(t), "user_id", ["ts", "event_id"])
    return first.select("user_id", "event_id", F.col("balance").cast("double").alias("balance"))
