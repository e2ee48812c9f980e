import pytest
from pyspark.sql import functions as F
from samples import bag, rows

from weftline.operators import changes, quality, views
from weftline.sources.snapshots import Snapshots
from weftline.sources.table_sets import TableSet


def test_update_then_delete(data):
    bumped = changes.update_where(data.users, F.col("name") == "Alice", {"age": F.lit(31)})
    left = changes.delete_where(bumped, F.col("name") == "Bob")
    assert bag(left, "name", "age") == [("Alice", 31), ("Charlie", 35), ("Diana", 28)]
    assert left.schema == data.users.schema


def test_null_conditions_change_nothing(data, spark):
    james = spark.createDataFrame([(5, "James", None)], data.users.schema)
    users = data.users.unionByName(james)
    assert [r[0] for r in rows(changes.increment(users, "age").orderBy("id"), "age")] == [31, 26, 36, 29, None]
    assert changes.delete_where(users, F.col("age") > 0).count() == 1
    assert changes.update_where(users, F.col("age") > 0, {"name": F.lit("x")}).where("name = 'James'").count() == 1


def test_update_sees_the_old_row(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    swapped = changes.update_where(frame, F.lit(True), {"a": F.col("b"), "b": F.col("a")})
    assert rows(swapped) == [(2, 1)]


def test_archive(data):
    big = (F.col("product") == "Widget") & (F.col("amount") > 100)
    moved, stay = changes.archive_split(data.sales, big)
    assert bag(moved, "id") == [(2,), (3,)] and bag(stay, "id") == [(1,), (4,), (5,), (6,), (7,)]
    assert bag(changes.archive_tag(data.sales, big).where("part = 'archive'"), "id") == [(2,), (3,)]
    assert bag(changes.changed_rows(data.sales, big, {"amount": F.lit(0)}, ["id", "amount"])) == [(2, 0), (3, 0)]


def test_upsert_takes_the_last_write(spark):
    base = spark.createDataFrame([("a", 1, 1, 0), ("b", 1, 1, 0)], "k string, v int, ts int, seq int")
    news = spark.createDataFrame([("a", 2, 5, 1), ("a", 3, 5, 2), ("c", 9, 1, 0), ("b", 7, 0, 9)], base.schema)
    assert bag(changes.upsert_latest(base, news, ["k"], ["ts", "seq"]), "k", "v") == [("a", 3), ("b", 1), ("c", 9)]


def test_ids_continue_after_the_largest(data):
    new = changes.assign_ids(data.books.select("title"), ["title"], "id", after=data.books.agg(F.max("id")))
    assert rows(new.orderBy("id"), "id", "title")[0] == (6, "A Wizard of Earthsea")
    assert bag(new, "id") == [(10,), (6,), (7,), (8,), (9,)]


def test_nested_records_become_two_tables(data, spark):
    records = spark.createDataFrame(
        [("b", [("b1", 1)]), ("a", [("a1", 1), ("a2", 2)]), ("c", [])], "name string, books array<struct<title:string,year:int>>"
    )
    parents, children = changes.nested_split(records, ["name"], "books", "author_id", after=data.authors.agg(F.max("id")))
    assert bag(parents, "author_id", "name") == [(5, "a"), (6, "b"), (7, "c")]
    assert bag(children) == [(5, "a1", 1), (5, "a2", 2), (6, "b1", 1)]


def test_cascade(data):
    authors, books = changes.cascade_delete(data.authors, data.books, "id", "author_id", F.col("name") == "Ted Chiang")
    assert bag(authors, "id") == [(1,), (3,), (4,)] and bag(books, "id") == [(1,), (2,), (5,)]


def test_checks(data, spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (9, "d")], "id int, v string")
    assert bag(quality.check_not_null(frame, ["id", "v"])) == [("id", 2), ("v", 1)]
    assert bag(quality.check_unique(frame, ["id"])) == [(1, 2)]
    assert bag(quality.check_foreign_key(frame, "id", data.authors, "id"), "v") == [("d",)]
    assert bag(quality.check_predicate(frame, F.col("id") < 9), "v") == [("d",)]


def test_quarantine_names_the_first_broken_rule(spark):
    frame = spark.createDataFrame([(1, 10), (2, -5), (3, None), (-4, -4)], "id int, v int")
    clean, refused = quality.quarantine_split(frame, {"positive": F.col("v") > 0, "known": F.col("id") > 0})
    assert bag(clean, "id") == [(1,), (3,)]
    assert bag(refused, "id", "reason") == [(-4, "positive"), (2, "positive")]


def test_snapshots(data, spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "t"))
    assert store.latest() is None
    with pytest.raises(ValueError):
        store.read()
    assert store.publish(data.users, "one") == 1
    assert store.publish(data.users, "one") == 1
    assert store.publish(changes.increment(store.read(), "age")) == 2
    assert store.read(1).agg(F.sum("age")).first()[0] == 118 and store.read().agg(F.sum("age")).first()[0] == 122
    assert store.append(data.users, "more") == 3 and store.read().count() == 8 and store.pending() == 2
    assert store.append(data.users, "more") == 3 and store.read().count() == 8
    assert store.clear() == 4 and store.read().count() == 0 and store.read(3).count() == 8
    assert store.read().schema == data.users.schema


def test_materialized_view_is_stale_until_refreshed(data, spark, tmp_path):
    base = {"orders": data.orders}

    def define():
        total = F.sum(F.when(F.col("status") == "shipped", F.col("total")))
        return base["orders"].groupBy("customer_id").agg(F.coalesce(total, F.lit(0)).alias("value"))

    view = views.MaterializedView(Snapshots(spark, str(tmp_path / "v")), define)
    base["orders"] = data.orders.unionByName(spark.createDataFrame([(7, 3, 1000, "shipped")], data.orders.schema))
    carol = F.col("customer_id") == 3
    assert rows(define().where(carol), "value") == [(1000,)]
    assert rows(view.read().where(carol), "value") == [(0,)]
    view.refresh()
    assert rows(view.read().where(carol), "value") == [(1000,)]


def test_plain_view_sees_new_rows(data, spark):
    view = views.create_view(data.orders.where("status <> 'cancelled'"), "active_orders_test")
    assert bag(view, "id") == [(1,), (2,), (4,), (5,), (6,)]


def test_incremental_aggregate_compacts_and_ignores_replays(data, spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "agg"))
    totals = views.IncrementalAggregate(store, ["status"], {"sum": "total"}, "n", compact_after=2)
    for i in (1, 2, 3, 4, 5, 6, 6, 2):
        totals.merge(data.orders.where(F.col("id") == i), f"b{i}")
    want = data.orders.groupBy("status").agg(F.sum("total").alias("sum"), F.count("*").alias("n"))
    assert bag(totals.read()) == bag(want)
    assert store.pending() <= 3


def test_merge_rewrites_the_touched_buckets_only(spark, tmp_path):
    """The cost of a merge does not grow with the number of merges before; files of other buckets stay as they are."""
    path = tmp_path / "parted"
    totals = views.BucketedAggregate(spark, str(path), ["k"], {"s": "v"}, "n", buckets=8)
    totals.merge(spark.range(1_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    files = lambda: {(f.parent.name, f.name) for f in path.rglob("*.parquet")}
    counts = set()
    for batch in range(1, 9):
        before = files()
        totals.merge(spark.createDataFrame([(5, batch), (5, batch)], "k long, v int"), batch)
        after = files()
        assert len({bucket for bucket, _ in before - after}) == 1 and len(before & after) == 7
        counts.add(len(after))
    assert counts == {8}
    got = {r.k: (r.s, r.n) for r in totals.read().collect()}
    assert len(got) == 1_000 and got[5] == (1 + 2 * sum(range(1, 9)), 17) and got[6] == (1, 1)


def test_half_written_batch_is_finished_by_its_replay(spark, tmp_path):
    """A batch that reached some buckets only: delivered again, it changes the others, and a third time nothing."""
    rows = spark.range(100).select((F.col("id") % 20).alias("k"), F.lit(2).alias("v"))
    whole = views.BucketedAggregate(spark, str(tmp_path / "whole"), ["k"], {"s": "v"}, "n", buckets=4)
    half = views.BucketedAggregate(spark, str(tmp_path / "half"), ["k"], {"s": "v"}, "n", buckets=4)
    for table in (whole, half):
        table.merge(rows, 1)
    reached = F.pmod(F.xxhash64("k"), F.lit(4)) < 2
    half.merge(rows.where(reached), 2)
    assert bag(half.read()) != bag(whole.read())
    for batch in (2, 2, 1):
        whole.merge(rows, batch)
        half.merge(rows, batch)
    assert bag(half.read()) == bag(whole.read()) == sorted(((k, 20, 10) for k in range(20)), key=repr)


def test_two_tables_change_together(spark, tmp_path):
    """A failure between the two writes leaves both as they were; the batch can be delivered again."""
    both = TableSet(spark, str(tmp_path / "set"))
    one, two = spark.range(3), spark.range(5)
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(ValueError):
        both.read("a")
    assert both.publish({"a": one, "b": one}, "first") == 1
    with pytest.raises(Exception, match="broken"):
        both.publish({"a": two, "b": broken}, "second")
    assert both.read("a").count() == both.read("b").count() == 3
    assert both.publish({"a": two, "b": two}, "second") == both.publish({"a": one, "b": one}, "second") == 2
    assert both.read("a").count() == both.read("b").count() == 5
