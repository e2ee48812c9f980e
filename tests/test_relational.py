import pytest
from pyspark.sql import functions as F
from samples import bag, rows

from weftline.functions.scalars import hash_bucket, int_div, int_or_null
from weftline.operators import aggregates, joins, paging
from weftline.operators.ordered import with_group_stats
from weftline.sources import tables as src


def test_filter_and_sort(data):
    older = data.users.where("age > 27").orderBy(F.desc("age"))
    assert rows(older, "name", "age") == [("Charlie", 35), ("Alice", 30), ("Diana", 28)]
    assert rows(data.users.where("age >= 28").orderBy("age"), "name") == [("Diana",), ("Alice",), ("Charlie",)]


def test_null_comparison_matches_nothing(data):
    some = data.users.unionByName(data.users.limit(1).withColumn("age", F.lit(None).cast("int")))
    assert some.where("age != 30").count() == 3


def test_between_or_like(data):
    year, title = F.col("year"), F.col("title")
    assert bag(data.books.where(year.between(1970, 2010)), "year") == [(1974,), (2002,)]
    assert bag(data.books.where((year < 1970) | (year > 2015)), "year") == [(1968,), (2019,)]
    assert data.books.where(title.like("%the%")).count() == 0
    assert bag(data.books.where(title.ilike("%the%")), "title") == [("The Dispossessed",), ("The Fifth Season",)]


def test_global_aggregate(data):
    got = data.books.agg(F.count("*"), F.min("year"), F.max("year"), F.avg("year"), F.round(F.avg("year"))).first()
    assert tuple(got) == (5, 1968, 2019, 1995.6, 1996.0)


def test_children_are_counted_with_zero(data):
    counted = joins.count_children(data.authors, data.books, "id", "author_id", "n")
    assert bag(counted, "id", "n") == [(1, 2), (2, 2), (3, 1), (4, 0)]
    assert bag(counted.where("n > 1"), "id") == [(1,), (2,)]


def test_semi_and_anti(data):
    on = data.authors.id == data.books.author_id
    assert bag(data.authors.join(data.books, on, "left_semi"), "id") == [(1,), (2,), (3,)]
    assert bag(data.authors.join(data.books, on, "left_anti"), "id") == [(4,)]


def test_largest_group_with_and_without_ties(data):
    assert bag(aggregates.rows_of_largest_group(data.books, "author_id", ties=True), "id") == [(1,), (2,), (3,), (4,)]
    assert bag(aggregates.rows_of_largest_group(data.books, "author_id", ties=False), "id") == [(1,), (2,)]


def test_top_and_pages(data):
    books = data.books.select("title", "year")
    assert rows(books.orderBy(F.desc("year")).limit(2), "year") == [(2019,), (2015,)]
    assert rows(paging.page(books, ["year"], skip=2, take=2), "year") == [(2002,), (2015,)]
    assert rows(paging.page_after(books, {"year": F.lit(1974)}, take=2), "year") == [(2002,), (2015,)]


def test_keyset_pages_walk_the_whole_table(data):
    frame = data.dated.select("amount", "id")
    seen, last = [], {"amount": F.lit(-1), "id": F.lit(0)}
    while page := rows(paging.page_after(frame, last, 2)):
        seen += page
        last = {"amount": F.lit(page[-1][0]), "id": F.lit(page[-1][1])}
    assert seen == sorted(rows(frame))


def test_lifetime_value_and_view_filter(data):
    value = aggregates.lifetime_value(
        data.customers, data.orders, "id", "customer_id", F.col("status") == "shipped", "total"
    )
    assert [(n, int(v), c) for n, v, c in bag(value, "name", "lifetime_value", "shipped_orders")] == [
        ("Alice", 150, 2),
        ("Bob", 200, 1),
        ("Carol", 0, 0),
    ]
    assert bag(value.where("lifetime_value > 100"), "name") == [("Alice",), ("Bob",)]
    assert bag(data.orders.where("status <> 'cancelled'"), "id") == [(1,), (2,), (4,), (5,), (6,)]


def test_pivot_leaves_null_for_missing_cells(data):
    wide = data.orders.groupBy("customer_id").pivot("status", ["shipped", "pending", "cancelled"]).sum("total")
    assert bag(wide) == [(1, 150, None, 80), (2, 200, 30, None), (3, None, 75, None)]


def test_rows_above_their_group_average(data):
    stamped = with_group_stats(data.sales, ["region"], mean=F.avg("amount")).where("amount > mean")
    assert bag(stamped, "region", "amount") == [("North", 100), ("North", 150), ("South", 200)]


def test_group_stats_keep_rows_without_a_key(data, spark):
    frame = spark.createDataFrame([(1, None), (2, None), (3, "a")], "v int, k string")
    assert bag(with_group_stats(frame, ["k"], total=F.sum("v")), "v", "total") == [(1, 3), (2, 3), (3, 3)]


def test_regions_that_beat_the_average(data):
    totals = data.sales.groupBy("region").agg(F.sum("amount").alias("total"))
    assert rows(totals.where(F.col("total") > totals.agg(F.avg("total")).scalar())) == [("South", 410)]


def test_generated_products(spark):
    products = src.cyclic_products(src.number_series(spark, 1, 10_000), "n", 20, 100, 10)
    assert products.where("category_id = 5").count() == 500
    assert products.where("category_id = 5 and price > 50").count() == 300
    assert products.where("price > 50").count() == 5900
    assert tuple(products.where("id = 1").first()) == (1, "Product 1", 2, 11)


def test_integer_quotient_and_buckets(spark):
    n = spark.range(0, 10_001)
    assert n.select(int_div("id", 20).alias("page")).agg(F.max("page"), F.count_distinct("page")).first()[:] == (500, 501)
    sizes = n.groupBy(hash_bucket(8, "id").alias("b")).count().agg(F.min("count"), F.count("*")).first()
    assert sizes[0] > 1000 and sizes[1] == 8


def test_integers_from_text(spark):
    frame = spark.createDataFrame([("7",), (" -3 ",), ("x",), ("",), (None,), ("99999999999",), ("1.5",)], "s string")
    assert rows(frame.select(int_or_null("s"))) == [(7,), (-3,), (None,), (None,), (None,), (None,), (None,)]


def test_include_one_and_many(data):
    nested = joins.include_one(data.books, data.authors, "author_id", "id", "author")
    assert bag(nested.select("title", "author.name"))[0] == ("A Wizard of Earthsea", "Ursula K. Le Guin")
    many = joins.include_many(data.authors, data.books, "id", "author_id", "books", order=["-year", "id"], page_size=10)
    titles = {r.id: [b.title for b in r.books] for r in many.collect()}
    assert titles[1] == ["The Dispossessed", "A Wizard of Earthsea"] and titles[4] == []


def test_children_are_nested_in_pages(data):
    many = joins.include_many(data.authors, data.books, "id", "author_id", "books", order=["id"], page_size=1)
    got = [(r.id, r.page, [b.id for b in r.books]) for r in many.orderBy("id", "page").collect()]
    assert got == [(1, 0, [1]), (1, 1, [2]), (2, 0, [3]), (2, 1, [4]), (3, 0, [5]), (4, 0, [])]


def test_merged_sketches_are_close(spark):
    frame = spark.range(100_000).select((F.col("id") % 7).alias("day"), F.lit("x").alias("k"), (F.col("id") % 20_000).alias("v"))
    got = aggregates.merged_distinct(frame, ["k"], F.col("day"), "v", "n").first().n
    assert abs(got - 20_000) < 1_000


def test_append_and_clone(data):
    empty = src.like_schema(data.users)
    assert empty.schema == data.users.schema and empty.count() == 0
    grown = src.append_rows(empty, data.users.select("id", "name"), {"age": F.lit(18)})
    assert bag(grown, "id", "age") == [(1, 18), (2, 18), (3, 18), (4, 18)]
    with pytest.raises(ValueError):
        src.append_rows(empty, data.users.withColumn("other", F.lit(1)))


def test_lookup_that_must_succeed(data):
    assert src.first_or_raise(data.authors, F.col("name") == "Ted Chiang", ["id"])["id"] == 2
    with pytest.raises(LookupError):
        src.first_or_raise(data.authors, F.col("name") == "nobody", ["id"])


def test_relations_are_listed(data, spark):
    data.users.createOrReplaceTempView("listed_users")
    data.books.createOrReplaceTempView("listed_books")
    assert src.list_relations(spark, "listed_*") == [("listed_books", "TEMPORARY"), ("listed_users", "TEMPORARY")]


def test_documents_of_any_shape(spark, tmp_path):
    (tmp_path / "docs.json").write_text('{"a": 1}\n{"b": {"c": [1, 2]}}\nnot json\n')
    docs = src.read_documents(spark, str(tmp_path))
    assert bag(docs, "malformed") == [(False,), (False,), (True,)]


def test_clustered_files_prune(data, spark, tmp_path):
    path = str(tmp_path / "products")
    products = src.cyclic_products(src.number_series(spark, 1, 10_000), "n", 20, 100, 10)
    src.write_clustered(products, path, ["category_id"], ["price"], files=16)
    found = spark.read.parquet(path).where("category_id = 5 and price > 50")
    assert found.count() == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category_id" in plan and "GreaterThan(price,50)" in plan
