import json
import random

import pytest
from pyspark.sql import functions as F
from samples import ARTICLE_TAGS, bag, rows

from weftline.functions import collections as arrays, jsonpath
from weftline.operators import nested


@pytest.fixture
def docs(data):
    return data.payloads.withColumn("v", F.parse_json("payload"))


def test_value_and_text(docs):
    signups = docs.where("type = 'signup'").orderBy("id")
    assert rows(signups.select(jsonpath.get_value(F.col("v"), "user")))[0] == ('"alice"',)
    assert rows(signups.select(jsonpath.get_text(F.col("v"), "source", "campaign"))) == [
        ("spring25",),
        ("spring25",),
        ("referral",),
    ]
    assert rows(signups.where(jsonpath.get_text(F.col("v"), "plan") == "pro"), "id") == [(1,), (5,)]


def test_items_become_rows(docs):
    items = nested.json_items(docs, "v", ["items"], "item")
    got = items.select(
        "id", jsonpath.get_text(F.col("item"), "sku").alias("sku"), jsonpath.get_as(F.col("item"), "int", "qty").alias("qty")
    )
    assert bag(got) == [(3, "A1", 2), (3, "B7", 1), (4, "A1", 5)]


def test_fields_of_unknown_documents(docs):
    fields = nested.json_fields(docs, "v").groupBy("key").count()
    assert dict(rows(fields)) == {"user": 5, "plan": 3, "source": 3, "items": 2, "total": 2}


def test_containment(docs):
    def ids(pattern):
        return [r[0] for r in bag(docs.where(jsonpath.contains(F.col("v"), pattern)), "id")]

    assert ids({"source": {"campaign": "spring25"}}) == [1, 2]
    assert ids({"campaign": "spring25"}) == []  # anchored at the root
    assert ids({"items": [{"sku": "A1"}]}) == [3, 4]
    assert ids({"items": [{"sku": "A1"}, {"qty": 1}]}) == [3]
    assert ids({"items": [{"sku": "A1", "qty": 1}]}) == []
    assert ids({"total": 59.0}) == [3]
    assert ids({"total": "59"}) == []
    assert ids({}) == [1, 2, 3, 4, 5]


def contains(value, pattern):
    """Containment spelled out, to test against."""
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and contains(value[k], p) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(contains(v, p) for v in value) for p in pattern)
    if isinstance(pattern, bool) or isinstance(value, bool) or pattern is None or value is None:
        return type(value) is type(pattern) and value == pattern
    number = (int, float)
    same_kind = isinstance(value, number) == isinstance(pattern, number) and isinstance(value, str) == isinstance(pattern, str)
    return same_kind and not isinstance(value, (dict, list)) and value == pattern


def test_containment_against_brute_force(spark):
    rng = random.Random(8)

    def make(depth):
        kind = rng.randrange(8 if depth else 5)
        if kind < 5:
            return rng.choice([1, 1.5, "a", "1", True, False, None, 0])
        if kind < 7:
            return {k: make(depth - 1) for k in rng.sample(["a", "b c", "d"], rng.randrange(3))}
        return [make(depth - 1) for _ in range(rng.randrange(3))]

    values = [make(3) for _ in range(300)]
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, doc string")
    frame = frame.withColumn("v", F.parse_json("doc")).persist()
    for pattern in [{"a": 1}, {}, [], {"a": {}}, {"b c": [1]}, {"a": None}, {"d": True}, [{"a": "1"}], {"a": {"d": 1.5}}, 1]:
        got = {r.id for r in frame.where(jsonpath.contains(F.col("v"), pattern)).select("id").collect()}
        assert got == {i for i, v in enumerate(values) if contains(v, pattern)}, pattern


def test_array_tests(data):
    tags = F.col("tags")
    assert bag(data.tags.where(F.array_contains("tags", "advanced")), "id") == [(2,), (4,)]
    assert bag(data.tags.where(arrays.overlaps(tags, ["postgres", "prisma"])), "id") == [(1,), (3,), (4,)]
    assert bag(data.tags.where(arrays.contains_all(tags, ["sql", "advanced"])), "id") == [(2,)]
    assert rows(data.tags.select("id", arrays.length_or_null(tags)).orderBy("id")) == [(1, 3), (2, 2), (3, 3), (4, 3)]
    assert nested.unnest(data.tags, tags, "tag").count() == 11


def test_empty_arrays(spark):
    frame = spark.createDataFrame([(1, []), (2, None)], "id int, a array<string>")
    assert nested.unnest(frame, F.col("a"), "x").count() == 0
    assert rows(frame.select(arrays.length_or_null(F.col("a")))) == [(None,), (None,)]
    assert rows(frame.select(F.size(arrays.or_empty(F.col("a"))))) == [(0,), (0,)]


def test_set_algebra(spark):
    a, b = [spark.createDataFrame([(m,) for m in ARTICLE_TAGS[k]], "m string").distinct() for k in "ab"]
    assert a.count() == 3
    assert bag(a.intersect(b)) == [("database",)]
    assert bag(a.union(b).distinct()) == [(m,) for m in ("database", "nosql", "postgres", "redis", "sql")]
    assert bag(a.subtract(b)) == [("nosql",), ("redis",)]


@pytest.mark.parametrize("start,stop", [(0, -1), (0, 4), (2, 3), (-3, -1), (-4, -2), (1, -2), (-4, 4), (5, 3), (-2, 1)])
def test_list_range_like_a_slice(spark, start, stop):
    frame = spark.createDataFrame([("k", i) for i in range(6)] + [("short", i) for i in range(2)], "k string, i int")
    got = nested.list_range(frame, ["k"], ["i"], start, stop)
    array = frame.groupBy("k").agg(F.array_sort(F.collect_list("i")).alias("a"))
    as_array = dict(rows(array.select("k", arrays.array_range(F.col("a"), start, stop))))
    for key, n in (("k", 6), ("short", 2)):
        first = max(0, start if start >= 0 else n + start)
        last = stop if stop >= 0 else n + stop
        want = list(range(n))[first : last + 1] if last >= first else []
        assert [r[0] for r in rows(got.where(F.col("k") == key).orderBy("i"), "i")] == want
        assert as_array[key] == want


def test_whole_numbers_and_quoted_keys_are_told_apart(spark):
    rows = [('{"id": 9007199254740993}',), ('{"id": 1.5}',), ('{"id": 2.0}',), ('{"id": 100000000000000000001}',), ('{"it\'s": 1}',)]
    docs = spark.createDataFrame(rows, "doc string").withColumn("v", F.parse_json("doc"))
    hits = lambda pattern: docs.where(jsonpath.contains(F.col("v"), pattern)).count()
    assert hits({"id": 9007199254740992}) == 0 and hits({"id": 9007199254740993}) == 1
    assert hits({"id": 2}) == 1 and hits({"id": 1}) == 0 and hits({"id": 1.5}) == 1
    assert hits({"id": 10**20 + 1}) == 1 and hits({"id": 10**20}) == 0
    assert hits({"it's": 1}) == 1
    with pytest.raises(ValueError):
        jsonpath.path_of("'\"")


def test_needles_on_different_pages_belong_to_one_document(spark):
    rows = [(1, '{"a": 1, "items": [{"n": 1}]}'), (1, '{"a": 1, "items": [{"n": 2}]}'), (2, '{"a": 1, "items": [{"n": 1}]}'), (3, '{"a": 2, "items": []}')]
    pages = spark.createDataFrame(rows, "id int, doc string").withColumn("v", F.parse_json("doc"))
    found = lambda pattern: sorted(r.id for r in nested.paged_containing(pages, "id", "v", pattern, "items").collect())
    assert found({"a": 1, "items": [{"n": 1}, {"n": 2}]}) == [1]
    assert found({"items": [{"n": 1}]}) == [1, 2] and found({"items": []}) == [1, 2, 3] and found({"a": 2}) == [3]
    assert found({"items": None}) == []


@pytest.mark.parametrize("limit", [None, 10])
def test_wide_rows_in_pages(spark, limit):
    cells = [(k, f"c{i:03}", i) for k, n in (("a", 25), ("b", 10), ("c", 1), (None, 11)) for i in range(n)]
    pages = nested.wide_pages(spark.createDataFrame(cells, "k string, name string, v int"), ["k"], "name", "v", 10, limit)
    got = {(r.k, r.page): sorted(r.columns_.items()) for r in pages.withColumnRenamed("columns", "columns_").collect()}
    assert {k: len(v) for k, v in got.items()} == {("a", 0): 10, ("a", 1): 10, ("a", 2): 5, ("b", 0): 10, ("c", 0): 1, (None, 0): 10, (None, 1): 1}
    assert all(v == [(f"c{i:03}", i) for i in range(10 * page, 10 * page + len(v))] for (_, page), v in got.items())
