"""Moving between rows, nested documents and lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.jsonpath import contains, path_of
from weftline.operators.ordered import OrderedGroups, join_same, top_per_group
from weftline.plans.slicing import By, sort_columns


def unnest(df: DataFrame, array: Column, out: str) -> DataFrame:
    """One row per array element; rows with an empty or missing array vanish."""
    return df.withColumn(out, F.explode(array))


def json_items(df: DataFrame, variant: str, steps: Sequence[str | int], out: str) -> DataFrame:
    """One row per element of a JSON array, each as a variant ``out``. Documents without that array vanish.

    The document column itself is dropped, since a copy beside every element would multiply it; read what you need from
    it before.
    """
    narrow = df.withColumn("__items", F.try_variant_get(F.col(variant), path_of(*steps), "variant")).drop(variant)
    each = df.sparkSession.tvf.variant_explode(F.col("__items").outer())
    return narrow.lateralJoin(each).where(F.col("key").isNull()).drop("__items", "pos", "key").withColumnRenamed("value", out)


def json_fields(df: DataFrame, variant: str) -> DataFrame:
    """One row per top-level field of a JSON object: adds ``key`` and ``value`` (a variant), drops the document.

    Use it to take in documents whose fields are not known beforehand.
    """
    each = df.sparkSession.tvf.variant_explode(F.col(variant).outer())
    return df.lateralJoin(each).where(F.col("key").isNotNull()).drop(variant, "pos")


def paged_containing(pages: DataFrame, key: str, variant: str, pattern: dict, paged: str) -> DataFrame:
    """Keys of the documents that contain ``pattern``, where each document comes in pages of its array field ``paged``.

    All pages of a document carry its other fields. Elements of the pattern's array may be found on different pages.
    """
    head = {k: sub for k, sub in pattern.items() if k != paged}
    needles = pattern.get(paged)
    if needles is None and paged in pattern:
        head, needles = pattern, []
    each = [{paged: []}, *({paged: [needle]} for needle in needles)] if isinstance(needles, list) and paged in pattern else []
    some = pages.where(contains(F.col(variant), head))
    if not each:
        return some.select(key).distinct()
    found = some.groupBy(key).agg(*[F.bool_or(contains(F.col(variant), part)).alias(f"__{k}") for k, part in enumerate(each)])
    every = F.forall(F.array(*[F.col(f"__{k}") for k in range(len(each))]), lambda x: x)
    return found.where(every).select(key)


def list_range(df: DataFrame, keys: Sequence[str], order: Sequence[str | By], start: int, stop: int) -> DataFrame:
    """Elements ``start`` to ``stop`` of each key's list, both included, counted from 0; negatives count from the end.

    Adds ``pos``, counted from the front for a start at the front and from the end (-1, -2, ..) for one at the end. A
    range that touches only one end is a top-n per group, which Spark limits on the map side.
    """
    if start >= 0 and stop >= 0:
        rows = top_per_group(df, keys, order, stop + 1, "pos").withColumn("pos", F.col("pos") - 1)
        return rows.where(F.col("pos") >= start)
    if start < 0 and stop < 0:
        backwards = [e.reversed() for e in sort_columns(order)]
        rows = top_per_group(df, keys, backwards, -start, "pos").withColumn("pos", -F.col("pos"))
        return rows.where(F.col("pos") <= stop)
    numbered = OrderedGroups(df, keys, order).number("pos", start=0).df
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    first = F.lit(start) if start >= 0 else F.col("__n") + start
    last = F.lit(stop) if stop >= 0 else F.col("__n") + stop
    return join_same(numbered, sizes, keys).where(F.col("pos").between(first, last)).drop("__n")


def wide_pages(cells: DataFrame, keys: Sequence[str], name: str, value: str, page_size: int, limit: int | None = None) -> DataFrame:
    """Sparse columns per key as maps of at most ``page_size`` entries: (keys, page, columns), pages from 0 in the order of the names.

    A key may have any number of columns; its cells are numbered, in slices if there are very many, and a page is a row. ``cells``
    has one row per key and name.
    """
    numbered = OrderedGroups(cells, keys, [name], limit).number("__n", start=0).df
    paged = numbered.withColumn("page", F.floor(F.col("__n") / page_size))
    return paged.groupBy(*keys, "page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, value)))).alias("columns"))
