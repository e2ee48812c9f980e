"""Joins that aggregate or nest the many side before it meets the one side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weftline.operators.ordered import OrderedGroups
from weftline.plans.slicing import By


def lookup(facts: DataFrame, names: DataFrame, fact_key: str, name_key: str, how: str = "inner") -> DataFrame:
    """Attach columns of a dimension table by key.

    No hint is given: the size check is Spark's own. Catalyst (or AQE, from the measured size) broadcasts the dimension
    while it is below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it is a sort-merge join with skew splitting.
    """
    return facts.join(names, facts[fact_key] == names[name_key], how)


def count_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, out: str) -> DataFrame:
    """Children per parent, 0 for parents without any.

    Children are counted before the join, so a parent with very many children costs one row, not a skewed join.
    """
    counts = children.groupBy(F.col(child_key).alias("__child")).agg(F.count(F.lit(1)).alias("__n"))
    joined = parents.join(counts, parents[parent_key] == F.col("__child"), "left")
    return joined.withColumn(out, F.coalesce("__n", F.lit(0))).drop("__child", "__n")


def include_one(rows: DataFrame, parents: DataFrame, key: str, parent_key: str, out: str) -> DataFrame:
    """Each row with its parent as a nested struct, NULL when there is none."""
    nested = parents.select(F.col(parent_key).alias("__parent"), F.struct(*parents.columns).alias(out))
    return rows.join(nested, F.col(key) == F.col("__parent"), "left").drop("__parent")


def numbered_children(children: DataFrame, child_key: str, order: Sequence[str | By], out: str, limit: int | None = None) -> DataFrame:
    """Each child with its position among its parent's children, from 0; groups of any size."""
    return OrderedGroups(children, [child_key], order, limit).number(out, start=0).df


def include_many(
    parents: DataFrame, children: DataFrame, key: str, child_key: str, out: str, order: Sequence[str | By],
    page_size: int, limit: int | None = None,
) -> DataFrame:
    """Each parent with its children as pages: ordered arrays of ``page_size`` structs, numbered by ``page`` from 0.

    An array is built in one task, so pages bound what a task holds whatever the size of a parent; no child is left out. A
    parent without children has one empty page. ``numbered_children`` has the same content with a row per child.
    """
    place = numbered_children(children, child_key, order, "__at", limit)
    chunks = place.groupBy(F.col(child_key).alias("__parent"), F.expr(f"__at div {page_size}").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("__at", F.struct(*children.columns).alias("__child")))).alias("__all")
    )
    joined = parents.join(chunks, parents[key] == F.col("__parent"), "left")
    items = F.transform("__all", lambda c: c["__child"])
    nothing = F.array().cast(f"array<{children.schema.simpleString()}>")
    return joined.select(
        *[parents[c] for c in parents.columns],
        F.coalesce("page", F.lit(0).cast("long")).alias("page"),
        F.coalesce(items, nothing).alias(out),
    )
