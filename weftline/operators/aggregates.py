"""Aggregations that stay exact and absorb hot keys in the partial step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.scalars import money


def exact_sum(column: str) -> Column:
    """Sum of a two-digit amount, added up as a decimal so the order of rows cannot change the last digit."""
    return F.sum(money(column)).cast("double")


def exact_avg(column: str) -> Column:
    """Average of a two-digit amount: exact sum over the number of known values."""
    return F.sum(money(column)).cast("double") / F.count(column)


def lifetime_value(
    customers: DataFrame, orders: DataFrame, key: str, order_key: str, shipped: Column, amount: str
) -> DataFrame:
    """Shipped total and shipped order count for every customer, 0 for customers without orders.

    Orders are aggregated per customer first; the join then meets one row per customer on either side.
    """
    per_customer = orders.groupBy(F.col(order_key).alias("__customer")).agg(
        F.sum(F.when(shipped, money(amount))).alias("__value"), F.count_if(shipped).alias("__orders")
    )
    joined = customers.join(per_customer, F.col(key) == F.col("__customer"), "left")
    return joined.select(
        *customers.columns,
        F.coalesce("__value", F.lit(0).cast("decimal(18,2)")).alias("lifetime_value"),
        F.coalesce("__orders", F.lit(0)).alias("shipped_orders"),
    )


def rows_of_largest_group(df: DataFrame, key: str, ties: bool) -> DataFrame:
    """Rows of the group with the most rows: all tied groups, or the one with the smallest key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    if ties:
        winners = counts.where(F.col("__n") == counts.agg(F.max("__n")).scalar())
    else:
        winners = counts.orderBy(F.desc("__n"), F.asc(key)).limit(1)
    return df.join(winners.select(key), key, "left_semi")


def merged_distinct(df: DataFrame, keys: Sequence[str], part: Column, value: str, out: str) -> DataFrame:
    """Approximate distinct count per ``keys`` from one sketch per ``part``.

    The daily (or hourly) sketches are what a job would store; merging them needs no second look at the rows.
    """
    sketches = df.groupBy(*keys, part.alias("__part")).agg(F.hll_sketch_agg(value).alias("__sketch"))
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("__sketch")).alias(out))
