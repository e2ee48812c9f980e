"""Integrity checks as jobs: what an enforced constraint would have refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations) for every column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations")


def check_unique(df: DataFrame, keys: Sequence[str], out: str = "copies") -> DataFrame:
    """Key values that occur more than once. Rows with a NULL in the key never violate, as in SQL."""
    known = df.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def check_foreign_key(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose parent is missing; a NULL reference is allowed."""
    referenced = parents.select(F.col(parent_key).alias("__parent"))
    rows = children.where(F.col(child_key).isNotNull())
    return rows.join(referenced, F.col(child_key) == F.col("__parent"), "left_anti")


def check_predicate(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; NULL passes, as in a CHECK constraint."""
    return df.where(~F.coalesce(condition, F.lit(True)))


def with_reason(df: DataFrame, rules: dict[str, Column], out: str = "reason") -> DataFrame:
    """Name of the first rule a row breaks, NULL for a clean row. A rule that is NULL passes."""
    broken = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(out, F.coalesce(*broken, F.lit(None).cast("string")))


def quarantine_split(df: DataFrame, rules: dict[str, Column], out: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(clean rows, refused rows with the reason). A bad row does not hold back the good ones."""
    marked = with_reason(df, rules, out)
    return marked.where(F.col(out).isNull()).drop(out), marked.where(F.col(out).isNotNull())
