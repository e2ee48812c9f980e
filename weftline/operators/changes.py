"""Table changes as transforms: each takes the rows of one version and returns the rows of the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.ordered import OrderedGroups, join_same
from weftline.plans.slicing import By


def _holds(condition: Column) -> Column:
    """A condition that is NULL does not select the row."""
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; all new values see the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {n: F.when(condition, v.cast(types[n])).otherwise(F.col(n)).alias(n) for n, v in values.items()}
    )


def increment(df: DataFrame, column: str, by: int | float = 1) -> DataFrame:
    """Add ``by`` on every row; NULL stays NULL."""
    return update_where(df, F.lit(True), {column: F.col(column) + by})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows that meet the condition; a NULL condition keeps the row."""
    return df.where(~_holds(condition))


def changed_rows(df: DataFrame, condition: Column, values: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """The rows an update touches, with the given columns after the change."""
    return update_where(df.where(_holds(condition)), F.lit(True), values).select(*columns)


def archive_split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to move, rows that stay). Every row is in exactly one of the two."""
    return df.where(_holds(condition)), df.where(~_holds(condition))


def archive_tag(df: DataFrame, condition: Column, out: str = "part") -> DataFrame:
    """The same split as one column, for one pass that writes both parts with ``partitionBy(out)``."""
    return df.withColumn(out, F.when(_holds(condition), "archive").otherwise("remaining"))


def upsert_latest(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` values. Both sides have the same columns.

    ``max_by`` aggregates on the map side, so a key with very many changes is reduced before the shuffle.
    """
    rows = base.unionByName(changes)
    winner = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("__row")
    return rows.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(winner).select("__row.*")


def assign_ids(df: DataFrame, order: Sequence[str | By], out: str, after: DataFrame | None = None) -> DataFrame:
    """Dense ids in the given order (unique columns), continuing after the single value held by ``after``.

    The table is numbered in slices with a carry, so it is never sorted in one task.
    """
    numbered = OrderedGroups(df, [], order).number(out).df
    if after is None:
        return numbered
    return numbered.withColumn(out, F.col(out) + F.coalesce(after.scalar(), F.lit(0)))


def nested_split(
    records: DataFrame, natural_key: Sequence[str], children: str, out: str, after: DataFrame | None = None,
    part: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Parents and children of nested records as two tables linked by a new parent id.

    ``records`` has one row per natural key with an array of structs ``children``; when large parents come in several
    rows, ``part`` names the column that numbers them from 0.
    """
    heads = records.where(F.col(part) == 0) if part else records
    parents = assign_ids(heads.drop(children, *([part] if part else [])), list(natural_key), out, after)
    with_id = join_same(records.select(*natural_key, children), parents.select(*natural_key, out), natural_key)
    exploded = with_id.select(out, F.explode(children).alias("__child")).select(out, "__child.*")
    return parents, exploded


def cascade_delete(
    parents: DataFrame, children: DataFrame, key: str, child_key: str, condition: Column
) -> tuple[DataFrame, DataFrame]:
    """(parents, children) after deleting the parents that meet the condition together with their children."""
    gone = parents.where(_holds(condition)).select(F.col(key).alias("__gone"))
    kept = children.join(gone, children[child_key] == F.col("__gone"), "left_anti")
    return delete_where(parents, condition), kept
