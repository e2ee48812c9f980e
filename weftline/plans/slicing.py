"""Cut groups that are too large for one task into ordered slices.

A window over ``partitionBy(key)`` moves a whole group to one task. That is the right plan until one key holds a large
share of the table. ``slice_groups`` counts rows per key (one column, partial aggregation), and only when some group is
larger than ``limit`` gives its rows a slice number that follows the requested order: they are written once, parted by range, and a
slice is a range of that write. So there may be any number of slices, their borders never leave Spark, and what follows reads
a stored table in which a row's slice is fixed. All other groups keep slice 0 and are processed in one piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.session import cut_lineage, scratch_path

SLICE = "__slice"
PART = "__part"
ROWS_PER_GROUP = 4_000_000  # largest group that one task handles in one piece
SMALL_GROUPS = 100_000  # keys of large groups are broadcast up to here


@dataclass(frozen=True)
class By:
    """One sort column. NULLs come first when ascending and last when descending unless stated."""

    name: str
    ascending: bool = True
    nulls_first: bool | None = None

    @property
    def null_leads(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def reversed(self) -> By:
        return replace(self, ascending=not self.ascending, nulls_first=not self.null_leads)

    def column(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_first() if self.null_leads else c.asc_nulls_last()
        return c.desc_nulls_first() if self.null_leads else c.desc_nulls_last()


def sort_columns(order: Sequence[By | str]) -> list[By]:
    """Accept plain names next to ``By`` entries; a leading ``-`` means descending."""
    out = []
    for entry in order:
        if isinstance(entry, By):
            out.append(entry)
        elif entry.startswith("-"):
            out.append(By(entry[1:], ascending=False))
        else:
            out.append(By(entry))
    return out


@dataclass(frozen=True)
class Sliced:
    """Rows with a ``__slice`` column. ``large`` says whether any group was cut, ``slices`` into how many pieces at most."""

    df: DataFrame
    large: bool
    slices: int = 0


def slice_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], limit: int | None = None, min_slices: int = 1
) -> Sliced:
    """Add ``__slice``: 0 for groups of normal size, 1.. in sort order for groups with more than ``limit`` rows.

    Reads ``df`` twice if there are large groups (to count and to part the rows), once if there are none or no keys.
    """
    limit = limit or ROWS_PER_GROUP
    if not keys:
        rows = cut_lineage(df)
        total = rows.count()
        n = max(min_slices, -(-2 * total // limit))
        if not total or n == 1:
            return Sliced(rows.withColumn(SLICE, F.lit(0)), large=False)
        return Sliced(_ranged(rows, order, n), True, n)

    counts = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    large = cut_lineage(counts.where(F.col("__rows") > limit))
    groups, total = large.agg(F.count("*"), F.sum("__rows")).first()
    if not groups:
        return Sliced(df.withColumn(SLICE, F.lit(0)), large=False)
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    names = large.drop("__rows").withColumn(PART, F.lit(True))
    marked = df.join(F.broadcast(names) if groups <= SMALL_GROUPS else names, same, "left").select(*df.columns, F.col(PART).isNotNull().alias(PART))
    path = scratch_path(df.sparkSession, "parted")
    marked.write.partitionBy(PART).parquet(path)
    parted = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.BooleanType())])).parquet(path)
    small = parted.where(~F.col(PART)).drop(PART).withColumn(SLICE, F.lit(0))
    n = -(-2 * total // limit)
    sliced = _ranged(parted.where(F.col(PART)).drop(PART), [*(By(k) for k in keys), *order], n)
    return Sliced(small.unionByName(sliced), True, n)


def _ranged(rows: DataFrame, order: Sequence[By], n: int) -> DataFrame:
    """``rows`` written in ``n`` ranges of the order, each with the number of its range from 1 as slice. Equal rows share a range."""
    ranged = rows.repartitionByRange(n, *[entry.column() for entry in order])
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id() + 1))
