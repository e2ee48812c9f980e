"""Pages of a sorted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def page(df: DataFrame, order: Sequence[str | Column], skip: int, take: int) -> DataFrame:
    """Rows ``skip`` .. ``skip + take`` of the sorted table. Spark plans this as a top-k of ``skip + take`` rows."""
    return df.orderBy(*order).offset(skip).limit(take)


def page_after(df: DataFrame, last: dict[str, Column], take: int, descending: Sequence[str] = ()) -> DataFrame:
    """The next ``take`` rows after the row with the values ``last``, ordered by its columns, ascending unless named.

    Nulls come first in ascending and last in descending order, as Spark sorts them. The start is a filter on the sort
    columns, so a late page costs no more than the first and the filter on the leading column reaches the parquet scan.
    """
    names = list(last)
    after = F.lit(False)
    for name in reversed(names):
        after = _beyond(name, last[name], name in descending) | (F.col(name).eqNullSafe(last[name]) & after)
    lead = names[0]
    if lead in descending:
        start = (F.col(lead) <= last[lead]) | F.col(lead).isNull()
    else:
        start = (F.col(lead) >= last[lead]) | last[lead].isNull()
    order = [F.desc(name) if name in descending else F.asc(name) for name in names]
    return df.where(start & after).orderBy(*order).limit(take)


def _beyond(name: str, value: Column, descending: bool) -> Column:
    """The column comes after the value in its order; never null."""
    if descending:
        return F.coalesce(F.col(name) < value, F.col(name).isNull() & value.isNotNull())
    return F.coalesce(F.col(name) > value, F.col(name).isNotNull() & value.isNull())
