"""Array and map expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def or_empty(a: Column, element_type: str = "string") -> Column:
    """The array, or an empty one in place of NULL."""
    return F.coalesce(a, F.array().cast(f"array<{element_type}>"))


def contains_all(a: Column, needles: Sequence) -> Column:
    """True when every needle is in the array."""
    return F.size(F.array_except(F.array(*[F.lit(n) for n in needles]), a)) == 0


def overlaps(a: Column, needles: Sequence) -> Column:
    """True when at least one needle is in the array."""
    return F.arrays_overlap(a, F.array(*[F.lit(n) for n in needles]))


def length_or_null(a: Column) -> Column:
    """Number of elements, NULL for an empty array."""
    return F.nullif(F.size(a), F.lit(0)).cast("long")


def array_range(a: Column, start: int, stop: int) -> Column:
    """Elements ``start`` to ``stop``, both included, counted from 0; negative positions count from the end."""
    n = F.size(a)
    first = F.greatest(F.lit(start) if start >= 0 else n + start, F.lit(0))
    last = F.least(F.lit(stop) if stop >= 0 else n + stop, n - 1)
    return F.slice(a, first + 1, F.greatest(last - first + 1, F.lit(0)))


def fields_of(name: str, value: str) -> Column:
    """Aggregate (name, value) rows of a group into a map sorted by name. The names of a group must be distinct."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, value))))


def map_text(m: Column) -> Column:
    """``a=1,b=2`` for a map, in its stored order."""
    return F.concat_ws(",", F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"])))
