"""Scalar column helpers. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(c: Column | str) -> Column:
    """Exact two-digit decimal, so sums do not depend on the order in which rows arrive."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def int_div(a: Column | str, b: int) -> Column:
    """Integer quotient, truncated toward zero."""
    name = F.col(a) if isinstance(a, str) else a
    return F.call_function("div", name, F.lit(b))


def hash_bucket(buckets: int, *columns: Column | str) -> Column:
    """Bucket 0..buckets-1 from Spark's 64-bit hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def portable_bucket(buckets: int, c: Column) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of MD5; other engines compute the same bucket."""
    return F.pmod(F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp in the session zone (UTC here)."""
    name = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(name.cast("timestamp"))


def micros_to_ntz(c: Column) -> Column:
    """The zone-less timestamp of an epoch in microseconds (session zone UTC)."""
    return F.timestamp_micros(c).cast("timestamp_ntz")


def int_or_null(c: Column | str) -> Column:
    """The integer a text spells, NULL for any other text.

    Spelling is tested first: a failing ``try_cast`` costs an exception per row, a failing pattern does not.
    """
    text = F.col(c) if isinstance(c, str) else c
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("int"))
