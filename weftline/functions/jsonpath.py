"""JSON access by path and by containment, on variants (``parse_json``) and on JSON text."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, functions as F


def path_of(*steps: str | int) -> str:
    """``path_of("a", "b c", 0)`` is ``$['a']['b c'][0]``; a key may hold one kind of quotes, not both."""

    def part(step: str | int) -> str:
        if isinstance(step, int):
            return f"[{step}]"
        if "'" in step and '"' in step:
            raise ValueError(f"a path cannot name the key {step!r}, which holds both kinds of quotes")
        return f'["{step}"]' if "'" in step else f"['{step}']"

    return "$" + "".join(map(part, steps))


def get_value(variant: Column, *steps: str | int) -> Column:
    """The value at a path as JSON text: strings keep their quotes, NULL when the path is missing."""
    return F.to_json(F.try_variant_get(variant, path_of(*steps), "variant"))


def get_text(variant: Column, *steps: str | int) -> Column:
    """The value at a path as plain text."""
    return F.try_variant_get(variant, path_of(*steps), "string")


def get_as(variant: Column, type_name: str, *steps: str | int) -> Column:
    """The value at a path cast to a type; a value that does not fit raises an error, a missing path is NULL."""
    return F.variant_get(variant, path_of(*steps), type_name)


def contains(variant: Column, pattern: Any) -> Column:
    """True when ``variant`` contains ``pattern`` (dicts, lists and scalars as from ``json.loads``).

    An object contains a pattern object when it has all its keys with contained values, at that very place. An array
    contains a pattern array when each pattern element is contained in some element. Scalars must agree in type and
    value. The pattern becomes one expression over typed path reads, so no Python runs per row.
    """
    return F.coalesce(_contains(variant, pattern), F.lit(False))


def _holds(pattern: Any) -> Callable[[Column], Column]:
    return lambda item: contains(item, pattern)


def _contains(v: Column, pattern: Any) -> Column:
    kind = F.schema_of_variant(v)
    if pattern is None:
        return F.is_variant_null(v)
    if isinstance(pattern, dict):
        test = kind.startswith("OBJECT")
        for key, sub in pattern.items():
            test = test & contains(F.try_variant_get(v, path_of(key), "variant"), sub)
        return test
    if isinstance(pattern, list):
        # An empty array has no element type: its items are read only when it has some.
        items = F.try_variant_get(v, "$", "array<variant>")
        test = kind.startswith("ARRAY")
        for sub in pattern:
            test = test & F.exists(items, _holds(sub))
        return test
    if isinstance(pattern, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(pattern))
    if isinstance(pattern, int):
        # Whole numbers are compared as such, since doubles cannot tell neighbours beyond 2^53 apart.
        bound = -(2**63) <= pattern < 2**63
        short = F.try_variant_get(v, "$", "bigint") == F.lit(pattern) if bound else F.lit(False)
        long = F.try_variant_get(v, "$", "decimal(38,0)") == F.lit(Decimal(pattern)) if abs(pattern) < 10**38 else F.lit(False)
        near = kind.isin("DOUBLE") | kind.startswith("DECIMAL")
        return F.when(kind == "BIGINT", short).when(kind.rlike(r"^DECIMAL\(\d+,0\)$"), long).otherwise(
            near & (F.try_variant_get(v, "$", "double") == F.lit(float(pattern)))
        )
    if isinstance(pattern, float):
        number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        return number & (F.try_variant_get(v, "$", "double") == F.lit(float(pattern)))
    return (kind == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(pattern))
