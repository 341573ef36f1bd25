"""Constant lists and maps as one parsed expression each, which builds plans faster than
one literal column per entry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def _sql(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def strings(items: Iterable[str]) -> Column:
    return F.expr("cast(array(" + ", ".join(map(_sql, items)) + ") as array<string>)")


def no_strings() -> Column:
    return F.expr("cast(array() as array<string>)")


def mapping(pairs: Mapping) -> Column:
    return F.expr("map(" + ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in pairs.items()) + ")")


def among(c: Column, items: Iterable[str]) -> Column:
    """Is the value in a short constant list?"""
    return F.array_contains(strings(items), c)
