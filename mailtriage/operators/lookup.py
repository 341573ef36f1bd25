"""Joining facts to a dimension that may be large, with keys that may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_BYTES = 64 << 20


def is_small(dim: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a staged dimension, as text, stay under a number of bytes."""
    width = sum(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in dim.columns)
    return (dim.agg(F.sum(width)).first()[0] or 0) <= limit


def lookup(facts: DataFrame, dim: DataFrame, key: str, row_key: Column | None = None,
           small: bool = False, salts: int = 0) -> DataFrame:
    """Left join of facts to a dimension with one row per key.

    ``small`` means the caller has checked the dimension with :func:`is_small`; it is then
    broadcast.  Otherwise it is a plain join: adaptive execution measures the partitions
    and splits those that a common key makes large, so only what is hot is repeated.
    ``salts`` is for dimensions with fewer keys than tasks: each of their rows is repeated
    so often, and facts pick their salt from ``row_key``.
    """
    if small:
        return facts.join(F.broadcast(dim), key, "left")
    if not salts:
        return facts.join(dim, key, "left")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(row_key), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns that later filters and projections see as plain values.

    The optimizer copies the expression of an ordinary computed column into every filter
    that is pushed below it.  Output of a generator is not copied, so long expressions are
    evaluated once per row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
