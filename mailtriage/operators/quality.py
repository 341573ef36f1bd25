"""Counts, profiles, deduplication and header backfill of a mail table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import headers as H, text as X


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def _per_column(df: DataFrame, aggregates: dict, value: str) -> DataFrame:
    """One aggregate per column in one pass, turned into one row per column."""
    wide = df.agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return wide.unpivot([], list(aggregates), "column_name", value)


def null_counts(df: DataFrame) -> DataFrame:
    counts = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    return _per_column(df, counts, "n_null").orderBy("n_null", "column_name")


def profile(df: DataFrame) -> DataFrame:
    """column_name, data_type, non_null, n_rows."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = {c: F.count(F.col(f"`{c}`")) for c in df.columns}
    rows = df.agg(F.count("*").alias("n")).scalar()
    return _per_column(df, counts, "non_null").select(
        "column_name", F.element_at(types, F.col("column_name")).alias("data_type"),
        "non_null", rows.alias("n_rows"))


def drop_duplicate_messages(df: DataFrame, message: str = "message", key: str = "email_id") -> DataFrame:
    """Keep the first copy (smallest key) of every message; keys are unique.

    Only hashes and keys are aggregated, in fixed-width buffers before the shuffle, so a
    message that fills a third of the table leaves each input partition as a single row;
    the kept keys then pick their rows.
    """
    kept = df.groupBy(F.xxhash64(message).alias("_a"), F.md5(F.col(message).cast("binary")).alias("_h")).agg(F.min(key).alias(key))
    return df.join(kept.select(key), key, "left_semi")


def duplicate_report(df: DataFrame, message: str = "message") -> DataFrame:
    """Rows before and after dropping duplicate messages."""
    groups = df.groupBy(F.sha2(F.col(message), 256).alias("_h")).agg(F.count("*").alias("c"))
    return groups.agg(F.sum("c").alias("n_before"), F.count("*").alias("n_after"))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def empty_messages(df: DataFrame, message: str = "message") -> DataFrame:
    return df.where(F.col(message) == "")


def non_ascii_rows(df: DataFrame, message: str = "message") -> DataFrame:
    return df.where(X.has_non_ascii(F.col(message)))


def backfill_headers(df: DataFrame, body: str = "body") -> DataFrame:
    """Fill blank header columns from a header block on top of the body; add ``body_text``
    and one ``<column>_filled`` flag per header column."""
    parts = df.withColumn("_p", X.split_header_body(F.col(body))).withColumn("_h", H.header_map(F.col("_p.header")))
    filled, flags = {}, {}
    for name, column in K.BACKFILL_COLUMNS.items():
        if column not in df.columns:
            continue
        old, new = F.col(f"`{column}`"), F.try_element_at("_h", F.lit(name))
        use = H.is_blank(old) & new.isNotNull()
        filled[column] = F.when(use, new).otherwise(old)
        flags[f"{column}_filled"] = use
    core = F.when(F.col("_p.body") != "", F.col("_p.body")).otherwise(F.coalesce(body, F.lit("")))
    return (parts.withColumns(flags).withColumns(filled)
            .withColumn("body_text", X.html_to_text(X.drop_header_lines(core))).drop("_p", "_h"))


def backfill_counts(df: DataFrame) -> DataFrame:
    """Filled cells per header column of a :func:`backfill_headers` result."""
    flags = {c.removesuffix("_filled"): F.count_if(F.col(c)) for c in df.columns if c.endswith("_filled")}
    return _per_column(df, flags, "n_filled")
