"""Corpus preparation: raw messages to the cleaned, deduplicated, labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import headers as H, text as X, urls as U
from mailtriage.operators import quality as Q
from mailtriage.sources.sinks import write_mails


def clean_column(name: str, c: Column) -> Column:
    """The cleaning rule of each column."""
    if name in ("from", "to", "sender"):
        return H.normalise_addresses(c)
    return X.clean_corpus_text(c, keep_tags=name == "message_id")


def parsed_messages(raw: DataFrame, message: str = "message", key: str = "email_id") -> DataFrame:
    """Distinct messages with header columns, body, urls and num_urls beside them."""
    unique = Q.drop_duplicate_messages(raw, message, key)
    found = U.raw_urls(F.col(message))
    return H.parse_headers(unique, message).withColumn("urls", found).withColumn(
        "num_urls", F.coalesce(F.size("urls"), F.lit(0)))


def clean_corpus(raw: DataFrame, message: str = "message", key: str = "email_id") -> DataFrame:
    """The 11 final columns.  Projections only, between two deduplications."""
    filled = Q.backfill_headers(parsed_messages(raw, message, key))
    texts = filled.withColumn("urls", F.concat_ws(", ", "urls")).withColumn(
        "urls", F.nullif("urls", F.lit("")))
    cleaned = texts.withColumns({c: clean_column(c, F.col(f"`{c}`")) for c in K.EMAIL_COLUMNS[:9]})
    return Q.drop_duplicate_rows(cleaned.select(*K.EMAIL_COLUMNS))


def run(raw: DataFrame, path: str, fmt: str = "parquet", **names) -> None:
    write_mails(clean_corpus(raw, **names), path, fmt)
