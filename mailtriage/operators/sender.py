"""Sender reputation lookup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import headers as H, urls as U
from mailtriage.operators.lookup import lookup
from mailtriage.schemas import missing_columns


def sender_category(category: Column, score: Column, total: Column) -> Column:
    """Rare domains below 90 are suspicious; values that are no integers change nothing."""
    rare = (total.try_cast("int") <= 5) & (score.try_cast("int") < 90)
    return F.when(F.coalesce(rare, F.lit(False)), "suspicious").otherwise(category)


def sender_reputation(mails: DataFrame, table: DataFrame | None, sender: str = "from", key: str = "email_id",
                      by: str = "host", suffixes: Iterable[str] | None = None, small: bool = False) -> DataFrame:
    """Mails with ``sender_*`` reputation columns and ``lookup_status``.

    ``by='host'`` looks up the full host, ``by='registrable'`` its registrable domain.
    Without a table, or when a needed column is missing, every host is unknown.
    """
    host = H.mailbox_host(F.col(f"`{sender}`"))
    if by == "registrable":
        host = F.when(host != "", U.registrable(host, suffixes)).otherwise("")
    rows = mails.withColumn("_host", F.nullif(host, F.lit("")))  # without a host nothing is looked up
    if table is None or missing_columns(table, K.REPUTATION_COLUMNS):
        found = rows.withColumn("_rep", F.lit(None).cast(
            "struct<domain:string,legitimacy_score:int,total_occurrences:bigint,in_spam:bigint,"
            "in_ham:bigint,sources:string,category:string>"))
    else:
        # the first row in list order wins when a domain is listed twice
        order = F.struct(-F.col("legitimacy_score").try_cast("int"), F.col("domain"))
        dim = table.groupBy(F.lower(F.trim("domain")).alias("_host")).agg(
            F.min_by(F.struct(*K.REPUTATION_COLUMNS), order).alias("_rep"))
        found = lookup(rows, dim, "_host", F.col(key), small)
    r, none = F.col("_rep"), F.col("_host").isNull()
    known = r.isNotNull() & ~none

    def value(name, unknown):
        return F.when(known, r[name]).when(~none, unknown)

    text = {
        "sender_host": F.when(none, "Not Found").when(known, r["domain"]).otherwise(F.col("_host")),
        "sender_sources": F.when(none, "Not Found").when(known, r["sources"]).otherwise("none"),
        "sender_category": F.when(none, "Not Found").when(known, sender_category(
            r["category"], r["legitimacy_score"], r["total_occurrences"])).otherwise("unknown"),
        "lookup_status": F.when(none, "not_found").when(known, "matched").otherwise("unknown"),
    }
    numbers = {
        "sender_score": value("legitimacy_score", 0), "sender_occurrences": value("total_occurrences", 0),
        "sender_in_spam": value("in_spam", 0), "sender_in_ham": value("in_ham", 0),
    }
    return found.withColumns(text | numbers).drop("_host", "_rep")
