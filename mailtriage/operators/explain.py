"""Which features spoke for phishing, in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions.literals import among, mapping


def readable_reason(source: Column, value: Column, name_numeric: bool = False) -> Column:
    """Sentence for a feature; null for character n-grams, generic or unreadable ones.

    Numeric features are looked up after underscores became blanks, so by default none of
    them is named; ``name_numeric`` looks up the plain name instead.
    """
    text = F.trim(F.regexp_replace(F.replace(value, F.lit("_"), F.lit(" ")), r"\s+", " "))
    usable = (F.length(text) >= 3) & text.rlike("[A-Za-z]") & ~among(text, K.GENERIC_TOKENS)
    labels = mapping(K.NUMERIC_FEATURES)
    return (F.when(source == "numeric", F.try_element_at(labels, value if name_numeric else text))
            .when((source == "subject_word") & usable, F.concat(F.lit('Subject mentions "'), text, F.lit('"')))
            .when((source == "body_word") & usable, F.concat(F.lit('Body contains "'), text, F.lit('"'))))


def top_reasons(contributions: Column, limit: int = 5) -> Column:
    """array<struct<reason, impact>>: strongest positive contributions, one per reason.

    ``contributions`` is array<struct<reason, impact>> of one mail, so no shuffle is needed.
    """
    return F.transform(_strongest(contributions, limit), lambda x: F.struct(x["reason"].alias("reason"), F.bround(-x["k"], 4).alias("impact")))


def _strongest(contributions: Column, limit: int) -> Column:
    """array<struct<k, reason>>: the ``limit`` strongest reasons by negative impact, then name."""
    positive = F.filter(contributions, lambda c: (c["impact"] > 0) & c["reason"].isNotNull())
    ordered = F.array_sort(F.transform(positive, lambda c: F.struct((-c["impact"]).alias("k"), c["reason"].alias("reason"))))
    none = F.array().cast("array<struct<k:double,reason:string>>")
    # first position of a reason is its largest impact
    return F.aggregate(ordered, none, lambda found, x: F.when(
        (F.size(found) >= limit) | F.exists(found, lambda y: y["reason"] == x["reason"]), found).otherwise(F.concat(found, F.array(x))))


def top_reason_rows(mails: DataFrame, key: str = "email_id", limit: int = 5) -> DataFrame:
    """key, reason, impact, place from key and ``contributions``, an array of source, value, contribution.

    Every row is reduced to its own strongest reasons first: a reason that is among the strongest of a key is so in
    the row that holds its largest impact.  Rows of one key are then put together.
    """
    positive = F.filter("contributions", lambda c: c["contribution"] > 0)
    named = F.transform(positive, lambda c: F.struct(
        readable_reason(c["source"], c["value"]).alias("reason"), c["contribution"].alias("impact")))
    own = mails.select(key, F.inline(_strongest(named, limit)))
    best = own.groupBy(key, "reason").agg((-F.min("k")).alias("impact"))
    per_mail = best.groupBy(key).agg(F.collect_list(F.struct("reason", "impact")).alias("_c"))
    top = per_mail.select(key, F.posexplode(top_reasons(F.col("_c"), limit)).alias("_i", "_r"))
    return top.select(key, F.col("_r.reason").alias("reason"), F.col("_r.impact").alias("impact"),
                      (F.col("_i") + 1).alias("place"))
