"""Numeric and text features of a mail; training and scoring share this code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import headers as H, text as X, urls as U
from mailtriage.functions.literals import among

_TERM_SETS = {
    "urgency_term_count": K.URGENCY_TERMS, "account_term_count": K.ACCOUNT_TERMS,
    "offer_term_count": K.OFFER_TERMS,
}
_ALL_TERMS = list(dict.fromkeys(t for terms in _TERM_SETS.values() for t in terms))
# digits in every script, and the super- and subscript ones
_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"


def term_count(hits: Column, terms: list[str]) -> Column:
    return F.size(F.filter(hits, lambda h: among(h, terms)))


def numeric_features(df: DataFrame, subject: str, body: str, sender_domain: str, urls: str) -> DataFrame:
    """Append the 15 numeric columns.  Every term of three lists is found in one pass."""
    # FEA-01..15; stages keep shared results in columns
    base = df.withColumns({"_s": X.clean_value(F.col(subject)), "_b": X.clean_value(F.col(body)),
                           "_u": U.url_cell_candidates(F.col(urls))})
    base = base.withColumn("_t", X.strip(F.concat("_s", F.lit(" "), "_b"))).withColumn("_low", F.lower("_t"))
    base = base.withColumns({
        "_hits": X.term_hits(F.col("_low"), _ALL_TERMS),
        "_n": F.greatest(F.length(X.collapse_spaces(F.col("_t"), "")), F.lit(1)),
        "_hosts": F.transform("_u", U.hostname),
    })
    t, low, hosts = F.col("_t"), F.col("_low"), F.col("_hosts")

    def count(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    values = {
        "subject_length": F.length("_s"),
        "body_length": F.length("_b"),
        "url_count": F.size("_u"),
        "sender_domain_depth": count(F.col(sender_domain), r"\."),
        "uppercase_token_count": count(t, r"(?U)\b[A-Z]{3,}\b"),
        "exclamation_count": F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))),
        "digit_ratio": F.bround(count(t, _DIGIT) / F.col("_n"), 4),
        "currency_symbol_count": count(low, "[$€£¥]|sgd|usd|eur|gbp"),
        **{name: term_count(F.col("_hits"), terms) for name, terms in _TERM_SETS.items()},
        "sender_is_free_mail": among(F.col(sender_domain), K.FREE_MAIL_DOMAINS),
        "ip_url_count": F.size(F.filter(hosts, lambda h: h.rlike(U.IPV4))),
        "hyphenated_url_count": F.size(F.filter(hosts, lambda h: h.rlike("-[^-]*-"))),
        "link_token_count": count(low, r"https?://|www\.|bit\.ly|tinyurl|click"),
    }
    return base.withColumns({name: values[name].cast("double") for name in K.NUMERIC_COLUMNS}).drop(
        "_s", "_b", "_u", "_t", "_low", "_hits", "_n", "_hosts")


def training_features(df: DataFrame) -> DataFrame:
    """Five text columns and 15 numeric ones beside the other columns of a corpus.

    Texts pass the same placeholder cleaning as in scoring.
    """
    known = X.fill_text(df, ["subject", "body", "from", "urls"])
    return _frame(known, F.col("subject"), F.col("body"), F.col("from"), X.clean_value(F.col("urls")))


def scoring_features(df: DataFrame) -> DataFrame:
    """The same frame for mails to score: ``urls`` and ``url`` are joined by a comma."""
    known = X.fill_text(df, ["sender_email", "from", "subject", "body", "urls", "url"])
    cells = [F.nullif(X.clean_value(F.col(c)), F.lit("")) for c in ("urls", "url")]
    return _frame(known, F.col("subject"), F.col("body"), H.pick_sender(known), F.concat_ws(", ", *cells))


def _frame(df: DataFrame, subject: Column, body: Column, sender: Column, urls: Column) -> DataFrame:
    texts = df.withColumns({
        "subject_text": X.clean_value(subject), "body_text": X.clean_value(body),
        "sender_domain": H.feature_host(sender), "url_text": urls,
    })
    texts = texts.withColumn("combined_text", X.combined_text(
        F.col("subject_text"), F.col("body_text"), F.col("sender_domain"), F.col("url_text")))
    return numeric_features(texts, "subject_text", "body_text", "sender_domain", "url_text")


def has_content(df: DataFrame) -> Column:
    """Any of sender, subject, body, urls, url left after placeholder cleaning."""
    cells = [H.pick_sender(df)] + [F.col(c) for c in ("subject", "body", "urls", "url") if c in df.columns]
    return F.concat(*[X.clean_value(c) for c in cells]) != ""


def admissible(df: DataFrame) -> Column:
    """At least one of subject, body, url is given."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in ("subject", "body", "url") if c in df.columns]
    return F.concat(*cells) != ""
