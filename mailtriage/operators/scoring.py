"""Fusion of all checks into one verdict per mail."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import features as FE, headers as H, text as X, urls as U
from mailtriage.functions.literals import among, no_strings
from mailtriage.operators.lexicon import lexicon_score
from mailtriage.operators.links import decide, url_facts
from mailtriage.operators.lookalike import nearest_sites
from mailtriage.operators.lookup import lookup
from mailtriage.operators.sender import sender_reputation
from mailtriage.session import staged_table


# --- model output ---------------------------------------------------------------

def model_columns(df: DataFrame, p: str = "p", content: Column | None = None,
                  threshold: float = K.MODEL_THRESHOLD) -> DataFrame:
    """Prediction, rounded probability, score and confidence; zeros without content."""
    filled = F.lit(True) if content is None else content
    prob = F.when(filled, F.col(p)).otherwise(0.0)
    return df.withColumns({
        "model_prediction": F.when(filled & (F.col(p) >= threshold), "Spam").otherwise("Safe"),
        "model_probability": F.bround(prob, 4),
        "model_score": F.bround(prob * 100, 1),
        "model_confidence": F.when(filled, F.bround(F.greatest(prob, 1 - prob), 4)).otherwise(0.0),
    })


# --- links of a mail ----------------------------------------------------------

def mail_requests(mails: DataFrame, key: str) -> DataFrame:
    """key, sender, subject, body, url (placeholder-cleaned), has_content, other columns."""
    known = X.fill_text(mails, ["sender_email", "from", "subject", "body", "url"])
    known = known if key in known.columns else known.withColumn(key, F.lit(None).cast("string"))
    return known.withColumn("has_content", FE.has_content(known)).withColumns({
        "sender": X.clean_value(H.pick_sender(known)),
        **{c: X.clean_value(F.col(c)) for c in ("subject", "body", "url")},
    }).drop("sender_email", "from")


def raw_links(body: Column, url: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Domains of the body's links followed by the supplied URL, first seen first."""
    found = F.coalesce(U.link_domains(body, suffixes), no_strings())
    return X.first_seen(F.concat(found, F.array(url)))


def mail_links(requests: DataFrame, key: str, suffixes: Iterable[str] | None = None,
               raw: bool = False) -> DataFrame:
    """key, pos, url, sender_domain: the links to check, one narrow row each.

    ``url`` is the base domain, or with ``raw`` the link as given.
    """
    links = raw_links(F.col("body"), F.col("url"), suffixes)
    if not raw:
        links = X.first_seen(F.transform(links, U.base_domain))
    # outer, so that the planner does not add a filter that evaluates the list again
    return requests.select(key, H.text_host(F.col("sender")).alias("sender_domain"),
                           F.posexplode_outer(links).alias("pos", "url")).where("pos is not null")


def link_results(links: DataFrame, key: str, trusted: DataFrame, safe: DataFrame,
                 suffixes: Iterable[str] | None = None, small: bool = False) -> DataFrame:
    """key and the per-mail arrays of link checks, in link order.

    All heavy work runs on distinct links; joining back spreads a link that occurs in
    every mail over salts.  Sites at the same distance are taken in list order if
    ``trusted`` has a ``rank``, else by name.
    """
    trusted, safe = staged_table(trusted, "trusted"), staged_table(safe, "safe")  # read several times below
    facts = staged_table(url_facts(links, trusted, safe, suffixes, small), "url-facts")
    lacking = facts.where((F.col("error") != "") | (~F.col("trusted") & F.col("brand_site").isNull()))
    order = F.struct("rank", "domain") if "rank" in trusted.columns else None
    near = nearest_sites(lacking.select("url"), trusted, order, domain="url").select(
        "url", F.col("distance").alias("near_distance"), F.col("closest").alias("near_site"))
    dim = facts.join(near, "url", "left")
    rows = lookup(links, dim, "url", F.struct(key, "pos"))
    rows = decide(rows.withColumn("sender_registrable", U.normalised_registrable(F.col("sender_domain"), suffixes)))
    named = F.coalesce("closest_trusted", F.lit("")) != ""
    rows = rows.withColumn("edit", F.struct(
        F.when(named, F.coalesce("lookalike_distance", F.lit(0))).otherwise(F.col("near_distance")).alias("distance"),
        F.when(named, F.col("closest_trusted")).otherwise(F.col("near_site")).alias("closest")))
    close = F.col("edit.distance") <= 2
    lookalike = ((F.col("status") == "suspicious") & named & close) | (close & (F.col("edit.distance") != 0))
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        "pos", "url", "status", "edit", F.coalesce(lookalike, F.lit(False)).alias("lookalike")))).alias("_l"))

    def urls_where(test) -> Column:
        return F.transform(F.filter("_l", test), lambda x: x["url"])

    return packed.select(
        key, urls_where(lambda x: F.lit(True)).alias("urls"),
        F.transform("_l", lambda x: x["status"] == "trusted").alias("url_check"),
        F.transform("_l", lambda x: x["status"]).alias("url_status"),
        F.transform("_l", lambda x: x["edit"]).alias("edit_check"),
        urls_where(lambda x: x["status"] == "suspicious").alias("suspicious_urls"),
        urls_where(lambda x: x["status"].isin("aligned", "normal")).alias("neutral_urls"),
        F.transform(F.filter("_l", lambda x: x["lookalike"]), lambda x: F.struct(
            x["url"].alias("source"), x["edit"]["distance"].alias("distance"),
            x["edit"]["closest"].alias("closest"))).alias("lookalikes"),
    )


# --- verdict -------------------------------------------------------------------

def risk_level(score: Column) -> Column:
    return F.when(score >= 80, "High").when(score >= 55, "Medium").otherwise("Low")


def sender_status(category: Column) -> Column:
    low = F.lower(category)
    return (F.when(among(low, K.RISKY_CATEGORIES), "Suspicious")
            .when(among(low, K.WATCH_CATEGORIES), "Unknown").otherwise("Trusted"))


def fuse(df: DataFrame) -> DataFrame:
    """Flags, votes, score, label and level from the signal columns.

    The score is counted in whole ten-thousandths, so that rounding to one decimal does
    not depend on binary fractions.
    """
    suspicious, alike = F.size("suspicious_urls") > 0, F.size("lookalikes") > 0
    risky = among(F.lower("sender_category"), K.RISKY_CATEGORIES)
    flags = df.withColumn("check_flags", F.struct(
        (F.col("model_prediction") == "Spam").alias("trained_model"),
        (F.col("keyword_score") >= 50).alias("keyword_scan"), suspicious.alias("url_safety"),
        alike.alias("lookalike_domains"), risky.alias("sender_domain")))
    votes = sum((F.col(f"check_flags.{f}").cast("int") for f in (
        "keyword_scan", "url_safety", "lookalike_domains", "sender_domain")), F.col("check_flags.trained_model").cast("int"))
    voted = flags.withColumn("spam_votes", votes)
    p = F.col("model_probability")
    spam = ((p >= 0.5) | suspicious | alike | ((p >= 0.4) & (F.col("spam_votes") >= 2)) | (risky & suspicious))
    parts = F.round(p * 10000).cast("long") * 78 + F.col("spam_votes") * 44000
    labelled = voted.withColumns({
        "final_label": F.when(spam, "Spam").otherwise("Safe"), "_base": F.bround(parts / 1000, 0) / 10})
    scored = labelled.withColumn("overall_score", F.when(
        F.col("final_label") == "Spam", F.greatest("_base", F.lit(60.0))).otherwise(F.col("_base")))
    return scored.drop("_base").withColumn("risk_level", risk_level(F.col("overall_score")))


def verdict_message(label: Column, score: Column, p: Column) -> Column:
    spam = label == "Spam"
    return (
        F.when(spam & (score >= 80),
               "This email looks strongly suspicious and matches patterns seen in phishing emails.")
        .when(spam, "This email shows enough phishing signals that it should be treated with caution.")
        .when(p < 0.2, "This email looks safe based on the trained model and the supporting checks.")
        .otherwise("This email leans safe overall, but you should still review any unexpected links carefully."))


def _join(items: Column, n: int) -> Column:
    return F.array_join(F.slice(items, 1, n), ", ")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def reasons(threshold: float = K.MODEL_THRESHOLD) -> Column:
    """Up to five reasons in fixed order; a fallback for safe mails without any.  ``threshold`` is the model's."""
    p, score, cat = F.col("model_probability"), F.col("model_score"), F.col("sender_category")
    first = F.try_element_at("lookalikes", F.lit(1))
    low, host = F.lower(cat), F.col("sender_host")
    found = F.array_compact(F.array(
        F.when(p >= 0.7, _text("The trained model found a strong phishing match (", score, "% phishing likelihood)."))
        .when(p >= threshold, _text("The trained model leaned toward phishing (", score, "% phishing likelihood).")),
        F.when((F.col("keyword_score") >= 50) & (F.size("keywords") > 0),
               _text("Suspicious wording detected: ", _join(F.col("keywords"), 5), ".")),
        F.when(F.size("suspicious_urls") > 0,
               _text("High-risk URL or domain found: ", _join(F.col("suspicious_urls"), 3), ".")),
        F.when(F.size("lookalikes") > 0, _text(
            'Lookalike domain detected: "', first["source"], '" is close to trusted site "', first["closest"],
            '" (distance ', first["distance"], ").")),
        F.when(among(low, K.RISKY_CATEGORIES), _text("Sender domain ", host, " is marked as ", cat, "."))
        .when(among(low, K.WATCH_CATEGORIES) & (host != "Not Found"),
              _text("Sender domain ", host, " is not strongly trusted in the domain dataset.")),
    ))
    nothing = (F.size(found) == 0) & (F.col("final_label") == "Safe")
    return F.when(nothing, F.array(F.lit(
        "No strong phishing wording, link issues, or sender-domain risks were found."))).otherwise(F.slice(found, 1, 5))


def checks_breakdown() -> Column:
    """array<struct<name, status, detail>> with the five checks in fixed order."""
    flag = lambda name: F.when(F.col(f"check_flags.{name}"), "Suspicious")
    first, status = F.try_element_at("lookalikes", F.lit(1)), sender_status(F.col("sender_category"))
    keyword = F.when(F.size("keywords") > 0, _text(
        "Score ", F.col("keyword_score"), " with keywords: ", _join(F.col("keywords"), 4), ".")).otherwise(
        _text("Score ", F.col("keyword_score"), " with no strong keyword hits."))
    neutral = F.size("neutral_urls") > 0
    url = (F.when(F.size("suspicious_urls") > 0, _text("High-risk links found: ", _join(F.col("suspicious_urls"), 3), "."))
           .when(neutral, _text("Links looked normal or matched the sender domain: ", _join(F.col("neutral_urls"), 3), "."))
           .otherwise("No high-risk links were found."))
    sender = (F.when(status == "Suspicious", _text("Sender domain is marked as ", F.col("sender_category"), "."))
              .when(status == "Unknown", "Sender domain was not strongly verified in the domain dataset.")
              .otherwise("Sender domain matched a known legitimate domain."))
    rows = [
        ("Trained Model", flag("trained_model").otherwise("Clear"), _text(F.col("model_score"), "% phishing probability.")),
        ("Keyword Scan", flag("keyword_scan").otherwise("Clear"), keyword),
        ("URL Safety", flag("url_safety").when(neutral, "Neutral").otherwise("Clear"), url),
        ("Lookalike Domains", flag("lookalike_domains").otherwise("Clear"),
         F.when(F.size("lookalikes") > 0, _text(first["source"], " is similar to ", first["closest"], "."))
         .otherwise("No close impersonation domains were detected.")),
        ("Sender Domain", status, sender),
    ]
    return F.array(*[F.struct(F.lit(n).alias("name"), s.alias("status"), d.alias("detail")) for n, s, d in rows])


ROW_KEY = "_row"


def mail_signals(mails: DataFrame, key: str, p: str, suffixes: Iterable[str] | None, raw: bool,
                 threshold: float, carry: Iterable[str]) -> DataFrame:
    """One narrow row per mail: a row key of its own, the caller's id, model and lexicon signals, links.

    Everything that reads the texts happens here, row by row, and is written once; no
    later step sees a text.  The row key is the join key, so mails without an id or with
    the same id stay apart.
    """
    requests = mail_requests(mails, key)
    modelled = lexicon_score(model_columns(requests, p, F.col("has_content"), threshold))
    links = raw_links(F.col("body"), F.col("url"), suffixes)
    rows = modelled.select(
        key, *carry, "sender", "model_prediction", "model_probability", "model_score", "model_confidence",
        "keyword_score", "keyword_label", "keywords", "matched", H.text_host(F.col("sender")).alias("sender_domain"),
        (links if raw else X.first_seen(F.transform(links, U.base_domain))).alias("_links"))
    return staged_table(rows.withColumn(ROW_KEY, F.monotonically_increasing_id()), "signals")


def score_mails(mails: DataFrame, trusted: DataFrame, safe: DataFrame, reputation: DataFrame | None,
                key: str = "email_id", p: str = "p", suffixes: Iterable[str] | None = None,
                small: bool = False, raw_links: bool = False, carry: Iterable[str] = (),
                threshold: float = K.MODEL_THRESHOLD) -> DataFrame:
    """One verdict per mail.

    ``mails`` has sender_email/from, subject, body, url and the probability; the id column
    ``key`` is carried along and may be missing, null or repeated.  ``threshold`` is the
    model's.  Texts are reduced to short signal columns before anything is shuffled.
    """
    signals = mail_signals(mails, key, p, suffixes, raw_links, threshold, carry)
    links = signals.select(ROW_KEY, "sender_domain", F.posexplode("_links").alias("pos", "url"))
    checked = link_results(links, ROW_KEY, trusted, safe, suffixes, small)
    known = sender_reputation(signals.drop("_links", "sender_domain"), reputation, "sender", ROW_KEY, small=small)
    joined = known.join(checked, ROW_KEY, "left").drop(ROW_KEY)
    empty = {
        c: F.coalesce(c, F.array().cast(checked.schema[c].dataType))
        for c in ("urls", "url_check", "url_status", "edit_check", "suspicious_urls", "neutral_urls", "lookalikes")
    }
    verdict = fuse(joined.withColumns(empty))
    return verdict.withColumns({
        "checks_breakdown": checks_breakdown(), "reasons": reasons(threshold),
        "verdict_message": verdict_message(F.col("final_label"), F.col("overall_score"), F.col("model_probability")),
    })


def error_record(df: DataFrame, error: Column) -> DataFrame:
    """Default record for rows that could not be scored."""
    strings = no_strings()
    no = F.lit(False)
    return df.withColumns({
        "error": error, "final_label": F.lit("Error"), "overall_score": F.lit(0.0),
        "risk_level": F.lit("Unknown"), "spam_votes": F.lit(0), "keyword_score": F.lit(0.0),
        "keyword_label": F.lit("Error"), "keywords": strings, "urls": strings,
        "url_check": F.array().cast("array<boolean>"), "url_status": strings,
        "edit_check": F.array().cast("array<struct<distance:int,closest:string>>"),
        "model_prediction": F.lit("Error"), "model_probability": F.lit(0.0), "model_score": F.lit(0.0),
        "model_confidence": F.lit(0.0),
        "check_flags": F.struct(*[no.alias(c) for c in (
            "trained_model", "keyword_scan", "url_safety", "lookalike_domains", "sender_domain")]),
        "checks_breakdown": F.array().cast("array<struct<name:string,status:string,detail:string>>"),
        "reasons": strings, "verdict_message": F.lit(""),
    })
