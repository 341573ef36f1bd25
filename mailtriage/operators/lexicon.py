"""Keyword and phrase score of a mail.

A text is cut at its blanks once; one alternation of all keywords reads the few pieces
that may hold one, and a phrase is looked for where its keywords occur.  What remains is
arithmetic on the short list of hits, so the score needs no join and no shuffle and works
in a stream.  Weights are whole numbers and all
factors are multiples of 0.05: the score is counted in twentieths and is exact.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X
from mailtriage.functions.literals import mapping, no_strings, strings
from mailtriage.operators.lookup import is_small, lookup

_UNIT = 20


def _times(hits: Column, term: Column) -> Column:
    return F.size(F.filter(hits, lambda h: h == term))


def _total(items: Column, points) -> Column:
    return F.aggregate(items, F.lit(0), lambda acc, x: acc + points(x))


def _in(words: Column, cluster: list[str]) -> Column:
    return F.size(F.array_intersect(words, strings(cluster)))


def lexicon_score(mails: DataFrame, subject: str = "subject", body: str = "body",
                  keywords: dict[str, int] = K.KEYWORD_WEIGHTS,
                  phrases: dict[str, int] = K.PHRASE_WEIGHTS) -> DataFrame:
    """Mails with ``keyword_part``, ``phrase_part``, ``bonus_part``, ``keyword_score``,
    ``keyword_label``, ``matched`` (text order) and ``keywords`` (cleaned, sorted)."""
    weight, phrase_weight = mapping(keywords), mapping(phrases)
    words_of = mapping({p: " ".join(w for w in p.split() if w in keywords) for p in phrases})

    # Stages keep every regex result in a column, so that none is evaluated twice.  Only the
    # cut at blanks reads all texts; a phrase that holds keywords is looked for in mails
    # with all of them, and order matters from two words on.
    lowered = mails.withColumns({"_ls": F.lower(F.coalesce(F.col(subject), F.lit(""))), "_lb": F.lower(F.coalesce(F.col(body), F.lit("")))})
    pieces = lowered.withColumns({"_ps": X.term_pieces(F.col("_ls"), keywords), "_pb": X.term_pieces(F.col("_lb"), keywords)})
    hits = pieces.withColumns({"_hs": X.term_hits(F.col("_ps"), keywords), "_hb": X.term_hits(F.col("_pb"), keywords)})
    text = F.concat("_ls", F.lit(" "), "_lb")

    def found(p: str) -> Column:
        held = [F.array_contains("_words", w) for w in dict.fromkeys(p.split()) if w in keywords]
        return F.struct(F.lit(p).alias("phrase"), F.when(reduce(and_, held, F.lit(True)), X.phrase_count(text, p)).otherwise(0).alias("n"))

    named = hits.withColumn("_words", F.array_distinct(F.concat("_hs", "_hb"))).withColumn(
        "_phrases", F.filter(F.array(*map(found, phrases)), lambda p: p["n"] > 0)).withColumn(
        "_matched", F.array_union("_words", F.flatten(F.transform(
            "_phrases", lambda p: F.filter(F.split(words_of[p["phrase"]], " "), lambda w: w != ""))))).withColumn(
        "_tokens", F.when(F.size("_matched") > 1, X.token_terms(F.concat("_ps", F.lit(" "), "_pb"), keywords)).otherwise(no_strings()))

    def keyword_points(k: Column) -> Column:
        w, repeats = weight[k], _times(F.col("_hb"), k) - 1
        return (w * _UNIT
                + F.when(F.array_contains("_hs", k), w * 7).otherwise(0)
                + F.greatest(F.lit(0), F.least(w * 7, w * 3 * repeats)))

    def phrase_points(p: Column) -> Column:
        return phrase_weight[p["phrase"]] * _UNIT * F.least(F.lit(2), p["n"])

    bonus = (F.least(F.lit(18 * _UNIT), F.size("_matched") * 35)
             + F.when(_in(F.col("_matched"), K.ADULT_CLUSTER) >= 3, 15 * _UNIT).otherwise(0)
             + F.when(_in(F.col("_matched"), K.PHISHING_CLUSTER) >= 3, 12 * _UNIT).otherwise(0))
    parts = named.withColumns({
        "_k": _total(F.col("_words"), keyword_points), "_p": _total(F.col("_phrases"), phrase_points),
        "_x": bonus,
    })
    score = F.least(F.lit(100 * _UNIT), F.col("_k") + F.col("_p") + F.col("_x")) / _UNIT
    return parts.withColumns({
        "keyword_part": F.col("_k") / _UNIT, "phrase_part": F.col("_p") / _UNIT,
        "bonus_part": F.col("_x") / _UNIT, "keyword_score": score,
        "keyword_label": F.when(score >= 50, "Spam").otherwise("Safe"),
        "matched": X.ordered_matches(F.col("_tokens"), F.col("_matched")),
    }).withColumn("keywords", X.clean_keywords(F.col("matched"))).drop(
        "_ls", "_lb", "_ps", "_pb", "_hs", "_hb", "_tokens", "_words", "_phrases", "_matched", "_k", "_p", "_x")


def keyword_hits(mails: DataFrame, terms: DataFrame, key: str = "email_id", subject: str = "subject",
                 body: str = "body", small: bool | None = None) -> DataFrame:
    """key, term, subject_hits, body_hits for a lexicon given as a table ``terms(term)``.

    For lexicons too long for one pattern: texts become maximal word runs and each run is
    looked up.  A ``small`` lexicon (measured if not told) filters the runs before anything
    is shuffled; otherwise runs are counted per mail first.
    """
    dim = terms.select(F.lower("term").alias("term")).distinct()
    small = is_small(dim) if small is None else small

    def runs(column: str, s: int, b: int) -> Column:
        found = F.regexp_extract_all(X.normalise(F.col(column)), F.lit(r"(?U)\w+"), F.lit(0))
        return F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(s).alias("s"), F.lit(b).alias("b")))

    tagged = mails.select(key, F.explode_outer(F.concat(runs(subject, 1, 0), runs(body, 0, 1))).alias("t")).select(
        key, "t.*").where("term is not null")
    if small:
        tagged = tagged.join(F.broadcast(dim), "term", "left_semi")
    counted = tagged.groupBy(key, "term").agg(F.sum("s").alias("subject_hits"), F.sum("b").alias("body_hits"))
    if small:
        return counted
    known = lookup(counted, dim.withColumn("_hit", F.lit(True)), "term", F.col(key))
    return known.where("_hit").drop("_hit")


def phrase_hits(mails: DataFrame, key: str = "email_id", subject: str = "subject", body: str = "body",
                phrases: dict[str, int] = K.PHRASE_WEIGHTS) -> DataFrame:
    """key, phrase, hits: one row per phrase that occurs in a mail."""
    text = X.strip(F.concat(X.normalise(F.col(subject)), F.lit(" "), X.normalise(F.col(body))))
    found = mails.select(key, X.term_hits(text, phrases).alias("_h"))
    return found.select(key, "_h", F.explode_outer(F.array_distinct("_h")).alias("phrase")).where("phrase is not null").select(
        key, "phrase", _times(F.col("_h"), F.col("phrase")).alias("hits"))


def highlighted(mails: DataFrame, matched: str = "matched", subject: str = "subject", body: str = "body") -> DataFrame:
    """Add ``subject_highlighted`` and ``body_highlighted``."""
    return mails.withColumns({
        "subject_highlighted": X.highlight(F.col(subject), F.col(matched)),
        "body_highlighted": X.highlight(F.col(body), F.col(matched)),
    })
