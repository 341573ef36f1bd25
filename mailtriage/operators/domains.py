"""Domain reputation: statistics per domain, score, category and trusted lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import urls as U
from mailtriage.functions.literals import strings
from mailtriage.operators.lookup import lookup
from mailtriage.operators.ordering import numbered


def registrable_by_table(hosts: DataFrame, rules: DataFrame, host: str = "host",
                         small: bool = False) -> DataFrame:
    """Registrable domain of every distinct host from a table of suffix rules.

    For complete public-suffix lists: ``rules(suffix)`` holds plain, ``*.`` and ``!``
    rules.  Each host is exploded into its tails, the longest matching tail wins.
    """
    kind = (F.when(F.col("suffix").startswith("!"), "exact")
            .when(F.col("suffix").startswith("*."), "wild").otherwise("plain"))
    table = rules.select(F.regexp_replace(F.lower(F.trim("suffix")), r"^(?:!|\*\.)", "").alias("tail"),
                         kind.alias("kind")).groupBy("tail").agg(F.collect_set("kind").alias("kinds"))
    parts = F.split(U.bare_host(F.lower(F.col(host))), r"\.")
    tails = (
        hosts.select(host).distinct()
        .select(host, parts.alias("_p"))
        .select(host, "_p", F.posexplode("_p").alias("_i", "_x"))
        .select(host, "_p", "_i", F.array_join(F.slice("_p", F.col("_i") + 1, F.size("_p")), ".").alias("tail"))
    )
    hit = lookup(tails, table, "tail", F.col(host), small)
    has = lambda k: F.coalesce(F.array_contains("kinds", k), F.lit(False))
    # labels in front of the tail that belong to the registrable domain
    start = (F.when(has("exact"), F.col("_i"))
             .when(has("wild") & (F.col("_i") >= 2), F.col("_i") - 2)
             .when((has("plain") | has("wild")) & (F.col("_i") >= 1), F.col("_i") - 1))
    priority = F.when(has("exact"), 0).otherwise(1)
    best = hit.where(start.isNotNull()).groupBy(host).agg(
        F.min_by(F.array_join(F.slice("_p", start + 1, F.size("_p")), "."), F.struct(priority, start)).alias("_d"))
    return hosts.select(host).distinct().join(best, host, "left").select(
        host, F.coalesce("_d", F.lower(F.col(host))).alias("registrable"))


def mail_domains(mails: DataFrame, suffixes: Iterable[str] | None = None) -> DataFrame:
    """Mails with ``domains``: distinct registrable domains of urls, body, from and to."""
    found = F.concat(*[U.text_domains(F.col(f"`{c}`"), suffixes) for c in ("urls", "body", "from", "to")])
    return mails.withColumn("domains", F.filter(F.array_distinct(found), lambda d: d != ""))


def _inside(domain: Column, field: str) -> Column:
    return F.coalesce(F.contains(F.col(f"`{field}`"), domain), F.lit(False))


def domain_counts(mails: DataFrame, suffixes: Iterable[str] | None = None) -> DataFrame:
    """One row per domain: mails, spam mails, ham mails, and where it was seen.

    Counts and flags are fixed-width, so a domain that occurs in every third mail shrinks
    to one row per input partition before the only shuffle.
    """
    # outer: an inner explode makes the planner test the list's size in a filter of its
    # own, which would run every pattern twice
    rows = mail_domains(mails, suffixes).select(
        "label", "from", "urls", F.explode_outer("domains").alias("domain")
    ).where("domain is not null").select("domain", "label", _inside(F.col("domain"), "from").alias("_from"),
             _inside(F.col("domain"), "urls").alias("_urls"))
    spam = F.coalesce(F.col("label") == 1, F.lit(False))
    return rows.groupBy("domain").agg(
        F.count("*").alias("total_occurrences"),
        F.count_if(spam).alias("in_spam"), F.count_if(~spam).alias("in_ham"),
        F.max("_from").alias("_from"), F.max("_urls").alias("_urls"),
    ).withColumn("sources", F.concat_ws(
        ", ", F.when(F.col("_from"), "from"), F.when(F.col("_urls"), "urls"))).drop("_from", "_urls")


def legitimacy_score(domain: Column, count: Column, spam: Column, ham: Column) -> Column:
    """0 to 100, neutral at 50."""
    def mentions(words):
        return F.exists(strings(words), lambda w: F.contains(domain, w))

    points = [
        F.when(mentions(K.KNOWN_LEGIT_DOMAINS), 40),
        F.when(mentions(K.SPAM_DOMAIN_MARKS), -30),
        F.when(ham > spam, 25).when(spam > ham, -25),
        F.when((count == 1) & (spam == 1), -20),
        F.when(domain.rlike(r"\.(org|edu|gov)\z"), 15),
        F.when(domain.rlike(r"\.(com|net)\z") & (ham > 0), 5),
    ]
    total = F.lit(50)
    for p in points:
        total = total + F.coalesce(p, F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("int")


def category(score: Column) -> Column:
    return F.when(score >= 70, "legitimate").when(score >= 40, "uncertain").otherwise("spam")


def reputation(mails: DataFrame, suffixes: Iterable[str] | None = None) -> DataFrame:
    """The reputation table (unsorted: a sort is only paid for where order is read)."""
    counts = domain_counts(mails, suffixes)
    scored = counts.withColumn("legitimacy_score", legitimacy_score(
        F.col("domain"), F.col("total_occurrences"), F.col("in_spam"), F.col("in_ham")))
    return scored.withColumn("category", category(F.col("legitimacy_score"))).select(*K.REPUTATION_COLUMNS)


def sorted_reputation(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("legitimacy_score"), "domain")


def legitimate(table: DataFrame, threshold: int = 70) -> DataFrame:
    return table.where(F.col("legitimacy_score") >= threshold)


def ranked_sites(table: DataFrame) -> DataFrame:
    """rank, domain in list order (score downwards, then name)."""
    keys = [F.desc("legitimacy_score"), F.asc("domain")]
    return numbered(table.select("domain", "legitimacy_score"), keys).select("rank", "domain")


def trusted_union(trusted: DataFrame, safe: DataFrame) -> DataFrame:
    return trusted.select("domain").unionByName(safe.select("domain")).distinct()


def membership(rows: DataFrame, names: DataFrame, column: str, row_key: Column, flag: str,
               small: bool = False) -> DataFrame:
    """Add a flag: is the lower-cased value in ``names(domain)``?  Empty and null are not."""
    dim = names.select(F.lower("domain").alias("_k")).distinct().withColumn("_hit", F.lit(True))
    keyed = rows.withColumn("_k", F.nullif(F.lower(F.col(column)), F.lit("")))
    found = lookup(keyed, dim, "_k", row_key, small)
    return found.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")
