"""Assessment of links: validity, trust, structure, alignment, brand imitation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage.functions import text as X, urls as U
from mailtriage.operators.domains import membership, trusted_union
from mailtriage.operators.lookalike import brand_impersonation, brand_map
from mailtriage.operators.lookup import computed_once, lookup
from mailtriage.session import staged_table


def url_facts(urls: DataFrame, trusted: DataFrame, safe: DataFrame, suffixes: Iterable[str] | None = None,
              small: bool = False, url: str = "url") -> DataFrame:
    """Everything about a distinct URL that does not depend on the sender.

    Cheap tests come first; only domains that are neither trusted nor structurally odd
    reach the brand search, and that runs on distinct registrable domains.
    """
    key = F.col(url)
    parsed = computed_once(urls.select(url).distinct(), _h=U.prepared_host(key, suffixes))
    rows = computed_once(
        parsed, hostname=F.col("_h.hostname"), registrable=F.col("_h.registrable"), error=F.col("_h.error"),
        structure=F.coalesce(U.structural_reason(F.col("_h.hostname"), F.col("_h.registrable")), F.lit("")),
    ).drop("_h")
    rows = membership(rows, trusted_union(trusted, safe), "registrable", key, "_a", small)
    rows = membership(rows, safe, "hostname", key, "_b", small)
    rows = staged_table(rows.withColumn("trusted", F.col("_a") | F.col("_b")).drop("_a", "_b"), "links")
    to_check = rows.where((F.col("error") == "") & ~F.col("trusted") & (F.col("structure") == ""))
    brands = brand_impersonation(to_check.select(F.col("registrable").alias("domain")),
                                 brand_map(trusted, suffixes), suffixes, small)
    found = brands.select(F.col("domain").alias("registrable"), F.col("closest").alias("brand_site"),
                          F.col("distance").alias("brand_distance"), F.col("reason").alias("brand_reason"))
    joined = lookup(rows, found, "registrable", key, small)
    keep = (F.col("error") == "") & ~F.col("trusted") & (F.col("structure") == "")
    return joined.withColumns({
        c: F.when(keep, F.col(c)) for c in ("brand_site", "brand_distance", "brand_reason")})


def decide(df: DataFrame, url: str = "url", sender_registrable: str = "sender_registrable") -> DataFrame:
    """Add status, domain, reason, flags, closest_trusted, lookalike_distance."""
    broken, trusted = F.col("error") != "", F.col("trusted")
    odd, brand = F.col("structure") != "", F.col("brand_site").isNotNull()
    own = (F.col(sender_registrable) != "") & (F.col("registrable") == F.col(sender_registrable))

    def pick(broken_, trusted_, odd_, brand_, own_, plain_):
        return (F.when(broken, broken_).when(trusted, trusted_).when(odd, odd_)
                .when(brand, brand_).when(F.coalesce(own, F.lit(False)), own_).otherwise(plain_))

    none = F.lit(None).cast("string")
    status = pick("suspicious", "trusted", "suspicious", "suspicious", "aligned", "normal")
    reason = pick(F.col("error"), "Domain matched the trusted list.", F.col("structure"), F.col("brand_reason"),
                  "Domain matches the sender domain.", "Domain is valid and looks structurally normal.")
    return df.withColumns({
        "status": status, "reason": reason,
        "domain": F.when(broken, X.strip(F.coalesce(F.col(url), F.lit("")))).otherwise(F.col("registrable")),
        "is_trusted": F.coalesce(status == "trusted", F.lit(False)),
        "is_suspicious": F.coalesce(status == "suspicious", F.lit(False)),
        "closest_trusted": pick(none, F.col("registrable"), F.lit(""), F.col("brand_site"), F.lit(""), F.lit("")),
        "lookalike_distance": F.when(~broken & trusted, 0).when(~broken & ~odd & brand, F.col("brand_distance")),
    })


def assess(links: DataFrame, trusted: DataFrame, safe: DataFrame, row_key: Column,
           suffixes: Iterable[str] | None = None, small: bool = False, url: str = "url",
           sender: str = "sender_domain") -> DataFrame:
    """Links (url, sender_domain, ...) with their assessment columns."""
    facts = url_facts(links, trusted, safe, suffixes, small, url)
    # null URLs are joined through an empty key and stay invalid
    keyed = links.withColumn("_u", F.coalesce(F.col(url), F.lit("")))
    dim = facts.withColumn("_u", F.coalesce(F.col(url), F.lit(""))).drop(url).dropDuplicates(["_u"])
    rows = lookup(keyed, dim, "_u", row_key, small=False).drop("_u")
    rows = rows.withColumn("sender_registrable", U.normalised_registrable(F.col(sender), suffixes))
    return decide(rows, url).drop("structure", "trusted", "error", "brand_site", "brand_distance",
                                  "brand_reason", "sender_registrable")


def display_status(status: Column) -> Column:
    return (F.when(status == "trusted", "Safe").when(status == "aligned", "Matches sender")
            .when(status == "normal", "Looks normal").otherwise("Suspicious"))


def display_closest(distance: Column, closest: Column) -> Column:
    """Closest trusted site, shown only for one or two edits."""
    return F.when((closest != "") & distance.between(1, 2), closest)


def safe_url_lines(mails: DataFrame) -> DataFrame:
    """URL cells of ham mails, one per line."""
    return mails.where((F.col("label") == 0) & F.col("urls").isNotNull() & (F.col("urls") != "nan")).select("urls")
