"""Edit-distance searches without comparing every pair.

Two strings within distance k share a variant after at most k deletions on each side (the
deletion-neighbourhood method).  The variants of both sides are joined by equality and only
the pairs that meet are measured.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import urls as U
from mailtriage.functions.literals import no_strings, strings
from mailtriage.operators import neighbours as N
from mailtriage.operators.lookup import lookup
from mailtriage.operators.ordering import numbered
from mailtriage.session import staged_table

NO_SITE_DISTANCE = 99
PIECE_BOUNDS = (3, 4)
FEW_SITES = 200
BLOCK_SITES = 1000
BLOCK_SALTS = 256


def _drop_one(word: Column, start: Column) -> Column:
    """The word without its i-th character, for every i from start to its end."""
    spots = F.when(F.length(word) >= start, F.sequence(start, F.length(word))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.struct(
        i.alias("i"), F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)).alias("w")))


def deletion_keys(word: Column, distance: Column) -> Column:
    """Hashes of the word and of its variants after up to ``distance`` (<= 2) deletions.

    The second deletion starts where the first one was: every pair of positions once.
    """
    one = _drop_one(word, F.lit(1))
    two = F.flatten(F.transform(one, lambda s: F.transform(
        _drop_one(s["w"], s["i"]), lambda t: t["w"])))
    words = F.concat(F.array(word), F.when(distance >= 1, F.transform(one, lambda s: s["w"]))
                     .otherwise(no_strings()),
                     F.when(distance >= 2, two).otherwise(no_strings()))
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def edit_neighbours(left: DataFrame, right: DataFrame, allowed: Column | None = None,
                    most: int = 2) -> DataFrame:
    """left, right, distance for all pairs of distinct strings within the distance.

    ``left(left)`` and ``right(right)``; ``allowed`` is a bound per right string (a column
    over ``right``), at most ``most``.  Equal keys can collide only into extra candidates,
    which the distance test removes.
    """
    bound = F.lit(most) if allowed is None else allowed
    # longer strings have no neighbour; their variants would grow with the square of the length
    longest = right.agg(F.coalesce(F.max(F.length("right")), F.lit(0)) + most).scalar()
    a = left.select("left").distinct().where(F.length("left") <= longest).select(
        "left", F.explode_outer(deletion_keys(F.col("left"), F.lit(most))).alias("_v"))
    b = right.select("right").distinct().select("right", bound.alias("_d")).select(
        "right", "_d", F.explode_outer(deletion_keys(F.col("right"), F.col("_d"))).alias("_v"))
    gap = F.call_function("levenshtein", F.col("left"), F.col("right"), F.col("_d"))
    pairs = a.join(b, "_v").where(F.abs(F.length("left") - F.length("right")) <= F.col("_d"))
    return (pairs.withColumn("distance", gap).where("distance >= 0")
            .select("left", "right", "distance").distinct())


def _ranked(sites: DataFrame, order: Column | None) -> DataFrame:
    """right, rank, letters: every site once, numbered by ``order``, then by name."""
    named = sites.select(F.col("domain").alias("right"), (F.col("domain") if order is None else order).alias("place")).where("right is not null")
    first = named.groupBy("right").agg(F.min("place").alias("place"))
    return N.with_letters(numbered(first, [F.col("place").asc(), F.col("right").asc()]).select("right", "rank"), "right")


def look_alikes(domains: DataFrame, sites: DataFrame, order: Column | None = None, domain: str = "domain") -> DataFrame:
    """domain, distance, closest: domains whose nearest site is one or two edits away, with that site, the first of
    equally near ones by ``order`` (default: name).  One row a domain, however many sites are near."""
    named = _ranked(sites, order)
    near = N.nearest_within_two(domains.select(F.col(domain).alias("left")).distinct(), named).where("distance > 0")
    return near.join(named, "rank").select(F.col("left").alias(domain), "distance", F.col("right").alias("closest"))


def look_alike_groups(hosts: DataFrame, host: str = "domain") -> DataFrame:
    """host, representative: families of hosts, each at most two edits from another of its family."""
    return N.groups_within_two(hosts, host)


def nearest_sites(domains: DataFrame, sites: DataFrame, order: Column | None = None,
                  domain: str = "domain", far: bool = True) -> DataFrame:
    """domain, distance, closest: the first site with the smallest edit distance.

    ``sites(domain)`` is the trusted list; ``order`` breaks ties (default: name).  An empty list gives (99, ''),
    and so does a null domain.  Sites within two edits come from gap keys, those within the bounds of
    ``PIECE_BOUNDS`` from shared pieces.  What is left is compared with all sites, block by block, the best distance so
    far bounding the next test; without ``far`` it gets (99, '') instead.  A list of ``FEW_SITES`` at most is
    compared as a whole at once.
    """
    targets = N.with_letters(domains.select(F.col(domain).alias("left")).distinct(), "left")
    named = _ranked(sites, order)
    few = named.limit(FEW_SITES + 1).count() <= FEW_SITES
    if few and far:
        return _named(_nearest_of_all(targets, named), named, domain)
    found = staged_table(N.nearest_within_two(targets.select("left"), named), "near")
    left_over = targets
    for bound in (*PIECE_BOUNDS, None):
        left_over = staged_table(left_over.join(found.select("left"), "left", "left_anti"), "open")
        if left_over.isEmpty():
            break
        if bound is not None:
            near = N.nearest_by_pieces(left_over, named, bound)
        elif far:
            near = _nearest_of_all(left_over, named)
        else:
            near = left_over.select("left", F.lit(NO_SITE_DISTANCE).alias("distance"), F.lit(0).cast("long").alias("rank"))
        found = found.unionByName(staged_table(near, "near"))
    return _named(found, named, domain)


def _named(found: DataFrame, named: DataFrame, domain: str) -> DataFrame:
    return found.join(named, "rank", "left").select(
        F.col("left").alias(domain), "distance", F.coalesce("right", F.lit("")).alias("closest"))


def _nearest_of_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """left, distance, rank by a fold over blocks of sites: one row per string and block, never one per pair."""
    blocks = F.greatest(F.ceil(right.agg(F.count("*")).scalar() / BLOCK_SITES), F.lit(1)).cast("int")
    packed = right.withColumn("_block", F.pmod(F.xxhash64("right"), blocks).cast("int")).groupBy("_block").agg(
        F.array_sort(F.collect_list(F.struct("rank", "right"))).alias("_sites"))

    def better(best: Column, s: Column) -> Column:
        # equally near sites later in the block have larger ranks
        gap = F.call_function("levenshtein", s["right"], F.col("left"), best["distance"] - 1)
        return F.when(gap >= 0, F.struct(gap.alias("distance"), s["rank"].alias("rank"))).otherwise(best)

    start = F.struct(F.lit(NO_SITE_DISTANCE).alias("distance"), F.lit(0).cast("long").alias("rank"))
    spread = left.withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    sites = F.coalesce("_sites", F.array().cast(packed.schema["_sites"].dataType))
    folded = lookup(spread, packed, "_block", F.col("left"), salts=BLOCK_SALTS).select("left", F.aggregate(sites, start, better).alias("best"))
    return folded.groupBy("left").agg(F.min("best").alias("best")).select("left", "best.distance", "best.rank")


def brand_map(sites: DataFrame, suffixes: Iterable[str] | None = None) -> DataFrame:
    """brand, site: label of every trusted site; the first site by name keeps a label."""
    label = U.brand_label(F.col("domain"), suffixes)
    return (sites.select(F.lower(label).alias("brand"), F.lower("domain").alias("site"))
            .where(F.col("brand").isNotNull()).groupBy("brand").agg(F.min("site").alias("site")))


def brand_impersonation(domains: DataFrame, brands: DataFrame, suffixes: Iterable[str] | None = None,
                        small: bool = False) -> DataFrame:
    """domain, closest, distance, reason for domains that imitate a brand.

    A brand name plus a risky word comes first (distance 0), then the smallest distance
    within 1 (brands below 8 letters) or 2, then the site's name.
    """
    label = U.domain_label(F.col("domain"), suffixes)
    parts = domains.select("domain").distinct().withColumn("_t", U.label_tokens(label))
    tokens = parts.select("domain", "_t", F.explode_outer(F.array_distinct("_t")).alias("token")).where(
        F.length("token") >= 4)
    known = brands.where(F.length("brand") >= 4)

    allowed = F.when(F.length("right") < 8, 1).otherwise(2)
    pairs = edit_neighbours(tokens.select(F.col("token").alias("left")),
                            known.select(F.col("brand").alias("right")), allowed).where("distance > 0")
    near = pairs.join(known, pairs["right"] == known["brand"]).groupBy(F.col("left").alias("token")).agg(
        F.min(F.struct("distance", "site")).alias("_near"))
    # one row per token, so a token shared by many domains meets a single row
    exact = known.select(F.col("brand").alias("token"), F.col("site").alias("_exact"))
    facts = exact.join(near, "token", "full")
    seen = lookup(tokens, facts, "token", F.col("domain"), small)

    risky = F.array_sort(F.array_intersect(
        F.filter("_t", lambda t: t != F.col("token")), strings(K.RISKY_BRAND_MODIFIERS)))
    reused = F.when(F.col("_exact").isNotNull() & (F.size(risky) > 0), F.struct(
        F.col("_exact").alias("site"), F.array_join(F.slice(risky, 1, 3), ", ").alias("words")))
    found = seen.groupBy("domain").agg(F.min(reused).alias("_r"), F.min("_near").alias("_n"))
    r, n = F.col("_r"), F.col("_n")
    return found.where(r.isNotNull() | n.isNotNull()).select(
        "domain", F.coalesce(r["site"], n["site"]).alias("closest"),
        F.when(r.isNotNull(), 0).otherwise(n["distance"]).alias("distance"),
        F.when(r.isNotNull(), F.concat(
            F.lit("Domain reuses a trusted brand name with risky modifiers: "), r["words"], F.lit(".")))
        .otherwise(F.concat(F.lit('Domain looks similar to trusted site "'), n["site"], F.lit('" (distance '),
                            n["distance"].cast("string"), F.lit(").")))
        .alias("reason"))
