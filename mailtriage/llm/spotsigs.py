"""Document fingerprints by spot signatures, in DataFrame functions only.

Common words are anchors.  Each anchor with the next two content words behind it (common words between them are
passed over, however many) is one signature, a spot.  Where three content words stand next to each other, without
an anchor, they are a signature as well, so that stretches and texts without common words are described too.  Both
rules look at neighbouring words only, so every text has the same kinds of signature.  A document's fingerprint is
the sorted set of its signature hashes.  Sets are compared by Jaccard similarity; near duplicates are found inside
partitions by set length, through the rarest signatures of each set, and measured only if their lengths allow the
threshold.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailtriage.llm.common import documents
from mailtriage.session import staged_table

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "were", "with", "au", "aux", "avec", "dans", "des", "du", "est", "et", "la", "le", "les", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une", "als", "auf", "das", "dem", "den", "der", "die", "ein", "eine",
    "ist", "mit", "nicht", "und", "von", "zu", "al", "con", "de", "del", "el", "en", "las", "los", "no", "para", "por",
    "se", "su", "una", "y",
)
BUCKET_ROWS, MOST_BUCKETS = 4096, 100_000

_TAILS = {first: sorted(w[1:] for w in ANCHORS if w[0] == first) for first in sorted({w[0] for w in ANCHORS})}
_ANY = "(?:" + "|".join(f"{first}(?:{'|'.join(tails)})" for first, tails in _TAILS.items()) + ")"  # by first letter
#: A content word with the anchors before it; a mark behind the last word ends the last piece.
END = "\u0001"
PIECE = f"((?:{_ANY} )*+[^ ]+) "
#: Letters of scripts written without spaces are words of their own.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def with_spots(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the sorted distinct signature hashes of column ``text`` as column ``name``.

    A text without any signature (fewer than three words, say) has one, its own hash; an empty text has none.  The
    steps are columns of their own, so that each is computed once a row, in time proportional to the text: the
    text is cut into pieces, each a content word with the anchors before it, and looked at piece by piece.
    """
    pieces, content, found = f"_{name}_pieces", f"_{name}_content", f"_{name}_found"
    low = F.lower(text)
    low = F.when(F.col(text).rlike(UNSPACED), F.regexp_replace(low, UNSPACED, " $1 ")).otherwise(low)
    words = F.concat(F.ltrim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), F.lit(f" {END} "))
    words = F.regexp_replace(words, f"  {END}", f" {END}")
    rows = rows.withColumn(pieces, F.regexp_extract_all(words, F.lit(PIECE), F.lit(1)))
    rows = rows.withColumn(content, F.transform(pieces, lambda p: F.substring_index(p, " ", -1)))
    c = F.col(content)

    def spots(p: Column, j: Column) -> Column:
        anchors = F.array_distinct(F.split(F.regexp_extract(p, "^(.*) ", 1), " "))
        spot = F.transform(anchors, lambda a: F.xxhash64(a, F.get(c, j), F.get(c, j + 1)))
        return F.when(F.contains(p, F.lit(" ")), spot).otherwise(F.array().cast("array<bigint>"))

    def plain(i: Column) -> Column:
        return ~F.contains(F.get(F.col(pieces), i), F.lit(" "))

    def runs(p: Column, j: Column) -> Column:
        run = F.array(F.xxhash64(F.lit("run"), F.get(c, j), F.get(c, j + 1), F.get(c, j + 2)))
        return F.when((j + 3 < F.size(c)) & plain(j + 1) & plain(j + 2), run).otherwise(F.array().cast("array<bigint>"))

    inner = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 2, F.lit(0)))
    rows = rows.withColumn(found, F.flatten(F.transform(inner, lambda p, j: F.concat(spots(p, j), runs(p, j)))))
    own = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.lit("text"), text)))
    rows = rows.withColumn(name, F.when(F.size(found) > 0, F.sort_array(F.array_distinct(found))).otherwise(own))
    return rows.drop(pieces, content, found)


def spelt(signatures: Column) -> Column:
    """Fingerprint as text: 16 hexadecimal digits for each signature."""
    return F.lower(F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s), 16, "0")), ""))


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets, 1 for two empty ones; 0 without counting if the set lengths
    alone keep it under ``floor``."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b)
    return (F.when(total == 0, 1.0).when(F.least(F.size(a), F.size(b)) < floor * F.greatest(F.size(a), F.size(b)), 0.0)
            .otherwise(common / (total - common)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, signatures (sorted hashes) and fingerprint of every row; null texts are empty."""
    rows = documents(docs, id_col, text_col)
    rows = with_spots(rows.withColumn("n_chars", F.char_length("text").cast("long")), "text", "signatures")
    return rows.select("doc_id", "n_chars", "signatures", spelt(F.col("signatures")).alias("fingerprint"))


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with column _g: ranges of doc_id with about ``BUCKET_ROWS`` rows each, null ids in the last."""
    n = rows.agg(F.count("doc_id")).first()[0]
    k = min(MOST_BUCKETS, math.ceil(n / BUCKET_ROWS))
    if k < 2:
        return rows.withColumn("_g", F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / k for i in range(1, k)], 10 * k)).first()[0]
    splits = [-math.inf, *sorted({float(c) for c in cuts}), math.inf]
    if len(splits) < 3:
        return rows.withColumn("_g", F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket", handleInvalid="keep")
    found = cut.transform(rows.withColumn("_at", F.col("doc_id").cast("double")))
    return found.withColumn("_g", F.col("_bucket").cast("int")).drop("_at", "_bucket")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, signatures, next_text, next_signatures): each row with the next one by ascending doc_id, the last
    with the first.

    Rows are dealt by ranges of doc_id; the first row of each range is also given to the range before it, so
    one shuffle of the texts is enough.  Equal ids are ordered by text hash; null ids come last.
    """
    rows = _bucketed(docs.withColumn("_h", F.md5(F.col("text").cast("binary"))))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_h"))
    firsts = rows.groupBy("_g").agg(F.min(order).alias("o")).select("_g", F.col("o.doc_id").alias("id"), F.col("o._h").alias("h"))
    firsts = sorted(firsts.collect(), key=lambda r: r["_g"])  # one short row per range
    spark = docs.sparkSession
    before = [(r["id"], r["h"], firsts[i - 1]["_g"]) for i, r in enumerate(firsts)]
    before = spark.createDataFrame(before, "id long, h string, before int")
    extra = (rows.join(F.broadcast(before), rows["doc_id"].eqNullSafe(before["id"]) & (rows["_h"] == before["h"]))
             .dropDuplicates(["before"]).select("doc_id", "text", "_h", F.col("before").alias("_g"), F.lit(1).alias("_extra")))
    both = rows.select("doc_id", "text", "_h", "_g", F.lit(0).alias("_extra")).unionByName(extra)
    both = with_spots(both, "text", "signatures")
    one_by_one = Window.partitionBy("_g").orderBy("_extra", F.col("doc_id").asc_nulls_last(), "_h")
    return (both.withColumn("next_text", F.lead("text").over(one_by_one)).withColumn("next_signatures", F.lead("signatures").over(one_by_one))
            .where("_extra = 0").select("doc_id", "text", "signatures", "next_text", "next_signatures"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, in which the last floor(n_chars / 2) code points
    gave way to as many first ones of the next document.

    Columns: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.  Null texts
    are empty; two empty fingerprints are alike (1.0).  Both likenesses are functions of the two fingerprints alone.
    Repeated rows follow each other; a single row is its own next; an empty table gives no rows.
    """
    rows = with_next(documents(docs, id_col, text_col))
    n = F.char_length("text")
    rows = rows.withColumn("half", F.floor(n / 2).cast("int")).withColumn("n_chars", n.cast("long"))
    kept = F.expr("substring(text, 1, cast(n_chars - half as int))")
    rows = rows.withColumn("edited_text", F.concat(kept, F.expr("substring(next_text, 1, half)")))
    rows = with_spots(rows, "edited_text", "edited_signatures")
    a, b = F.col("signatures"), F.col("edited_signatures")
    return rows.select("doc_id", "n_chars", "edited_text", spelt(a).alias("fingerprint"), spelt(b).alias("edited_fingerprint"),
                       likeness(a, b).alias("near_edited"), likeness(a, F.col("next_signatures")).alias("near_next"))


def similar_sets(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, fingerprint; pairs: a, b, similarity of different fingerprints at ``threshold`` or more).

    Pairs are exact over fingerprints.  A set of n signatures can only reach the threshold with sets whose
    length lies between threshold * n and n / threshold, so sets go to logarithmic length partitions and are
    compared within one and with the next; a pair must share one of the n - ceil(threshold * n) + 1 rarest
    signatures, so only those are joined.  Copies are members of one fingerprint and never paired.
    """
    members = staged_table(fingerprints(docs, id_col, text_col), "spots")
    sets = members.groupBy("fingerprint").agg(F.first("signatures").alias("signatures")).where(F.size("signatures") > 0)
    sets = staged_table(sets.withColumn("n", F.size("signatures")).withColumn("key", F.sha2("fingerprint", 256)), "sets")
    flat = sets.select("key", "n", F.explode("signatures").alias("s"))
    rarity = flat.groupBy("s").agg(F.count("*").alias("df"))
    kept = F.expr(f"n - cast(ceil({threshold} * n - 1e-9) as int) + 1")
    ranked = (flat.join(rarity, "s").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("o"))
              .select("key", "n", F.explode(F.transform(F.slice("o", F.lit(1), kept), lambda x: x["s"])).alias("s")))
    length = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    ranked = staged_table(ranked.withColumn("part", length), "prefixes")
    left = ranked.select(F.col("key").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array("part", F.col("part") + 1, F.col("part") + 2)).alias("part"),
                         F.col("part").alias("pa"))
    right = ranked.select(F.col("key").alias("b"), F.col("n").alias("nb"), "s", "part")
    close = F.least("na", "nb") >= (threshold - 1e-9) * F.greatest("na", "nb")
    apart = (F.col("part") > F.col("pa")) | (F.col("a") < F.col("b"))
    pairs = left.join(right, ["s", "part"]).where(close & apart & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    texts = sets.select("key", "signatures", "fingerprint")
    pairs = (pairs.join(texts.select(F.col("key").alias("a"), F.col("signatures").alias("x"), F.col("fingerprint").alias("fa")), "a")
             .join(texts.select(F.col("key").alias("b"), F.col("signatures").alias("y"), F.col("fingerprint").alias("fb")), "b"))
    pairs = pairs.withColumn("similarity", likeness(F.col("x"), F.col("y"), threshold - 1e-9)).where(F.col("similarity") >= threshold - 1e-9)
    return members.select("doc_id", "fingerprint"), pairs.select(F.col("fa").alias("a"), F.col("fb").alias("b"), "similarity")
