"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count exactly until closed.

Phrases of the sample that reach a lowered count are the proposals.  A full pass counts every word, and every
longer phrase whose first and last part, one word shorter each, are proposals: the proposals themselves and
their negative border.  A border phrase that turns out frequent is a failure; it joins the proposals, and a
further pass counts what it makes countable, until no failure is left; few failures are extended to full length in
one pass.  No part of a frequent phrase is rarer
than the phrase, so then every frequent phrase has been counted, whatever the sample was.

Passes count by 64-bit hashes of phrases: a hash occurs at least as often as each of its phrases, so no frequent
one is missed.  Proposals, and at the end the hashes that reached the count, travel as bit tables of fixed size.  A
last pass spells the phrases these let through and counts them themselves, so a collision costs time and changes
no result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mailtriage.llm import bits
from mailtriage.llm.bits import BitTable
from mailtriage.llm.common import column_of, text_groups
from mailtriage.session import staged_table

LONGEST = 4
LEAST = 30
SAMPLE_ONE_IN = 8
SAMPLE_LEAST = 2
BOLD = 0.25  # failures, as a share of the proposals, that are extended in a single pass
GROUP_BYTES = 3 << 20
OUT_ROWS = 200_000
RANK_SALTS = 256
MARKS = r"[.,;:!?\n-\r]"
MIX = np.uint64(0x9E3779B97F4A7C15)

COUNTED = "lang string, phrase string, words int, f long"
HASHED = "hash long, f long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def _distinct(columns: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(first place, count) of the distinct rows of columns, each with the number of its codes."""
    key, room = np.zeros(len(columns[0][0]), np.int64), 1
    for codes, n in columns:
        if room * n >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            room = int(key.max()) + 1
        key, room = key * n + codes, room * n
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return first, count


class _Words:
    """The words of some documents as numbers, with the piece and language each stands in."""

    def __init__(self, batch: pa.RecordBatch):
        # a mark stands alone after this, and no white space but blanks and tabs is left
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(column_of(batch, "text")), MARKS, " . "))
        sizes = pc.list_value_length(lists).to_numpy()
        langs, words = column_of(batch, "lang").dictionary_encode(), lists.flatten().dictionary_encode()
        self.langs, self.spelt, code = langs.dictionary, words.dictionary, words.indices.to_numpy()
        spelt = self.spelt.to_numpy(zero_copy_only=False).tolist()
        kind = np.array([{"": 2, ".": 1}.get(w, 0) for w in spelt], np.int8)[code]
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        word = kind == 0
        self.place = (doc + np.cumsum(kind == 1, dtype=np.int32))[word]  # rises at every mark and document
        self.lang = langs.indices.to_numpy()[doc[word]]
        self.code = code[word]
        self.of_word = bits.hashes(spelt)
        self.of_lang = bits.hashes(self.langs.to_pylist())

    def __len__(self) -> int:
        return len(self.code)

    def starts(self) -> np.ndarray:
        return np.arange(len(self), dtype=np.int32)

    def longer(self, at: np.ndarray, may: np.ndarray, k: int) -> np.ndarray:
        """Of the places ``at`` where phrases of k - 1 words begin, those of k words: both parts ``may`` be extended."""
        at = at[may[at] & may[at + 1]]
        at = at[at + k <= len(self)]
        return at[self.place[at] == self.place[at + k - 1]]

    def grow(self, hashes: np.ndarray, at: np.ndarray, k: int) -> None:
        hashes[at] = _mixed(hashes[at] + self.of_word[self.code[at + k - 1]])


def _hash_counts(words: _Words, table: BitTable, done: BitTable | None, bold: bool) -> Iterator[pa.RecordBatch]:
    """Hashes of the countable phrases, the lowest two bits telling their length, with their counts; what ``done`` made
    countable has been counted before.  If ``bold``, what is counted here counts as extendable."""
    hashes, at = words.of_lang[words.lang], words.starts()
    was = np.full(len(words), done is not None)  # whether the phrase that begins here was countable before
    for k in range(1, LONGEST + 1):
        if k > 1:
            may, might = np.zeros((2, len(words) + 1), bool)
            may[at] = table.holds(hashes[at]) | (bold & ~was[at])
            if done is not None:
                might[at] = was[at] & done.holds(hashes[at])
            at = words.longer(at, may, k)
            was[at] = might[at] & might[at + 1]
        words.grow(hashes, at, k)
        found, count = np.unique(hashes[at[~was[at]]] & ~np.uint64(3) | np.uint64(k - 1), return_counts=True)
        for cut in range(0, len(found), OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(found[cut : cut + OUT_ROWS].view(np.int64)), pa.array(count[cut : cut + OUT_ROWS])], ["hash", "f"])


def _phrase_counts(words: _Words, hot: BitTable) -> Iterator[pa.RecordBatch]:
    """Phrases whose hashes are ``hot``, spelt, with their counts, and per language the empty phrase with all its words."""
    total = np.bincount(words.lang, minlength=len(words.langs))
    yield _rows(words.langs, pa.array([""] * len(total)), 0, total)
    hashes, at = words.of_lang[words.lang], words.starts()
    for k in range(1, LONGEST + 1):
        may = np.zeros(len(words) + 1, bool)
        if k > 1:
            may[at] = True
            at = words.longer(at, may, k)
        words.grow(hashes, at, k)
        at = at[hot.holds(hashes[at])]  # a phrase is no more frequent than its parts
        if not len(at):
            break
        first, count = _distinct([(words.lang[at], len(words.langs)), *((words.code[at + j], len(words.spelt)) for j in range(k))])
        first = at[first]
        for cut in range(0, len(first), OUT_ROWS):
            some = first[cut : cut + OUT_ROWS]
            columns = [words.spelt.take(pa.array(words.code[some + j])) for j in range(k)]
            phrase = pc.binary_join_element_wise(*columns, " ") if k > 1 else columns[0]
            yield _rows(words.langs.take(pa.array(words.lang[some])), phrase, k, count[cut : cut + OUT_ROWS])


def _rows(lang: pa.Array, phrase: pa.Array, words: int, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(count), words, np.int32)), pa.array(count.astype(np.int64))],
                                      ["lang", "phrase", "words", "f"])


def _pass(docs: DataFrame, table: BitTable, done: BitTable | None, bold: bool, least: int) -> DataFrame:
    """Hashes of the phrases that became countable and reach ``least``, from one pass over all texts.  Counts are added
    up per batch and task before the shuffle."""
    send = docs.sparkSession.sparkContext.broadcast  # two tables of fixed size
    now, past = send(table.bits), None if done is None else send(done.bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BitTable(now.value), None if past is None else BitTable(past.value)
        for batch in text_groups(batches, GROUP_BYTES):
            yield from _hash_counts(_Words(batch), *tables, bold)

    counts = docs.mapInArrow(run, HASHED).groupBy("hash").agg(F.sum("f").alias("f"))
    return staged_table(counts.where(F.col("f") >= least).select("hash"), "phrase-hashes")


def closed_table(docs: DataFrame, table: BitTable, least: int) -> tuple[BitTable, int]:
    """(bit table that holds every phrase of up to LONGEST words with ``least`` occurrences, passes made).

    After a bold pass nothing is left to count: each part of a frequent phrase was either found before or counted in
    that pass.  Bold passes are for few failures, since they also count extensions of phrases that turn out rare.
    """
    hot, done, bold, passes = table, None, False, 0
    while True:
        found = _pass(docs, table, done, bold, least)
        place = F.shiftrightunsigned("hash", 64 - table.width).alias("place")
        hot = hot.grown(found.select(place))
        grown = table if bold else table.grown(found.where(F.col("hash").bitwiseAND(3) < LONGEST - 1).select(place))
        passes += 1
        if bold or (grown.bits == table.bits).all():
            return hot, passes
        done, table = table, grown
        before = done.members()
        bold = table.members() - before <= BOLD * before


def _spelt(docs: DataFrame, hot: BitTable, least: int) -> DataFrame:
    """Exact counts of the phrases that the table holds, those of ``least`` and more kept."""
    held = docs.sparkSession.sparkContext.broadcast(hot.bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, GROUP_BYTES):
            yield from _phrase_counts(_Words(batch), BitTable(held.value))

    counts = docs.mapInArrow(run, COUNTED).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return staged_table(counts.where(f"words = 0 or f >= {least}"), "phrases")


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample_one_in: int = SAMPLE_ONE_IN, sample_least: int = SAMPLE_LEAST,
                     id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, words, f) of every phrase of 1 to LONGEST words with f >= ``least`` occurrences, and per language
    the empty phrase with the number of its words.

    The sample takes whole documents by a hash of id and text; it decides how many passes are needed, never the
    result.
    """
    chosen = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(sample_one_in)) == 0
    sample = staged_table(_texts(docs.where(chosen), text_col, lang_col), "sample")
    proposals, _ = closed_table(sample, BitTable.empty(), sample_least)
    texts = _texts(docs, text_col, lang_col)
    hot, _ = closed_table(texts, proposals, least)
    return _spelt(texts, hot, least)


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("w", start, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the ``top`` phrases of 2 to 4 words.

    A text is lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.
    A null text is empty, a null language ``und``, repeated rows count once each, an empty table gives no rows.  The
    score of a cut into l and r occurrences is floor(2000000 a / (l + r)); the lowest cut counts, the earliest of equal
    ones.  Phrases whose words lie inside a longer one with 80 % of their occurrences are left out.  Equal scores are
    ranked by a, then by phrase.  ``options`` are those of :func:`frequent_phrases`.
    """
    found = frequent_phrases(docs, least, **options)
    parts = found.where("words between 1 and 3").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    phrases = found.where("words >= 2").withColumn("w", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": _part(F.lit(1), F.col("k")), "rest": _part(F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = (cuts.join(parts.withColumnsRenamed({"part": "first", "part_f": "l"}), ["lang", "first"])
            .join(parts.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"]))
    exact = F.expr("(cast(f as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)")
    best = cuts.groupBy("lang", "phrase", "f").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    inside = phrases.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = inside.groupBy("lang", _part(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where("longer is null or cast(longer as decimal(20, 0)) * 100 < cast(f as decimal(20, 0)) * 80")
    # the best of each of RANK_SALTS parts of a language first, so that no task ranks all its phrases
    best_first = [F.desc("cut.score"), F.desc("f"), F.col("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    near = salted.withColumn("place", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*best_first))).where(F.col("place") <= top)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= top)
    words = found.where("words = 0").select("lang", F.col("f").alias("n"))  # one row a language
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("long").alias("score"))
