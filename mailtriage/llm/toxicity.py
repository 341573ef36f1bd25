"""Toxicity by a weighted lexicon: learnt from labels, matched by Aho-Corasick on folded text.

Folding maps look-alike letters and digit substitutions to plain letters.  Entries are whole words or word
beginnings; hits inside exception phrases do not count; the sum of weights is normalised by length and
turned into a probability by a logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtriage.llm.bits import TABLE_BITS, BitTable
from mailtriage.llm.common import column_of, documents, fold, text_groups, texts_of
from mailtriage.session import staged_table

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ո": "n", "ս": "u", "օ": "o", "ց": "g", "հ": "h",
}
# Characters written in place of letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
# Phrases in which a listed word is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "class clown", "idiot proof",
    "pathetic fallacy", "pond scum", "soap scum", "idiot light", "sore loser", "worthless currency",
)

GLYPHS = str.maketrans(HOMOGLYPHS)
INVISIBLE = re.compile(r"[\u00ad\u200b-\u200f\u2060\ufeff]")
MARKS = re.compile(r"[013457@$!](?=[013457@$!]*[^\W\d_])|(?<=[^\W\d_])[013457](?![^\W_])")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
FLUSH_TERMS = 400_000


def folded(text: str) -> str:
    """Compatibility form, lower case, no invisible characters, look-alikes and substitutions as letters."""
    if not text.isascii():
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(GLYPHS)
    else:
        text = text.lower()
    return MARKS.sub(lambda m: SUBSTITUTES[m.group()], text)


def terms(text: str) -> set[str]:
    """Words of three letters or more and, with a star, their beginnings."""
    words = {w for w in WORD.findall(folded(text)) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


def _word_ends(text: str, at: int) -> bool:
    """No letter at ``at``, or a plural s and then none."""
    at += text.startswith("s", at)
    return at >= len(text) or not text[at].isalpha()


def _outside(best: dict[int, tuple[int, float]], spared: list[tuple[int, int]]) -> list[float]:
    """Weights of the hits that lie inside no spared stretch, in one sweep over both: of the stretches begun so
    far, a hit is inside one if it ends before the furthest of them does."""
    spared.sort()
    out, at, reach = [], 0, -1
    for start, (end, weight) in sorted(best.items()):
        while at < len(spared) and spared[at][0] <= start:
            reach = max(reach, spared[at][1])
            at += 1
        if end > reach:
            out.append(weight)
    return out


@dataclass
class Lexicon:
    """Entry -> weight, harmless phrases, and the curve (bias, slope of the sum, slope of the density)."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-6.0, 2.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), False, 0.0))
        for entry, weight in self.entries.items():
            word = entry.rstrip("*")
            found.add_word(word, (len(word), entry.endswith("*"), weight))
        if len(found):
            found.make_automaton()
        return found

    def features(self, automaton: ahocorasick.Automaton, text: str) -> tuple[float, float, int]:
        """Log of the weight sum, log of the sum per 100 words, number of hits."""
        if not len(automaton):
            return 0.0, 0.0, 0
        text = folded(text)
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, beginning, weight) in automaton.iter(text):
            start = end - size + 1
            if start and text[start - 1].isalpha() or not beginning and not _word_ends(text, end + 1):
                continue
            if not weight:
                spared.append((start, end))
            elif start not in best or best[start][1] < weight:
                best[start] = (end, weight)
        hits = _outside(best, spared)
        total = sum(hits)
        return float(np.log1p(total)), float(np.log1p(100 * total / (1 + text.count(" ")))), len(hits)

    def score(self, a: float, b: float) -> float:
        if not self.entries:
            return 0.0
        bias, slope, dense = self.curve
        return float(1 / (1 + np.exp(-(bias + slope * a + dense * b))))


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic documents, other documents), added up within tasks and then by key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)],
                ["term", "toxic", "other"])
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in text_groups(batches):
            for text, toxic in zip(texts_of(batch), column_of(batch, "toxic").to_pylist()):
                counts[toxic != 1].update(terms(text))
            if len(counts[0]) + len(counts[1]) > FLUSH_TERMS:
                yield flush()
        yield flush()

    parts = rows.select("text", "toxic").mapInArrow(run, "term string, toxic long, other long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def labelled(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Training rows (doc_id, text, toxic): ids outside the held-out fold with a label of 0 or 1, each id once.

    Of equal texts with equal labels one row stays, so that copies are no evidence of their own.
    """
    docs = documents(docs, id_col, text_col)
    return _with_labels(docs, labelled_ids(docs, labels, folds, held, id_col, label_col))


def labelled_ids(docs: DataFrame, labels: DataFrame, folds: int, held: int, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, toxic) of the training rows, staged: no text is shuffled."""
    keys = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
            .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prints = docs.select("doc_id", F.xxhash64("text").alias("a"), F.crc32(F.col("text").cast("binary")).alias("b"))
    return staged_table(prints.join(keys, "doc_id").groupBy("a", "b", "toxic").agg(F.min("doc_id").alias("doc_id"))
                        .select("doc_id", "toxic"), "labelled")


def _with_labels(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` joined with the staged rows ``kept``: texts whose id is surely not among them are dropped where they are
    read, by a bit table of fixed size, and are not shuffled.

    The join is a merge at any size: it needs no memory for a side, and its shuffle grows with the labelled texts.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << TABLE_BITS)).alias("place")
    table = docs.sparkSession.sparkContext.broadcast(BitTable.empty().grown(kept.select(place)).bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            at = column_of(batch, "place").to_numpy()
            yield batch.filter(pa.array((bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)))

    likely = docs.select("doc_id", "text", place).mapInArrow(run, "doc_id long, text string, place long")
    return likely.drop("place").join(kept.hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, min_docs: int = 4, margin: float = 6.0,
        min_weight: float = 3.5, lexicon_size: int = 20_000, curve_rows: int = 20_000, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon from all labelled rows outside the held-out fold.

    A term enters with at least ``min_docs`` toxic documents and a log-likelihood ratio that chance does not
    reach among as many candidates (twice their logarithm plus ``margin``); its weight is the log odds ratio,
    above ``min_weight``.  The ``lexicon_size`` terms with the strongest evidence are kept, and of a word and
    its beginning the more telling one.  The curve is fitted on about ``curve_rows`` labelled rows chosen by hash.  Without labels of both kinds the lexicon is empty and all
    scores are 0.
    """
    docs = documents(docs)
    kept = labelled_ids(docs, labels, folds, held, "doc_id", "toxic")
    by = {r["toxic"]: r["n"] for r in docs.select("doc_id").join(kept, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = by.get(1, 0), by.get(0, 0)
    if not pos or not neg:
        return Lexicon(exceptions=exceptions)
    counts = staged_table(_term_counts(_with_labels(docs, kept)).where(F.col("toxic") >= min_docs), "terms")
    evidence = 2 * float(np.log(max(2, counts.count()))) + margin
    a, b = F.col("toxic") + F.lit(0.5), F.col("other") + F.lit(0.5)
    n, share = a + b, pos / (pos + neg)
    picked = (counts.withColumn("weight", F.log(a / (pos + 1.0)) - F.log(b / (neg + 1.0)))
              .withColumn("evidence", 2 * (a * F.log(a / (n * share)) + b * F.log(b / (n * (1 - share)))))
              .where((F.col("weight") > min_weight) & (F.col("evidence") >= evidence))
              .orderBy(F.desc("evidence"), "term").limit(lexicon_size).collect())
    lexicon = Lexicon(_telling({r["term"]: (float(r["weight"]), r["toxic"]) for r in picked}), exceptions)
    share = min(1.0, curve_rows / (pos + neg))
    sample = _with_labels(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share)), kept)
    points = [(r["sum"], r["density"], r["toxic"]) for r in _features(sample, lexicon, "toxic").collect()]
    lexicon.curve = _logistic(np.array(points, float).reshape(-1, 3))
    return lexicon


def _telling(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """A beginning stays if it reaches a fifth more documents than any one term it covers; it then replaces
    the terms that are no more telling.  Otherwise the longer terms stay."""
    kept: dict[str, float] = {}
    reach: dict[str, int] = {}
    for term in sorted(found, key=lambda t: (-len(t.rstrip("*")), t)):
        weight, toxic = found[term]
        word = term.rstrip("*")
        if term.endswith("*"):
            if toxic <= 1.2 * reach.get(word, 0):
                continue
            kept = {t: w for t, w in kept.items() if not t.startswith(word) or w > weight + 1.0}
        kept[term] = weight
        for n in PREFIXES:
            if n <= len(word):
                reach[word[:n]] = max(reach.get(word[:n], 0), toxic)
    return kept


def _logistic(points: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; classes weigh the same."""
    if not len(points) or len(set(points[:, 2])) < 2:
        return Lexicon().curve
    x, y = np.column_stack([np.ones(len(points)), points[:, :2]]), points[:, 2]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        slope = x.T @ (weight * (y - p)) - ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def _features(rows: DataFrame, lexicon: Lexicon, keep: str) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(lexicon)  # at most lexicon_size entries
    kind = dict(rows.dtypes)[keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value.automaton()
        for batch in text_groups(batches):
            found = [held.value.features(automaton, text) for text in texts_of(batch)]
            a, b, hits = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, keep), pa.array(a, pa.float64()), pa.array(b, pa.float64()), pa.array(hits, pa.int64()),
                 pa.array([held.value.score(u, v) for u, v in zip(a, b)], pa.float64())],
                [keep, "sum", "density", "hits", "score"])

    return rows.select(keep, "text").mapInArrow(run, f"{keep} {kind}, sum double, density double, hits long, score double")


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on), hits; one row per input row, whole texts.

    Null and empty texts have no hit and get the curve's floor (0 with an empty lexicon).  Repeated rows and
    null ids are scored like any other; an empty table gives no rows.
    """
    found = _features(documents(docs, id_col, text_col), lexicon, "doc_id")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text scores below ``threshold``.

    Null and empty texts score the curve's floor and stay with any threshold above it; repeated rows share their fate,
    null ids are kept, an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value.automaton()
        for batch in text_groups(batches):
            keep = [held.value.score(*held.value.features(automaton, t or "")[:2]) < threshold for t in texts_of(batch)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
