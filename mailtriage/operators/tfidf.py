"""Sublinear smoothed TF-IDF blocks over n-grams.

Vocabularies come from the counts of ``ngrams``.  A block is one Spark ML stage, which counts, weighs and norms the
terms of whole Arrow batches and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X
from mailtriage.functions.literals import no_strings
from mailtriage.operators import ngrams as NG
from mailtriage.operators.lookup import computed_once
from mailtriage.session import staged_table


def stop_words() -> list[str]:
    """Spark ML's English list; pass another list where results must follow it."""
    return list(K.STOP_WORDS)


def word_terms(text: Column, stops: Iterable[str] | None = None) -> Column:
    """Lower-cased words of two or more characters without stop words, and their pairs."""
    stops = list(stop_words() if stops is None else stops)
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stops))


def with_pairs(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                       F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def char_terms(text: Column, sizes: Iterable[int] = (3, 4, 5)) -> Column:
    """Character n-grams inside words padded by one blank on each side.

    A padded word no longer than n is taken whole, once.
    """
    sizes = list(sizes)
    words = F.filter(F.split(X.normalise(text), " "), lambda w: w != "")

    def windows(padded: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
        found = F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))
        # too short for n: only the smallest size takes the word whole
        return found if n == min(sizes) else F.when(F.length(padded) >= n, found).otherwise(
            no_strings())

    def grams(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        return F.concat(*[windows(padded, n) for n in sizes])

    return F.flatten(F.transform(words, grams))


def term_columns(features: DataFrame, stops: Iterable[str] | None = None) -> DataFrame:
    """Append ``subject_terms``, ``body_terms``, ``char_terms`` to a feature frame."""
    words = features.withColumns({"_sw": word_terms(F.col("subject_text"), stops),
                                  "_bw": word_terms(F.col("body_text"), stops)})
    # later stages read each list several times
    return computed_once(words, subject_terms=with_pairs(F.col("_sw")), body_terms=with_pairs(F.col("_bw")),
                         char_terms=char_terms(F.col("combined_text"))).drop("_sw", "_bw")


def text_columns(features: DataFrame, stops: Iterable[str] | None = None) -> DataFrame:
    """Append the texts that the blocks cut into terms: ``subject_words``, ``body_words``, ``char_text``."""
    stops = stop_words() if stops is None else list(stops)
    return computed_once(features, subject_words=NG.word_text(F.col("subject_text"), stops),
                         body_words=NG.word_text(F.col("body_text"), stops), char_text=NG.char_text(F.col("combined_text")))


def block_stats(df: DataFrame) -> DataFrame:
    """block, term, tf (occurrences), df (mails) over the columns of :func:`text_columns`."""
    return NG.gram_stats(df, WORD_BLOCKS, CHAR_BLOCKS)


def block_vocabularies(df: DataFrame, min_df: int = K.MIN_DOC_FREQ) -> DataFrame:
    """block, term, tf, df of the terms each block keeps, without counting every term of the corpus in one place."""
    return NG.vocabularies(df, WORD_BLOCKS, CHAR_BLOCKS, {b.name: b.size for b in BLOCKS}, min_df)


def vocabulary(stats: DataFrame, size: int, min_df: int = K.MIN_DOC_FREQ) -> DataFrame:
    """The ``size`` most frequent terms of at least ``min_df`` mails (ties by name)."""
    return stats.where(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(size)


def idf(df: Column, n: Column | int) -> Column:
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + 1


def _row_counts(df: DataFrame, block: Block, key: str, terms: list[str]) -> DataFrame:
    """key, number, n: occurrences of the known terms, row by row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _term_entries(block.words, terms)
        for batch in NG.column_groups(batches, block.text):
            row, number, count = entries(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(count)], [key, "number", "n"])

    return df.select(key, block.text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, number int, n long")


def tfidf_rows(df: DataFrame, block: Block, key: str, vocab: list, n_rows: int) -> DataFrame:
    """key, term, weight as a long table (the same weighting in plain relational form) over the columns of :func:`text_columns`.

    ``vocab`` (rows with term, df) holds at most the block's term cap.  Rows of one key count as one mail, rows without a
    key are left out.  Terms are counted and weighed inside the task; only rows whose key occurs again are shuffled.
    """
    if not vocab:
        return df.select(key, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    terms, weights = [r["term"] for r in vocab], np.array(block_weights(vocab, n_rows))
    known = df.where(F.col(key).isNotNull())
    again = staged_table(known.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated")
    shape = f"`{key}` {df.schema[key].dataType.simpleString()}, term string, weight double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, spelt = _term_entries(block.words, terms), pa.array(terms, pa.string())
        for batch in NG.column_groups(batches, block.text):
            row, number, count = entries(batch.column(1))
            value = (1 + np.log(count)) * weights[number]
            norm = np.sqrt(np.bincount(row, value * value, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), spelt.take(pa.array(number)), pa.array(value / norm[row])],
                                             [key, "term", "weight"])

    single = known.join(again, key, "left_anti").select(key, block.text).mapInArrow(run, shape)
    # at most the term cap
    named = F.broadcast(df.sparkSession.createDataFrame([(i, t, float(w)) for i, (t, w) in enumerate(zip(terms, weights))],
                                                        "number int, term string, idf double"))
    counted = _row_counts(known.join(again, key, "left_semi"), block, key, terms).groupBy(key, "number").agg(F.sum("n").alias("n"))
    weighted = counted.join(named, "number").withColumn("w", (1 + F.log("n")) * F.col("idf"))
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    merged = weighted.join(norms, key).select(key, "term", (F.col("w") / F.col("_norm")).alias("weight"))
    return single.unionByName(merged)


# --- Spark ML form -----------------------------------------------------------

@dataclass
class Block:
    """One TF-IDF block: its term column, the text it is cut from, how many terms, words or characters."""

    name: str
    terms: str
    size: int
    text: str
    words: bool


BLOCKS = [
    Block("subject_word", "subject_terms", K.SUBJECT_TERMS, "subject_words", True),
    Block("body_word", "body_terms", K.BODY_TERMS, "body_words", True),
    Block("combined_char", "char_terms", K.CHAR_TERMS, "char_text", False),
]
WORD_BLOCKS = {b.name: b.text for b in BLOCKS if b.words}
CHAR_BLOCKS = {b.name: b.text for b in BLOCKS if not b.words}


def _word_hits(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term number) of every known word and word pair."""
    spelt, row, code, pair, second = NG.word_grams(texts)
    number = pc.fill_null(pc.index_in(spelt, terms), -1).to_numpy(zero_copy_only=False)
    pairs, which = np.unique(code[pair] * max(len(spelt), 1) + second, return_inverse=True)
    joined = pc.binary_join_element_wise(spelt.take(pa.array(pairs // max(len(spelt), 1))), spelt.take(pa.array(pairs % max(len(spelt), 1))), " ")
    of_pair = pc.fill_null(pc.index_in(joined, terms), -1).to_numpy(zero_copy_only=False)
    return np.concatenate([row, row[pair]]), np.concatenate([number[code], of_pair[which]]).astype(np.int64)


class _CharTerms:
    """Character terms as integers over the letters they are made of; larger alphabets wrap around like a hash."""

    def __init__(self, terms: list[str]):
        letters = sorted({ord(c) for t in terms for c in t})
        self.base = len(letters) + 1
        self.number = np.zeros(0x110000, np.int32)  # 0: in no term
        self.number[letters] = np.arange(1, len(letters) + 1)
        self.known = {}
        for n in NG.SIZES:
            places = [i for i, t in enumerate(terms) if len(t) == n]
            code = self.number[[ord(c) for i in places for c in terms[i]]] if places else np.zeros(0, np.int32)
            keys = NG.packed(code, np.arange(0, len(code), n), n, self.base)
            order = np.argsort(keys)
            self.known[n] = keys[order], np.array(places, np.int64)[order]

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term number, occurrences): n-grams never cross words, so they are looked up in the distinct words."""
        spelt, row, code, _, _ = NG.word_grams(texts)
        size = max(len(spelt), 1)
        pairs, times = np.unique(row * size + code, return_counts=True)
        row, word = pairs // size, pairs % size
        points, owner = NG.code_points(spelt)
        code, words, numbers = self.number[points], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, (keys, places) in self.known.items():
            if not len(keys):
                continue
            at = NG.windows(points, owner, n)
            key = NG.packed(code, at, n, self.base)
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = keys[found] == key
            words.append(owner[at[same]])
            numbers.append(places[found[same]])
        words, numbers = np.concatenate(words), np.concatenate(numbers)
        order = np.argsort(words, kind="stable")
        places, sizes = NG.repeated(words[order], len(spelt), word)
        return np.repeat(row, sizes), numbers[order][places], np.repeat(times, sizes)


def _term_entries(words: bool, terms: list[str]) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Function from texts to (row, term number, occurrences) of the known terms, by row and number."""
    known = pa.array(terms, pa.string()) if words else _CharTerms(terms)

    def entries(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if words:
            row, number = _word_hits(texts, known)
            row, number = row[number >= 0], number[number >= 0]
            count = np.ones(len(row), np.int64)
        else:
            row, number, count = known.hits(texts)
        place, size = row * len(terms) + number, len(texts) * len(terms)
        if size <= 2 * len(place):  # a table of all texts by all terms is no larger than the hits
            count = np.bincount(place, count, size).astype(np.int64)
            place = np.flatnonzero(count)
            return place // len(terms), place % len(terms), count[place]
        place, which = np.unique(place, return_inverse=True)
        return place // len(terms), place % len(terms), np.bincount(which, count, len(place)).astype(np.int64)

    return entries


VECTOR_BYTES = 512 << 10  # of text at a time while vectors are made
VECTORS = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def _block_vectors(entries: list[Callable], weights: list[np.ndarray], columns: tuple[pa.Array, ...]) -> Iterator[pa.Array]:
    """Normed vectors of texts, one column a block, block behind block: a piece for every VECTOR_BYTES of text."""
    first = np.cumsum([0, *map(len, weights)])
    for start, n in NG.cuts(columns, VECTOR_BYTES):
        found = []
        for column, known, weight, at in zip(columns, entries, weights, first):
            row, number, count = known(column.slice(start, n))
            value = (1 + np.log(count)) * weight[number]
            norm = np.sqrt(np.bincount(row, value * value, minlength=n))
            found.append((row, number + at, value / norm[row]))
        row, number, value = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(row, kind="stable")
        ends = pa.array(np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32))
        yield pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, first[-1], np.int32)), pa.ListArray.from_arrays(ends, pa.array(number[order].astype(np.int32))),
             pa.ListArray.from_arrays(ends, pa.array(value[order]))], fields=list(VECTORS))


def register_blocks(spark: SparkSession, function: str, blocks: list[tuple[bool, list[str], list[float]]]) -> None:
    """Register the vector function of some blocks (words or characters, terms, weights), which takes a text column for
    each; a saved model needs it again after loading.  One worker makes all vectors of a task, a piece at a time."""
    @F.arrow_udf(VectorUDT())
    def vectors(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        entries = [_term_entries(words, terms) for words, terms, _ in blocks]
        weights = [np.array(w, float) for _, _, w in blocks]
        for batch in batches:
            yield from _block_vectors(entries, weights, batch if isinstance(batch, tuple) else (batch,))

    spark.udf.register(function, vectors)


def register_block(spark: SparkSession, function: str, words: bool, terms: list[str], weights: list[float]) -> None:
    """Register the vector function of one block."""
    register_blocks(spark, function, [(words, terms, weights)])


def block_weights(vocab: list, n_rows: int) -> list[float]:
    return [float(np.log((1.0 + n_rows) / (1.0 + r["df"])) + 1.0) for r in vocab]


def block_stage(blocks: list[Block], function: str, name: str) -> SQLTransformer:
    """Stage that turns the blocks' text columns into one vector, every block normed by itself."""
    texts = ", ".join(b.text for b in blocks)
    return SQLTransformer(statement=f"SELECT *, {function}({texts}) AS {name} FROM __THIS__")
