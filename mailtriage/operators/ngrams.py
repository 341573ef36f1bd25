"""N-grams counted as integers inside the task, and exact vocabularies from bounded summaries.

A batch of texts becomes arrays of numbers: words by their place in a dictionary, characters by their code points.
N-grams are windows over these arrays packed into one integer each; sorting counts them, and only the distinct ones
are spelt.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X
from mailtriage.session import staged_table

SIZES = (3, 4, 5)
GROUP_BYTES = 2 << 20
HELD = 1 << 20  # distinct n-grams a task adds up before it hands them on
CHAR_BITS = 12
WORD_BITS = 31
DENSE = 16  # a table of all rows by all n-grams is marked if it has at most so many places a hit
BLANK = 32
STATS = "block string, term string, tf long, df long"
SUMMARY = "block string, term string, tf long, df long, dropped long"
FIRST_SUMMARY = 16  # a summary holds so many times the terms that are wanted
MOST_CANDIDATES = 16


def word_text(text: Column, stops: Iterable[str]) -> Column:
    """Lower-cased words of two or more characters without stop words, joined by blanks."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    return F.array_join(F.filter(words, lambda w: ~w.isin(list(stops))), " ")


def char_text(text: Column) -> Column:
    """Lower case with single blanks: what character n-grams are cut from."""
    return X.normalise(text)


def _cuts(sizes: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """(first row, rows) of groups of about GROUP_BYTES, or ``most``, one row at least."""
    group = (np.cumsum(sizes) - sizes) // (most or GROUP_BYTES) if len(sizes) else sizes
    cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for start, end in zip(cuts, [*cuts[1:], len(sizes)]):
        yield start, end - start


def _bytes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def cuts(columns: Iterable[pa.Array], most: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of groups of about so many bytes of text columns taken together."""
    return _cuts(sum(_bytes(c) for c in columns), most)


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about GROUP_BYTES of text: all columns are texts."""
    for batch in batches:
        for cut in _cuts(sum(_bytes(c) for c in batch.columns)):
            yield batch.slice(*cut)


def column_groups(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of about GROUP_BYTES of one text column."""
    for batch in batches:
        for cut in _cuts(_bytes(batch.column(batch.schema.get_field_index(text)))):
            yield batch.slice(*cut)


def text_groups(texts: pa.Array) -> Iterator[pa.Array]:
    """An array of texts in pieces of about GROUP_BYTES."""
    for cut in _cuts(_bytes(texts)):
        yield texts.slice(*cut)


def word_grams(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(dictionary, row and number of every word, places where a pair of one row begins, numbers of the second words)."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    flat = lists.flatten().dictionary_encode()
    code = flat.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    real = pc.not_equal(flat.dictionary, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    code, row = code[real], row[real]
    pair = np.flatnonzero(row[:-1] == row[1:])
    return flat.dictionary, row, code, pair, code[pair + 1]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts with a blank before and behind each, row of every code point)."""
    texts = pc.fill_null(texts, "")
    joined = "".join(f" {t} " for t in texts.to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy() + 2)


def windows(points: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Starts of the n-grams inside padded words: blanks at the ends only, all of one row."""
    if len(points) < n:
        return np.zeros(0, np.int64)
    inner = np.concatenate([[0], np.cumsum(points == BLANK)])
    at = np.arange(len(points) - n + 1)
    return at[(inner[at + n - 1] == inner[at + 1]) & (row[at] == row[at + n - 1])]


def packed(code: np.ndarray, at: np.ndarray, n: int, base: int) -> np.ndarray:
    """Windows of n numbers below ``base`` as one integer each."""
    key = code[at].astype(np.int64)
    for j in range(1, n):
        key = key * base + code[at + j]
    return key


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct integers, by sorting: a hash table is slow on packed windows."""
    numbers = np.sort(numbers)
    return numbers[np.concatenate([[True], numbers[1:] != numbers[:-1]])] if len(numbers) else numbers


def repeated(owner: np.ndarray, owners: int, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of all entries of each owner asked for, one after the other, how many each has) in sorted ``owner``."""
    first = np.searchsorted(owner, np.arange(owners + 1))
    sizes = np.diff(first)[asked]
    ends = np.cumsum(sizes)
    return np.repeat(first[asked] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0), sizes


def _counted(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, occurrences, rows that hold them)."""
    found = distinct(key)
    code = np.searchsorted(found, key)
    held = distinct(row * max(len(found), 1) + code) % max(len(found), 1)
    return found, np.bincount(code, minlength=len(found)), np.bincount(held, minlength=len(found))


class _Sums:
    """Counts of integer keys, added up over batches."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, tf: np.ndarray, df: np.ndarray) -> None:
        self.parts.append(np.stack([keys, tf, df]))
        self.size += len(keys)

    def total(self) -> np.ndarray:
        """keys, tf, df as the rows of one array."""
        if not self.parts:
            return np.zeros((3, 0), np.int64)
        keys, tf, df = np.concatenate(self.parts, axis=1)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.zeros(0, np.int64)
        summed = np.stack([keys[first], *(np.add.reduceat(x[order], first) if len(first) else x for x in (tf, df))])
        self.parts, self.size = [summed], summed.shape[1]
        return summed


def _spelt(keys: np.ndarray, n: int, alphabet: np.ndarray | None = None, base: int = 1 << CHAR_BITS) -> list[str]:
    digits = np.empty((len(keys), n), np.int64)
    for j in reversed(range(n)):
        keys, digits[:, j] = np.divmod(keys, base)
    points = digits if alphabet is None else alphabet[digits]
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i : i + n] for i in range(0, len(text), n)]


@dataclass
class _Words:
    """The words of a group of texts: each distinct one once, how often it occurs, and the rows that hold it."""

    spelt: pa.Array
    tf: np.ndarray
    pair_row: np.ndarray  # distinct (row, word) pairs
    pair_word: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> _Words:
        spelt, row, code, _, _ = word_grams(texts)
        size = max(len(spelt), 1)
        held = distinct(row * size + code)
        return _Words(spelt, np.bincount(code, minlength=len(spelt)), held // size, held % size)

    def counted(self, key: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct keys, occurrences, rows that hold them) of n-grams that were cut from the distinct words."""
        found, code = np.unique(key, return_inverse=True)
        grams = max(len(found), 1)
        tf = np.bincount(code, self.tf[word], len(found)).astype(np.int64)
        inside = distinct(word * grams + code)  # each n-gram of a word once
        places, sizes = repeated(inside // grams, len(self.spelt), self.pair_word)
        gram, row, total = (inside % grams)[places], np.repeat(self.pair_row, sizes), len(places)
        rows = int(row[-1]) + 1 if total else 0
        if rows * grams <= DENSE * total:
            seen = np.zeros(rows * grams, bool)
            seen[row * grams + gram] = True
            held = np.flatnonzero(seen) % grams
        else:
            held = distinct(row * grams + gram) % grams
        return found, tf, np.bincount(held, minlength=len(found))


def _char_counts(texts: pa.Array, sums: dict[int, _Sums]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Add up the n-grams of a group; those of a group with far code points are given back, spelt with its alphabet.

    n-grams never cross words, so they are cut from the distinct words and weighed by their counts.
    """
    words = _Words.of(texts)
    points, word = code_points(words.spelt)
    far = len(points) and int(points.max()) >= 1 << CHAR_BITS
    alphabet, code = np.unique(points, return_inverse=True) if far else (None, points)
    for n in SIZES:
        at = windows(points, word, n)
        if not far:
            sums[n].add(*words.counted(packed(code, at, n, 1 << CHAR_BITS), word[at]))
        else:
            base = len(alphabet)
            # five numbers below 2^12 fit into an integer; larger alphabets are cut in two
            low = base if base < 1 << CHAR_BITS else None
            if low:
                keys, tf, df = words.counted(packed(code, at, n, base), word[at])
                yield _spelt(keys, n, alphabet, base), tf, df
            else:
                pairs, number = np.unique(packed(code, at, n - 2, base), return_inverse=True)
                ends = packed(code, at + n - 2, 2, base)
                tails, last = np.unique(ends, return_inverse=True)
                keys, tf, df = words.counted(number * len(tails) + last, word[at])
                heads = _spelt(pairs[keys // len(tails)], n - 2, alphabet, base)
                yield [a + b for a, b in zip(heads, _spelt(tails[keys % len(tails)], 2, alphabet, base))], tf, df


class _WordSums:
    """Counts of words and word pairs, added up over batches by the numbers of the words in one dictionary."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.sums = _Sums()

    def add(self, texts: pa.Array) -> None:
        spelt, row, code, pair, second = word_grams(texts)
        if not len(code):
            return
        numbers, size = self.numbers, len(spelt)
        # number 0 stands for no second word
        number = np.array([numbers.setdefault(w, len(numbers) + 1) for w in spelt.to_pylist()], np.int64)
        keys, tf, df = _counted(code, row)
        self.sums.add(number[keys] << WORD_BITS, tf, df)
        keys, tf, df = _counted(code[pair] * size + second, row[pair])
        self.sums.add(number[keys // size] << WORD_BITS | number[keys % size], tf, df)

    def pieces(self, least: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """All counts, if they are more than ``least`` even when added up."""
        if self.sums.size <= least:
            return
        keys, tf, df = self.sums.total()
        if self.sums.size <= least:
            return
        words = pa.array(["", *self.numbers], pa.string())
        ahead, behind = words.take(pa.array(keys >> WORD_BITS)), words.take(pa.array(keys & (1 << WORD_BITS) - 1))
        single = pa.array(keys & (1 << WORD_BITS) - 1 == 0)
        yield pc.if_else(single, ahead, pc.binary_join_element_wise(ahead, behind, " ")), tf, df
        self.numbers, self.sums = {}, _Sums()


def _task_counts(batches: Iterable[pa.RecordBatch], words: dict[str, str], chars: dict[str, str]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(block, terms, tf, df) in pieces, each term of a block about once a task: ``words`` and ``chars`` name the text
    column of every block."""
    sums = {block: {n: _Sums() for n in SIZES} for block in chars}
    word_sums = {block: _WordSums() for block in words}

    def char_pieces(block: str, least: int) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
        for n, held in sums[block].items():
            if held.size > least:
                keys, tf, df = held.total()
                if held.size > least:
                    yield block, pa.array(_spelt(keys, n), pa.string()), tf, df
                    sums[block][n] = _Sums()

    for batch in _groups(batches):
        for block, name in words.items():
            word_sums[block].add(batch.column(batch.schema.get_field_index(name)))
            yield from ((block, *piece) for piece in word_sums[block].pieces(HELD))
        for block, name in chars.items():
            for terms, tf, df in _char_counts(batch.column(batch.schema.get_field_index(name)), sums[block]):
                yield block, pa.array(terms, pa.string()), tf, df
            yield from char_pieces(block, HELD)
    for block in words:
        yield from ((block, *piece) for piece in word_sums[block].pieces(0))
    for block in chars:
        yield from char_pieces(block, 0)


def gram_stats(df: DataFrame, words: dict[str, str], chars: dict[str, str]) -> DataFrame:
    """block, term, tf (occurrences), df (rows) of every n-gram: words and word pairs of the blocks in ``words``,
    character n-grams of those in ``chars``.  Null and empty texts have none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, terms, tf, held in _task_counts(batches, words, chars):
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(terms)), terms, pa.array(tf), pa.array(held)], ["block", "term", "tf", "df"])

    parts = df.select(*dict.fromkeys([*words.values(), *chars.values()])).mapInArrow(run, STATS)
    return parts.groupBy("block", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


# --- vocabularies ------------------------------------------------------------------------------------

def _summaries(df: DataFrame, words: dict[str, str], chars: dict[str, str], sizes: dict[str, int]) -> DataFrame:
    """block, term, tf, df, dropped: of each piece of a task the ``sizes`` most frequent terms of a block, with the count of
    the most frequent term left out; a null term carries that count alone."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, terms, tf, held in _task_counts(batches, words, chars):
            order = np.argsort(-tf, kind="stable")
            kept, dropped = order[: sizes[block]], int(tf[order[sizes[block]]]) if len(order) > sizes[block] else 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * (len(kept) + 1)), pa.concat_arrays([terms.take(pa.array(kept)), pa.nulls(1, pa.string())]),
                 pa.array(np.append(tf[kept], 0)), pa.array(np.append(held[kept], 0)), pa.array(np.full(len(kept) + 1, dropped))],
                ["block", "term", "tf", "df", "dropped"])

    return df.select(*dict.fromkeys([*words.values(), *chars.values()])).mapInArrow(run, SUMMARY)


def vocabularies(df: DataFrame, words: dict[str, str], chars: dict[str, str], sizes: dict[str, int],
                 min_df: int = K.MIN_DOC_FREQ, first: int = FIRST_SUMMARY) -> DataFrame:
    """block, term, tf, df: of every block the ``sizes`` most frequent terms in ``min_df`` rows or more, ties by name.

    The result is that of counting everything.  Each task hands on a summary: its most frequent terms, and the largest
    count it left out.  Summed, these give every term a lower and an upper bound; terms whose upper bound reaches the
    lower bound of the last wanted one are candidates, and a second pass counts just those, in blocks of which a summary left
    something out.  Where a term that no summary holds could still be wanted, or too many terms are candidates, summaries
    grow fourfold and the pass is repeated; at last they leave nothing out.
    """
    df = df.select(*dict.fromkeys([*words.values(), *chars.values()]))
    factor, largest = first, 1 << 30
    while True:
        limits = {b: min(n * factor, largest) for b, n in sizes.items()}
        parts = staged_table(_summaries(df, words, chars, limits), "summaries")
        left_out = parts.where("term is null").groupBy("block").agg(F.sum("dropped").alias("left_out"))  # one row a block
        seen = parts.where("term is not null").groupBy("block", "term").agg(
            F.sum("tf").alias("low"), F.sum("df").alias("df"), F.sum("dropped").alias("known")).join(F.broadcast(left_out), "block")
        seen = staged_table(seen, "bounds")
        size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("block")]
        last = _most_frequent(seen, "low", sizes, min_df).groupBy("block").agg(
            F.when(F.count("*") == F.first(size), F.min("low")).otherwise(0).alias("kth"))
        bounds = seen.join(F.broadcast(last), "block", "left").withColumn("kth", F.coalesce("kth", F.lit(0)))
        wanted = bounds.where(F.expr("low + left_out - known >= kth"))
        summary = wanted.groupBy("block").agg(F.count("*").alias("n"), F.first("left_out").alias("left_out"), F.first("kth").alias("kth")).collect()
        whole = {r["block"] for r in summary if r["left_out"] == 0}  # nothing was left out: the sums are the counts
        if any(r["block"] not in whole and not (r["left_out"] < r["kth"] and r["n"] <= MOST_CANDIDATES * sizes[r["block"]]) for r in summary):
            factor *= 4
            continue
        exact = seen.where(F.col("block").isin(*whole)).select("block", "term", F.col("low").alias("tf"), "df")
        open_blocks = {r["block"] for r in summary} - whole
        if open_blocks:
            again = [{b: t for b, t in texts.items() if b in open_blocks} for texts in (words, chars)]
            exact = exact.unionByName(staged_table(_recounted(df, *again, wanted.where(F.col("block").isin(*open_blocks)).select("block", "term")), "counts"))
        return _most_frequent(exact, "tf", sizes, min_df).select("block", "term", "tf", "df")


def _most_frequent(counts: DataFrame, by: str, sizes: dict[str, int], min_df: int) -> DataFrame:
    """Of every block the first ``sizes`` rows by count, ties by name: every task hands on so many at most."""
    tops = [counts.where((F.col("block") == block) & (F.col("df") >= min_df)).orderBy(F.desc(by), "term").limit(n) for block, n in sizes.items()]
    return functools.reduce(DataFrame.unionByName, tops)


def _recounted(df: DataFrame, words: dict[str, str], chars: dict[str, str], candidates: DataFrame) -> DataFrame:
    """Exact counts of the candidates, at most MOST_CANDIDATES times the wanted terms."""
    asked: dict[str, list[str]] = {}
    for r in candidates.collect():
        asked.setdefault(r["block"], []).append(r["term"])
    terms = df.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {b: pa.array(t, pa.string()) for b, t in terms.value.items()}
        for block, found, tf, held in _task_counts(batches, words, chars):
            keep = np.flatnonzero(pc.is_in(found, sets[block]).to_numpy(zero_copy_only=False)) if block in sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(keep), pa.string()), found.take(pa.array(keep)), pa.array(tf[keep]), pa.array(held[keep])],
                                             ["block", "term", "tf", "df"])

    texts = df.select(*dict.fromkeys([*words.values(), *chars.values()]))
    return texts.mapInArrow(run, STATS).groupBy("block", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
