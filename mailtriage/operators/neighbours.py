"""Strings near one another in edits, without comparing every pair.

Gap keys.  Leave up to two letters out of a string and note where the gaps are.  Two strings are within two edits
exactly if they agree in one of these ways, which also say how many edits are enough:

* the same rest, whatever the gaps, after k and m letters were left out, k + m <= 2 (k + m edits);
* the same rest and the same gap, one letter left out on either side (1 edit: another letter in the gap);
* the same rest and a common gap, one letter left out on one side and two on the other (2 edits);
* the same rest and the same two gaps (2 edits).

So nearest neighbours and groups come from minima by key: no pair is formed, and a key that a whole family of
strings shares is combined like any other sum.

Pieces.  Cut a string into d + 1 pieces; a string within d edits of it holds one of them unchanged, moved by no more
letters than the edits before or behind it allow.  Both sides are joined by length, piece number and piece, and only
the pairs that meet, and whose sets of letters agree well enough, are measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage.operators.graph import components
from mailtriage.operators.ordering import numbered
from mailtriage.session import staged_table

#: A distance and a rank in one number, so that a minimum finds the nearest first.
RANK_BITS = 48
NO_GAP = -1


def _without_one(word: Column, start: Column) -> Column:
    """(i, w): the word without its i-th letter, for every i from start to its end."""
    spots = F.when(F.length(word) >= start, F.sequence(start, F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.struct(i.alias("i"), F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)).alias("w")))


def gap_keys(word: Column) -> Column:
    """array<struct<rest, gap, next, left_out>>; a gap is the number of letters of the rest before it, ``NO_GAP`` where
    it does not count."""
    none = F.lit(NO_GAP)

    def key(rest: Column, gap: Column, following: Column, n: int) -> Column:
        return F.struct(rest.alias("rest"), gap.alias("gap"), following.alias("next"), F.lit(n).alias("left_out"))

    one = _without_one(word, F.lit(1))
    # the second letter is at or behind the gap of the first: every two places once
    two = F.flatten(F.transform(one, lambda s: F.transform(_without_one(s["w"], s["i"]), lambda t: F.struct(
        t["w"].alias("w"), (s["i"] - 1).alias("a"), (t["i"] - 1).alias("b")))))
    # repeats, as letters do, are harmless to minima
    return F.concat(
        F.array(key(word, none, none, 0)),
        F.transform(one, lambda s: key(s["w"], none, none, 1)), F.transform(one, lambda s: key(s["w"], s["i"] - 1, none, 1)),
        F.transform(two, lambda t: key(t["w"], none, none, 2)), F.transform(two, lambda t: key(t["w"], t["a"], none, 2)),
        F.transform(two, lambda t: key(t["w"], t["b"], none, 2)), F.transform(two, lambda t: key(t["w"], t["a"], t["b"], 2)))


def _key_rows(words: DataFrame, word: str, *keep: str) -> DataFrame:
    return words.select(*keep, F.inline(gap_keys(F.col(word))))


def _least_by_key(rows: DataFrame, rank: str) -> DataFrame:
    """Per key the smallest rank among the strings with 0, 1 and 2 letters left out."""
    least = [F.min(F.when(F.col("left_out") == n, F.col(rank))).alias(f"least_{n}") for n in range(3)]
    return rows.groupBy("rest", "gap", "next").agg(*least)


_OPEN, _ONE = "gap = -1", "gap >= 0 and next = -1"


def nearest_within_two(left: DataFrame, right: DataFrame) -> DataFrame:
    """left, distance, rank: the string of ``right(right, rank)`` with the fewest edits, two at most; equal distances go
    to the smallest rank.  Strings without one are left out.  ``left(left)`` and ``right`` hold distinct strings."""
    # longer strings have no neighbour; their keys would grow with the square of the length
    longest = right.agg(F.coalesce(F.max(F.length("right")), F.lit(0)) + 2).scalar()
    known = _least_by_key(_key_rows(right, "right", "rank"), "rank")
    met = _key_rows(left.where(F.length("left") <= longest), "left", "left").join(known, ["rest", "gap", "next"])
    edits = [
        F.expr(f"if({_OPEN}, left_out, null)"),
        F.expr(f"case when {_OPEN} and left_out <= 1 then left_out + 1 when {_ONE} then left_out end"),
        F.expr(f"case when {_OPEN} and left_out = 0 then 2 when {_ONE} and left_out = 1 then 2 when next >= 0 then 2 end"),
    ]
    best = F.least(*[F.shiftleft(e.cast("long"), RANK_BITS) + F.col(f"least_{n}") for n, e in enumerate(edits)])
    return _unpacked(met.groupBy("left").agg(F.min(best).alias("best")).where("best is not null"))


def _unpacked(best: DataFrame) -> DataFrame:
    return best.select("left", F.shiftright("best", RANK_BITS).cast("int").alias("distance"),
                       F.col("best").bitwiseAND((1 << RANK_BITS) - 1).alias("rank"))


def groups_within_two(words: DataFrame, word: str) -> DataFrame:
    """word, representative: strings that chains of at most two edits a step connect, under the first of them by name.

    Every distinct string has one row; null strings are dropped.  Each string is tied to the smallest of each of its
    keys only, so ties grow with the strings, not with the pairs.
    """
    distinct = words.select(F.col(word).alias("word")).where("word is not null").distinct()
    ranked = numbered(distinct, [F.col("word").asc()])
    rows = _key_rows(ranked, "word", "rank")
    met = rows.join(_least_by_key(rows, "rank"), ["rest", "gap", "next"])
    tied = F.expr(f"""case when {_OPEN} and left_out = 1 then coalesce(least_0, least_1) when {_OPEN} and left_out = 2 then least_0
                      when {_ONE} then least_1 when next >= 0 then least_2 end""")
    edges = met.select(F.col("rank").alias("a"), tied.alias("b")).where("b is not null")
    found = components(edges)
    grouped = ranked.join(found.withColumnRenamed("node", "rank"), "rank", "left").withColumn("first", F.coalesce("component", "rank"))
    names = ranked.select(F.col("rank").alias("first"), F.col("word").alias("representative"))
    return grouped.join(names, "first").select(F.col("word").alias(word), "representative")


# pieces

def letter_set(word: str) -> Column:
    """64 bits, one for each class of letters the word holds."""
    return F.expr(f"aggregate(filter(split({word}, ''), c -> c <> ''), 0L, (held, c) -> held | shiftleft(1L, ascii(c) % 64))")


def letters_apart(x: str, y: str) -> Column:
    """Edits that two sets of letters ask for at least."""
    return F.expr(f"greatest(bit_count({x} & ~{y}), bit_count({y} & ~{x}))")


def _tail(word: str) -> str:
    """Length of a name's last label with its dot, which very many names share: it never is a piece by itself."""
    return f"if(instr({word}, '.') > 0, length(substring_index({word}, '.', -1)) + 1, 0)"


def _bounds(i: str, n: str, tail: str, d: int) -> tuple[str, str]:
    """First letter (from 0) and length of piece i of a name of n letters."""
    first = f"cast(({i} * ({n} - {tail})) div {d + 1} as int)"
    return first, f"(if({i} = {d}, {n}, cast((({i} + 1) * ({n} - {tail})) div {d + 1} as int)) - {first})"


def piece_candidates(left: DataFrame, right: DataFrame, d: int) -> DataFrame:
    """left, right, rank of the pairs that share a piece for ``d`` edits and whose letters allow so few; pairs may repeat.

    ``left(left, letters)``, ``right(right, rank, letters)``.  A collision of piece hashes only adds a candidate.
    """
    first, size = _bounds("i", "n", "tail", d)
    cut = right.selectExpr("right", "rank", "letters", "length(right) as n", f"{_tail('right')} as tail", f"explode(sequence(0, {d})) as i")
    pieces = cut.selectExpr("right", "rank", "letters as right_letters", f"xxhash64(n, tail, i, substring(right, {first} + 1, {size})) as key")
    shapes = right.selectExpr("length(right) as n", f"{_tail('right')} as tail").distinct()
    # one row a length and last label: at most the square of the longest name
    every = shapes.agg(F.collect_list(F.struct("n", "tail"))).scalar()
    first, size = _bounds("i", "s.n", "s.tail", d)
    low = f"greatest(0, {first} - i, {first} + length(left) - s.n - ({d} - i))"
    high = f"least(length(left) - {size}, {first} + i, {first} + length(left) - s.n + ({d} - i))"
    keys = f"""flatten(transform(filter(shapes, s -> abs(s.n - length(left)) <= {d}), s -> flatten(transform(sequence(0, {d}), i ->
        transform(if({low} <= {high}, sequence({low}, {high}), array()), p -> xxhash64(s.n, s.tail, i, substring(left, p + 1, {size})))))))"""
    asked = left.withColumn("shapes", every).select("left", "letters", F.explode(F.expr(f"array_distinct({keys})")).alias("key"))
    return asked.join(pieces, "key").where(letters_apart("letters", "right_letters") <= d).select("left", "right", "rank")


def nearest_by_pieces(left: DataFrame, right: DataFrame, d: int) -> DataFrame:
    """left, distance, rank as :func:`nearest_within_two`, up to ``d`` edits."""
    gap = F.call_function("levenshtein", F.col("left"), F.col("right"), F.lit(d))
    measured = piece_candidates(left, right, d).select("left", gap.alias("distance"), "rank").where("distance >= 0")
    packed = F.shiftleft(F.col("distance").cast("long"), RANK_BITS) + F.col("rank")
    return _unpacked(measured.groupBy("left").agg(F.min(packed).alias("best")))


def with_letters(words: DataFrame, word: str) -> DataFrame:
    return staged_table(words.withColumn("letters", letter_set(word)), "letters")
