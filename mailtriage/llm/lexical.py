"""Ranked lexical search by NRA: impact-sorted lists are read from the top, never at random.

Every term has a list of postings with their impacts, cut into bands by the binary logarithm of the impact.  A round
reads the next bands of all lists.  A document's lower bound for a query is the sum of the impacts read; its upper
bound adds, for each term it has not been met with, the largest impact that list still holds.  A query is open
while a document not met at all could still reach the k-th best lower bound; after that only its candidates, the
documents whose upper bound reaches it, are looked for in what is read.  Reading goes on until no interval of a candidate
is open, so membership, ties and scores are all exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mailtriage.llm import bits
from mailtriage.llm.bits import BitTable
from mailtriage.llm.common import column_of, documents, text_groups
from mailtriage.operators.lookup import is_small
from mailtriage.session import staged_table, staging_dir

#: What separates terms; the other ASCII characters are the digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
FIRST_READ = 64  # postings a wanted place in the first round
GROWTH = 4  # each round reads so many times what had been read

SMALL_BYTES = 16 << 20
MASK_BITS = 62

WANTED = "item long, item_id long, term string, ord int, times long"
POSTING = "row long, doc_id long, term string, tf long, n long"


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, term number of every occurrence, text of every occurrence)."""
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), BETWEEN, " "))
    flat = lists.flatten().dictionary_encode()
    code = flat.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    real = pc.not_equal(flat.dictionary, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    return flat.dictionary, code[real], text[real]


def _counted(terms: int, code: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term number, occurrences) of every term of every text."""
    pair, count = np.unique(text * max(terms, 1) + code, return_counts=True)
    return pair // max(terms, 1), pair % max(terms, 1), count


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, term, ord, times): the distinct terms of every query, numbered within it; ``item`` is its row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            spelt, code, text = _terms(column_of(batch, "text"))
            text, code, count = _counted(len(spelt), code, text)
            begins = np.flatnonzero(np.diff(text, prepend=-1))
            order = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "item").take(pa.array(text)), column_of(batch, "doc_id").take(pa.array(text)), spelt.take(pa.array(code)),
                 pa.array(order.astype(np.int32)), pa.array(count.astype(np.int64))], ["item", "item_id", "term", "ord", "times"])

    rows = documents(items, id_col, text_col).withColumn("item", F.monotonically_increasing_id())
    return staged_table(rows.mapInArrow(run, WANTED), "query-terms")


def postings(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, term, tf, n) of the wanted terms in all documents, and a row without a term for every document that
    has any; n counts a document's terms.  A bit table keeps most other terms out of the shuffle."""

    table = BitTable.empty()
    width = table.width

    def term_places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bits.places(bits.hashes(column_of(batch, "term").to_pylist()), width))], ["place"])

    table = table.grown(wanted.select("term").mapInArrow(term_places, "place long"))
    held = docs.sparkSession.sparkContext.broadcast(table.bits)  # fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = BitTable(held.value)
        for batch in text_groups(batches):
            spelt, code, text = _terms(column_of(batch, "text"))
            n = np.bincount(text, minlength=batch.num_rows)
            keep = asked.holds(bits.hashes(spelt.to_pylist()))[code]
            at, term, tf = _counted(len(spelt), code[keep], text[keep])
            some = np.flatnonzero(n)
            rows = pa.array(np.concatenate([at, some]))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "row").take(rows), column_of(batch, "doc_id").take(rows),
                 pa.concat_arrays([spelt.take(pa.array(term)), pa.nulls(len(some), pa.string())]),
                 pa.array(np.concatenate([tf, np.zeros(len(some), np.int64)])), pa.array(n[rows.to_numpy()])],
                ["row", "doc_id", "term", "tf", "n"])

    rows = documents(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return staged_table(rows.mapInArrow(run, POSTING), "postings")


def impact_lists(found: DataFrame, wanted: DataFrame, small: bool) -> tuple[DataFrame | None, DataFrame | None]:
    """(lists, directory): (band, term, row, doc_id, impact) of every posting with a positive impact, stored by band, and
    (term, band, count, highest, queries) of the lists.  None without documents."""
    spark = found.sparkSession
    total, length = found.where("term is null").agg(F.count("*"), F.sum("n")).first()
    if not total:
        return None, None
    asked = wanted.groupBy("term").agg(F.count("*").alias("queries"))
    own = found.where("term is not null")
    terms = own.groupBy("term").agg(F.count("*").alias("df")).join(_sized(asked, small), "term")
    weight = F.floor(F.lit(1000) * F.log(F.lit(2 * total + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    terms = staged_table(terms.select("term", weight.alias("weight"), "queries"), "weighted-terms")
    mass = F.expr(f"75 + (25 * n * {total}L) div {length}L")
    lists = own.withColumn("mass", mass).join(_sized(terms.select("term", "weight"), small), "term").select(
        "term", "row", "doc_id", F.expr("weight * ((1000000000L * tf) div (1000 * tf + 12 * mass))").alias("impact")).where("impact > 0")
    lists = lists.withColumn("band", F.floor(F.log2("impact")).cast("int"))
    path = f"{staging_dir(spark).rstrip('/')}/impact-lists-{uuid.uuid4().hex}"
    lists.hint("rebalance", "band").write.partitionBy("band").parquet(path)  # reading a band reads its folder
    lists = spark.read.schema(lists.schema).parquet(path)
    directory = lists.groupBy("term", "band").agg(F.count("*").alias("count"), F.max("impact").alias("highest"))
    return lists, staged_table(directory.join(_sized(terms.select("term", "queries"), small), "term"), "list-directory")


def _sized(dim: DataFrame, small: bool) -> DataFrame:
    """A table with a few numbers for each term or query of the wanted ones, to be joined to: broadcast if those were
    measured to be few, else left to adaptive execution."""
    return F.broadcast(dim) if small else dim


def _rounds(directory: DataFrame, places: int) -> list[tuple[int, int]]:
    """Band ranges [low, high) from the top: each reads GROWTH times what was read before, by the directory's counts."""
    sizes = directory.groupBy("band").agg(F.sum(F.col("count") * F.col("queries")).alias("n")).orderBy(F.desc("band")).collect()  # at most 64 rows
    rounds, high, read, enough = [], 64, 0, FIRST_READ * places
    for r in sizes:
        read += r["n"]
        if read >= enough or r is sizes[-1]:
            rounds.append((r["band"], high))
            high, enough = r["band"], (1 + GROWTH) * read
    return rounds


# whether a document has been met with term ``o`` of the query
_MET = f"(shiftright(get(masks, cast(o div {MASK_BITS} as int)), cast(o % {MASK_BITS} as int)) & 1) = 1"


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every query with a positive score, equal scores by ascending
    doc_id.

    Terms are runs of ASCII digits and letters and of all other characters, with A-Z lower-cased.  A null or empty
    text has no terms; a query without terms, or whose terms no document holds, gives no rows.  Rows with the same
    id are documents, or queries, of their own; a null id stays null and comes first among ties.  Empty tables give no
    rows.

    A document pruned from an open query may be met again with the rest of its impacts only; that is still a lower
    bound, and its full score was below the k-th, so it cannot return.
    """
    spark = docs.sparkSession
    wanted = query_terms(items, item_id, item_text)
    small = is_small(wanted, SMALL_BYTES)
    lists, directory = impact_lists(postings(docs, wanted, id_col, text_col), wanted, small)
    places, last = wanted.agg(F.count("*"), F.max("ord")).first()
    rounds = _rounds(directory, places) if lists is not None else []
    if not rounds:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    masks = [f"m{i}" for i in range(last // MASK_BITS + 1)]
    bit = F.expr(f"shiftleft(1L, cast(ord % {MASK_BITS} as int))")
    own = [F.when(F.expr(f"ord div {MASK_BITS} = {i}"), bit).otherwise(F.lit(0).cast("long")).alias(m) for i, m in enumerate(masks)]
    impact = (F.col("impact") * F.col("times")).alias("lower")

    state, status, done = None, None, None
    for low, high in rounds:
        part = lists.where(f"band >= {low} and band < {high}")
        # what the lists still hold below this round, for every term of every query
        below = directory.where(f"band < {low}").groupBy("term").agg(F.max("highest").alias("highest"))
        edges = wanted.join(below, "term", "left").withColumn("edge", F.coalesce(F.col("highest") * F.col("times"), F.lit(0)))
        edges = staged_table(edges.drop("highest"), "edges")
        frontier = staged_table(edges.groupBy("item").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "edge"))), lambda e: e["edge"]).alias("frontier"), F.sum("edge").alias("rest")), "frontier")
        asking = edges if status is None else edges.join(_sized(status.where("open").select("item"), small), "item", "left_semi")
        read = part.join(_sized(asking, small), "term").select("item", "row", "doc_id", impact, F.col("edge").alias("passed"), *own)
        if state is not None:
            waiting = state.join(_sized(frontier, small), "item").withColumn("masks", F.array(*masks))
            passed = F.expr(f"aggregate(sequence(0, size(frontier) - 1), 0L, (s, o) -> s + if({_MET}, frontier[o], 0L))")
            kept = waiting.select("item", "row", "doc_id", "lower", passed.alias("passed"), *masks)
            missing = F.explode(F.expr(f"filter(sequence(0, size(frontier) - 1), o -> not ({_MET}))")).alias("ord")
            needs = waiting.where("not open").select("item", "row", missing).join(_sized(edges, small), ["item", "ord"])
            more = part.join(needs, ["term", "row"]).select("item", "row", "doc_id", impact, F.col("edge").alias("passed"), *own)
            read = read.unionByName(kept).unionByName(more)
        met = staged_table(read.groupBy("item", "row").agg(
            F.max("doc_id").alias("doc_id"), F.sum("lower").alias("lower"), F.sum("passed").alias("passed"), *(F.bit_or(m).alias(m) for m in masks)), "met")
        leaders = met.select("item", "lower", F.row_number().over(W.partitionBy("item").orderBy(F.desc("lower"))).alias("place"))
        kth = leaders.where(f"place <= {top}").groupBy("item").agg(F.expr(f"if(count(*) = {top}, min(lower), 0L)").alias("kth"))
        status = frontier.select("item", "rest") if status is None else frontier.select("item", "rest").join(_sized(status.select("item"), small), "item", "left_semi")
        status = status.join(kth, "item", "left").select("item", "rest", F.coalesce("kth", F.lit(0)).alias("kth"))
        status = staged_table(status.withColumn("open", F.expr("rest >= greatest(kth, 1L)")), "status")
        bounded = met.join(_sized(status, small), "item").withColumn("upper", F.col("lower") + F.col("rest") - F.col("passed"))
        bounded = staged_table(bounded.where("upper >= kth").select("item", "row", "doc_id", "lower", *masks, "upper", "open"), "bounded")
        settled = bounded.groupBy("item").agg(F.bool_or(F.expr("open or upper > lower")).alias("unsettled")).where("not unsettled").select("item")
        settled = staged_table(settled, "settled")
        exact = bounded.join(_sized(settled, small), "item", "left_semi").select("item", "row", "doc_id", "lower")
        done = exact if done is None else done.unionByName(exact)
        state = bounded.drop("upper").join(_sized(settled, small), "item", "left_anti")
        status = status.join(_sized(settled, small), "item", "left_anti")
        if status.where("open").isEmpty() and state.isEmpty():
            break
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("lower"), "doc_id", "row"))
    best = done.withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(_sized(wanted.select("item", "item_id").distinct(), small), "item").select("item_id", "rank", "doc_id", F.col("lower").alias("score"))
