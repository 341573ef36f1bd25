"""Near-duplicate documents by consistent weighted sampling of TF-IDF word shingles.

Every distinct text is a set of five-word shingles with weights (1 + ln tf) * idf.  Improved consistent
weighted sampling draws ``BANDS * ROWS`` samples of each set, such that two sets agree on a sample with their
weighted Jaccard similarity as probability.  Texts that agree on all rows of a band become candidates, and
candidates are verified by the exact weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtriage.llm import blocks, shingles
from mailtriage.llm.common import column_of, documents, text_groups, texts_of
from mailtriage.llm.graph import components
from mailtriage.session import staged_table

BANDS, ROWS = 12, 4
BUCKETS = 1 << 18  # of the document frequencies, as in a hashing term-frequency vectoriser
TABLE = 1 << 14
BLOCK = 8192
SIMILARITY = 0.8
IDF_RANGE = 0.25
LEAST_AGREEING = BANDS * ROWS // 2  # samples; at similarity 0.8 fewer agree once in a million pairs
BUCKET = ["key", "band"]
BUCKET_BLOCK = 256
CHUNK_PAIRS, VERIFIED_PAIRS = 1 << 15, 2048


def node_key(text: str | Column) -> Column:
    """Identity of a text: 16 bytes, equal for equal texts only."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def sampling_table(seed: int = 3) -> np.ndarray:
    """[TABLE, 4, samples] draws of the scheme: 1/r, beta, ln c - r (1 - beta), r.  A shingle takes a row by hash."""
    rng, n = np.random.default_rng(seed), BANDS * ROWS
    r, c, beta = rng.gamma(2, 1, (TABLE, n)), rng.gamma(2, 1, (TABLE, n)), rng.random((TABLE, n))
    return np.stack([1 / r, beta, np.log(c) - r * (1 - beta), r], axis=1).astype(np.float32)


def sampled(table: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Hashes of the samples of one weighted set: the shingle with the smallest draw and its weight level."""
    n = BANDS * ROWS
    low, best_key, best_level = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for start in range(0, len(keys), BLOCK):
        part = keys[start : start + BLOCK]
        drawn = table[(part >> np.uint64(40)).astype(np.int64) & (TABLE - 1)]
        level = np.log(weights[start : start + BLOCK])[:, None] * drawn[:, 0]
        level += drawn[:, 1]
        np.floor(level, out=level)
        score = drawn[:, 2] - drawn[:, 3] * level
        at = score.argmin(axis=0)
        found = score[at, np.arange(n)]
        better = found < low
        low[better], best_key[better] = found[better], part[at[better]]
        best_level[better] = level[at, np.arange(n)][better].astype(np.int64)
    return shingles.mixed(best_key ^ shingles.mixed(best_level.astype(np.uint64)))


def band_entries(prints: DataFrame) -> DataFrame:
    """(node, weight, band, key): the samples of each band as one key."""
    size = 4 * ROWS
    keys = F.posexplode(F.expr(f"transform(sequence(0, {BANDS - 1}), b -> substring(samples, {size} * b + 1, {size}))"))
    return prints.where(F.length("samples") > 0).select("node", "weight", keys.alias("band", "key"))


def shingle_weights(keys: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return ((1 + np.log(times)) * idf[(keys & np.uint64(len(idf) - 1)).astype(np.int64)]).astype(np.float32)


def inverse_frequencies(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """idf of each hash bucket over all documents: 1 + IDF_RANGE * ln((n+1)/(df+1)) / ln(n+1).

    The range is narrow because copies raise the frequency of their own shingles: with the plain logarithm, a
    large group of near copies would look less alike than a small one.

    Document frequencies are counted per bucket of shingle hashes, so the table has a fixed size; tasks count
    in an array and emit one row per bucket.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(buckets, np.int64), 0
        for batch in text_groups(batches, shingles.GROUP_BYTES):
            keys, _, _ = shingles.of_texts(texts_of(batch))
            counts += np.bincount((keys & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
            total += batch.num_rows
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(counts[found], total))], ["bucket", "n"])

    parts = docs.select("text").mapInArrow(run, "bucket long, n long")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most `buckets` + 1 rows
    at, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    frequency = np.zeros(buckets)
    frequency[at[at >= 0]] = n[at >= 0]
    rows = float(n[at < 0].sum())
    return (1 + IDF_RANGE * np.log((rows + 1) / (np.minimum(frequency, rows) + 1)) / np.log(max(rows + 1, 2))).astype(np.float32)


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(rid, doc_id, node, weight, samples) of each row: 32 bits of each sample, none for a text without words."""
    held = docs.sparkSession.sparkContext.broadcast(idf)  # one float per bucket

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sampling_table()
        for batch in text_groups(batches, shingles.GROUP_BYTES):
            keys, times, offsets = shingles.of_texts(texts_of(batch))
            weights = shingle_weights(keys, times, held.value)
            samples, sums = [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                samples.append(sampled(table, keys[a:b], weights[a:b]).astype(np.uint32).tobytes() if b > a else b"")
                sums.append(float(weights[a:b].sum(dtype=np.float64)))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), column_of(batch, "node"), pa.array(sums, pa.float64()),
                                              pa.array(samples, pa.binary())], ["doc_id", "node", "weight", "samples"])

    rows = docs.select("doc_id", node_key("text").alias("node"), "text")
    found = rows.mapInArrow(run, "doc_id long, node binary, weight double, samples binary")
    return found.withColumn("rid", F.monotonically_increasing_id())


def pair_similarities(keys: np.ndarray, weights: np.ndarray, offsets: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of pairs (i, j) of sets: sum of minima over sum of maxima."""
    rows = np.concatenate([i, j])
    sizes = np.diff(offsets)[rows]
    flat = np.arange(sizes.sum()) + np.repeat(offsets[:-1][rows] - (np.cumsum(sizes) - sizes), sizes)
    pair = np.repeat(np.tile(np.arange(len(i)), 2), sizes)
    key, weight = keys[flat], weights[flat].astype(float)
    order = np.lexsort((key, pair))
    key, pair, weight = key[order], pair[order], weight[order]
    same = np.flatnonzero((key[1:] == key[:-1]) & (pair[1:] == pair[:-1]))
    both = np.bincount(pair[same], np.minimum(weight[same], weight[same + 1]), minlength=len(i))
    total = np.bincount(pair, weight, minlength=len(i))
    return both / np.maximum(total - both, 1e-12)


def similarities(left: list[str], right: list[str], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    keys, times, offsets = shingles.of_texts(left + right)
    at = np.arange(len(left))
    return pair_similarities(keys, shingle_weights(keys, times, idf), offsets, at, at + len(left))


def texts_by_node(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes, each once."""
    wanted = wanted.distinct().join(nodes.select("node", "doc_id"), "node")
    rows = docs.select("doc_id", node_key("text").alias("node"), "text")
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["node"] == wanted["node"])).select(rows["node"], "text")
    return staged_table(found.dropDuplicates(["node"]), "texts")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Of the pairs (a, b) of nodes those with ``threshold`` similarity or more, as a table of their own.

    Only texts of candidates are shuffled, one row for each distinct text; the leader's text is joined last.
    """
    held = docs.sparkSession.sparkContext.broadcast(idf)
    texts = texts_by_node(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs)
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b").select("a", "b", "text", "other"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, shingles.GROUP_BYTES):
            found = similarities(texts_of(batch), column_of(batch, "other").to_pylist(), held.value)
            keep = pa.array(found >= threshold - 1e-9)
            yield pa.RecordBatch.from_arrays([column_of(batch, "a"), column_of(batch, "b"), pa.array(found)],
                                             ["a", "b", "similarity"]).filter(keep)

    return staged_table(both.mapInArrow(run, "a binary, b binary, similarity double").select("a", "b"), "links")


def _close(w: str, v: str, threshold: float) -> Column:
    """The smaller weight sum over the larger bounds the similarity from above."""
    return F.least(w, v) >= (threshold - 1e-6) * F.greatest(w, v)


def crossing(bands: DataFrame, joined: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """(a, b): links between components that share a band bucket.

    Buckets with more than one component are compared in blocks inside tasks, so that a large family of texts
    just below the threshold gives no table of pairs.  A pair is looked at in the first band it shares; if half
    of its samples agree, and no link found before joins it, its similarity is measured.
    """
    placed = staged_table(bands.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    keys = placed.groupBy(*BUCKET).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select(*BUCKET)
    mixed = staged_table(placed.join(keys, BUCKET, "left_semi"), "mixed")
    texts = texts_by_node(mixed.select("node"), nodes, docs).join(nodes.select("node", "samples"), "node")
    rows = blocks.sorted_units(blocks.units(mixed, BUCKET, "node", BUCKET_BLOCK).join(texts, "node"), BUCKET, "node")
    held = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from blocks.tables(batches, BUCKET, lambda table, starts: _crossing(table, starts, held.value, threshold))

    columns = rows.select("key", "band", "x", "y", "second", "node", "component", "weight", "samples", "text")
    return staged_table(columns.mapInArrow(run, "a binary, b binary"), "links")


def _crossing(table: pa.Table, starts: np.ndarray, idf: np.ndarray, threshold: float) -> pa.RecordBatch:
    n = table.num_rows
    keys, times, offsets = shingles.of_texts(table["text"].to_pylist())
    weights = shingle_weights(keys, times, idf)
    samples = np.frombuffer(b"".join(table["samples"].to_pylist()), np.uint32).reshape(n, BANDS * ROWS)
    band, weight = table["band"].to_numpy(), table["weight"].to_numpy()
    label = np.unique(np.array(table["component"].to_pylist(), object), return_index=True, return_inverse=True)
    label = label[1][label[2]]  # the first row of the same component
    hits_i, hits_j = [np.zeros(0, int)], [np.zeros(0, int)]
    for i, j in blocks.pairs(table, starts, CHUNK_PAIRS):
        near = np.minimum(weight[i], weight[j]) >= (threshold - 1e-6) * np.maximum(weight[i], weight[j])
        near &= label[i] != label[j]
        i, j = i[near], j[near]
        agree = samples[i] == samples[j]
        near = agree.sum(axis=1) >= LEAST_AGREEING
        near &= agree.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i]
        i, j = i[near], j[near]
        for at in range(0, len(i), VERIFIED_PAIRS):
            a, b = i[at : at + VERIFIED_PAIRS], j[at : at + VERIFIED_PAIRS]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            if len(a):
                hit = pair_similarities(keys, weights, offsets, a, b) >= threshold - 1e-9
                hits_i.append(a[hit])
                hits_j.append(b[hit])
                label = blocks.settled(label, a[hit], b[hit])
    node = table["node"].combine_chunks()
    return pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(h))) for h in (hits_i, hits_j)], ["a", "b"])


def classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, class_id, class_size, kept) of every input row.

    Equal texts are one node.  In each band bucket every text is first compared with the bucket's smallest
    node, which settles most groups; then buckets that still hold several components compare all texts of
    different components.  So every candidate pair is measured or lies inside one component.
    """
    prints = staged_table(signatures(docs, idf := inverse_frequencies(docs)), "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id"), F.col("rid"))
    nodes = prints.groupBy("node").agg(F.min(rank).alias("rank"), F.count("*").alias("size"), F.first("weight").alias("weight"), F.first("samples").alias("samples"))
    nodes = staged_table(nodes.withColumn("doc_id", F.col("rank.doc_id")), "nodes")
    bands = band_entries(nodes)
    leaders = (bands.groupBy(*BUCKET).agg(F.min(F.struct("node", "weight")).alias("lead"), F.count("*").alias("n")).where("n > 1")
               .select(*BUCKET, F.col("lead.node").alias("a"), F.col("lead.weight").alias("wa")))
    shared = staged_table(bands.join(leaders, BUCKET), "shared")
    close = F.least("weight", "wa") >= (threshold - 1e-6) * F.greatest("weight", "wa")
    stars = staged_table(shared.where((F.col("node") != F.col("a")) & close).select("a", F.col("node").alias("b")).distinct(), "stars")
    links = verified(stars, nodes, docs, idf, threshold)
    more = crossing(shared.select(*BUCKET, "node", "weight"), components(links), nodes, docs, idf, threshold)
    joined = components(links.unionByName(more))
    groups = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = groups.groupBy("component").agg(F.min("rank").alias("first"), F.sum("size").alias("class_size"))
    member = staged_table(groups.join(best, "component").select("node", "first", "class_size"), "members")
    rows = prints.select("rid", "doc_id", "node").join(member, "node")
    rows = rows.select("doc_id", "node", F.col("first.doc_id").alias("class_id"), "class_size",
                       (F.col("rid") == F.col("first.rid")).alias("kept"))
    return rows


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, kept: one row per input row.

    class_id is the smallest doc_id linked, directly or through others, by equal text or by a weighted
    Jaccard similarity of ``threshold`` or more; kept marks one row of each class, that with the smallest
    doc_id.  Null and empty texts are equal to one another; a text of one to four words is one shingle;
    texts without words equal their exact copies only.  Repeated rows share a class, a null id comes last in
    it, and an empty table gives no rows.
    """
    return classes(documents(docs, id_col, text_col), threshold).drop("node")


def drop_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class of ``docs`` (columns doc_id, text and any others), chosen by content: the row
    with the class's smallest doc_id; of repeated rows one."""
    rows = staged_table(classes(documents(docs), threshold), "classes")
    kept = rows.where("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    marked = docs.withColumn("_node_of_row", node_key("text"))
    found = marked.join(kept, marked["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (marked["_node_of_row"] == kept["_node"]), "left_semi")
    repeats = rows.groupBy("doc_id", "node").agg(F.count("*").alias("n")).where("n > 1")
    if not repeats.isEmpty():
        found = found.withColumn("_id_of_row", F.col("doc_id").cast("long")).dropDuplicates(["_id_of_row", "_node_of_row"]).drop("_id_of_row")
    return found.drop("_node_of_row")
