"""Near-duplicate vectors through a pivot-permutation index.

Each vector is described by its ``NEAREST`` most similar reference points, in order.  Inverted lists are kept
for pairs of reference points: vectors in one list share two pivots at least.  Pairs from a list whose
descriptions share ``SHARED`` pivots or more are verified by exact cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtriage.llm import blocks
from mailtriage.llm.common import column_of
from mailtriage.llm.graph import components
from mailtriage.session import staged_table

NEAREST, SHARED = 6, 3
PIVOTS_PER_ROOT, MOST_PIVOTS = 2.0, 8192
APART = 0.8
LIST = ["part", "u", "v"]
LIST_BLOCK = 512
CHUNK_PAIRS = 1 << 16


def vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vec, usable): usable vectors have a label, finite components and a length above zero."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    return rows.withColumn("usable", F.coalesce(usable, F.lit(False)))


def _units(flat: np.ndarray, width: int) -> np.ndarray:
    vec = flat.reshape(-1, width)
    scale = np.abs(vec).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
    vec = vec / scale
    return vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True))


def pivots(nodes: DataFrame, per_root: float = PIVOTS_PER_ROOT, most: int = MOST_PIVOTS) -> dict[int, np.ndarray]:
    """Reference points by vector width: ``per_root`` times the square root of the rows, ``most`` at most.

    They are taken from a sample twice as large, in the order of a hash of the vector, leaving out those within
    ``APART`` of one taken before: points of one dense group would tell its members apart by noise only.
    """
    found = {}
    for width, n in nodes.groupBy("width").agg(F.count("*").alias("n")).collect():
        take = min(most, n, max(NEAREST, math.ceil(per_root * math.sqrt(n))))
        rows = nodes.where(F.col("width") == width).orderBy(F.xxhash64("vec"), "node").limit(2 * take).select("vec").collect()
        sample = _units(np.array([r["vec"] for r in rows]), width)
        kept: list[int] = []
        for i in range(len(sample)):
            if len(kept) < take and (not kept or (sample[kept] @ sample[i]).max() < APART):
                kept.append(i)
        found[width] = sample[kept]
    return found


def descriptions(nodes: DataFrame, points: dict[int, np.ndarray]) -> DataFrame:
    """(node, pivots): numbers of the nearest reference points, nearest first."""
    held = nodes.sparkSession.sparkContext.broadcast(points)  # MOST_PIVOTS vectors a width at most

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = column_of(batch, "width").to_numpy()
            vecs, out = column_of(batch, "vec"), np.empty(len(widths), object)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                unit = _units(vecs.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), width)
                near = unit @ held.value[width].T
                k = min(NEAREST, near.shape[1])
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
                out[at] = list(np.take_along_axis(top, order, 1).astype("i4"))
            yield pa.RecordBatch.from_arrays([column_of(batch, "node"), pa.array(list(out), pa.list_(pa.int32()))], ["node", "pivots"])

    return nodes.select("node", "width", "vec").mapInArrow(run, "node binary, pivots array<int>")


def _meeting(a: np.ndarray, b: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whether two descriptions share SHARED pivots and their list is that of the two smallest shared ones."""
    equal = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0)
    low = equal & (a < v[:, None]) & (a != u[:, None])
    return (equal.sum(axis=1) >= np.minimum(SHARED, np.minimum((a >= 0).sum(axis=1), (b >= 0).sum(axis=1)))) & ~low.any(axis=1)


def links(nodes: DataFrame, described: DataFrame, threshold: float) -> DataFrame:
    """(node, partner, n): partial results of the lists: n vectors linked with a node, and a node of the same
    component (a spanning set of the links, not all of them)."""
    pair = F.explode(F.expr("""flatten(transform(sequence(0, size(s) - 2), i ->
        transform(sequence(i + 1, size(s) - 1), j -> struct(s[i] as u, s[j] as v))))"""))
    one = F.expr("array(struct(s[0] as u, s[0] as v))")  # a single reference point: one list
    entries = described.join(nodes.select("node", "part"), "node").withColumn("s", F.array_sort("pivots"))
    entries = entries.where("size(s) > 1").select("node", "part", pair.alias("k")).unionByName(
        entries.where("size(s) = 1").select("node", "part", F.explode(one).alias("k")))
    entries = staged_table(entries.select("node", "part", "k.u", "k.v"), "entries")
    entries = blocks.units(entries, LIST, "node", LIST_BLOCK)
    full = blocks.sorted_units(entries.join(described, "node").join(nodes.select("node", "vec", "size"), "node"), LIST, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from blocks.tables(batches, LIST, lambda table, starts: _linked(table, starts, threshold))

    columns = full.select("part", "u", "v", "x", "y", "second", "node", "pivots", "vec", "size")
    return staged_table(columns.mapInArrow(run, "node binary, partner binary, n long"), "links")


def _linked(table: pa.Table, starts: np.ndarray, threshold: float) -> pa.RecordBatch:
    found = table["pivots"].combine_chunks()
    spans = np.diff(found.offsets.to_numpy())
    near = np.full((table.num_rows, max(1, int(spans.max(initial=1)))), -1, np.int32)
    near[np.arange(near.shape[1]) < spans[:, None]] = found.flatten().to_numpy()
    u, v = table["u"].to_numpy(), table["v"].to_numpy()
    flat = table["vec"].combine_chunks()
    widths = np.diff(flat.offsets.to_numpy())
    flat, at = flat.flatten().to_numpy(), np.cumsum(widths) - widths
    weight = table["size"].to_numpy()
    hits_i, hits_j = [], []
    units = {w: _units(np.concatenate([flat[a : a + w] for a in at[widths == w]]), w) for w in np.unique(widths).tolist()}
    place = np.zeros(table.num_rows, int)
    for w in units:
        place[widths == w] = np.arange((widths == w).sum())
    for i, j in blocks.pairs(table, starts, CHUNK_PAIRS):
        ok = _meeting(near[i], near[j], u[i], v[i])
        i, j = i[ok], j[ok]
        for w, unit in units.items():
            own = widths[i] == w
            a, b = i[own], j[own]
            cosine = np.einsum("ij,ij->i", unit[place[a]], unit[place[b]])
            hits_i.append(a[cosine >= threshold])
            hits_j.append(b[cosine >= threshold])
    i, j = (np.concatenate(h) if h else np.zeros(0, int) for h in (hits_i, hits_j))
    count = np.bincount(i, weight[j], table.num_rows) + np.bincount(j, weight[i], table.num_rows)
    rows = np.flatnonzero(count)
    partner = blocks.settled(np.arange(table.num_rows), i, j)[rows]
    node = table["node"].combine_chunks()
    return pa.RecordBatch.from_arrays([node.take(pa.array(rows)), node.take(pa.array(partner)), pa.array(count[rows].astype(np.int64))],
                                      ["node", "partner", "n"])


def near_duplicates(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Only vectors with equal, non-null labels and equal width are compared.  n_links counts the other vectors
    found with a cosine of ``threshold`` or more, component_id is the smallest vec_id reachable by links.
    Null, zero and non-finite vectors, and those without a label, link with nothing, not even with copies.
    Equal vectors are one node of the index, so copies are counted and never paired; long lists are cut into
    blocks of ``LIST_BLOCK`` that meet two by two.  Repeated rows are vectors of their own; a null id can have
    links but is nobody's component unless alone; an empty table gives no rows.
    """
    rows = vectors(rows, id_col, vec_col, label_col)
    marked = rows.withColumn("node", F.when(F.col("usable"), F.unhex(F.md5(F.concat_ws("|", "label", F.col("vec").cast("string")).cast("binary")))))
    marked = staged_table(marked, "vectors")
    nodes = marked.where("usable").groupBy("node").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("size"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    nodes = nodes.withColumn("width", F.size("vec")).withColumn("part", F.concat_ws("|", "width", "label"))
    nodes = staged_table(nodes, "nodes")
    described = staged_table(descriptions(nodes, pivots(nodes)), "descriptions")
    found = links(nodes, described, threshold)
    joined = components(found.where("node != partner"), "node", "partner")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = nodes.select("node", "vec_id", "size").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = groups.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    groups = groups.join(least, "component").join(counts, "node", "left").select(
        "node", "component_id", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = marked.select("vec_id", "node").join(groups, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
