"""Pairs inside sorted lists, in bounded blocks: shared by the operators that compare list members.

A list of n rows is cut into ceil(n / size) blocks by hash; every two blocks, and each with itself, form a
unit (key, x, y) of at most two blocks' rows.  Units are sorted inside partitions and read as Arrow tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def units(entries: DataFrame, keys: list[str], row: str, size: int) -> DataFrame:
    """``entries`` of lists with two rows or more, repeated for each unit (x, y) of their list; ``second`` marks
    the rows of block y where it differs from x."""
    lists = entries.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    found = entries.join(lists, keys).withColumn("_blocks", F.ceil(F.col("_n") / size).cast("int"))
    found = found.withColumn("_block", F.pmod(F.xxhash64(row), F.col("_blocks")).cast("int"))
    found = found.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    found = found.withColumns({"x": F.least("_block", "_other"), "y": F.greatest("_block", "_other"), "second": F.col("_block") > F.col("_other")})
    return found.drop("_n", "_blocks", "_block", "_other")


def sorted_units(rows: DataFrame, keys: list[str], row: str) -> DataFrame:
    keys = [*keys, "x", "y"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "second", row)


def tables(batches: Iterable[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``work`` on tables of whole units with the first row of each; a unit cut by a batch is put together again."""
    carry: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([carry, table]) if carry is not None and carry.num_rows else table
        starts = edges(table, keys)
        if len(starts) > 1:
            yield work(table.slice(0, int(starts[-1])), starts[:-1])
        carry = table.slice(int(starts[-1]))
    if carry is not None and carry.num_rows:
        yield work(carry, np.zeros(1, np.int64))


def edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First rows of the units of a sorted table."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in (*keys, "x", "y"):
        column = table[name]
        if not pa.types.is_integer(column.type):
            column = column.combine_chunks().dictionary_encode()
            column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).indices
        column = column.to_numpy()
        change |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1])


def pairs(table: pa.Table, starts: np.ndarray, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j) of every unit, ``chunk`` at a time: across its two blocks, or within its only one."""
    sizes = np.diff(np.append(starts, table.num_rows))
    firsts = sizes - np.add.reduceat(table["second"].to_numpy().astype(int), starts)
    same = (table["x"].to_numpy() == table["y"].to_numpy())[starts]
    firsts = np.where(same, sizes, firsts)
    row = np.concatenate([np.arange(s, s + f) for s, f in zip(starts.tolist(), firsts.tolist())])
    begin = np.where(np.repeat(same, firsts), row + 1, np.repeat(starts + firsts, firsts))
    total = np.concatenate([[0], np.cumsum(np.repeat(starts + sizes, firsts) - begin)])
    for at in range(0, int(total[-1]), chunk):
        k = np.arange(at, min(at + chunk, int(total[-1])))
        r = np.searchsorted(total, k, side="right") - 1
        yield row[r], begin[r] + (k - total[r])


def settled(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest label that each row reaches by links (i, j); labels are row numbers."""
    label = label.copy()
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        for side in (label[i], label[j], i, j):
            np.minimum.at(label, side, low)
        label = label[label]
        if (label == before).all():
            break
    return label
