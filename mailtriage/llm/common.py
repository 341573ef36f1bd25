"""What the operators share: column projection, held-out folds, row keys and task-local batching."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """The columns an operator reads, under its own names; a null text counts as empty.

    Other columns stay behind, so none of them can clash with a name made here.
    """
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *(F.col(source).alias(name) for name, source in more.items()),
    )


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def text_groups(batches: Iterable[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
