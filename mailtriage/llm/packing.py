"""Sequence packing by power-of-two pieces: no sequence holds two documents, none needs padding.

A document of n tokens is cut at the binary digits of n: as many pieces of ``limit`` tokens as fit, then
one piece for each set bit of the rest, longest first.  Pieces of equal length form a bucket; a training
batch takes its sequences from one bucket, so every sequence is full.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtriage.llm.common import column_of, documents, text_groups, texts_of

# Fixed value: the word pattern of the byte-level vocabulary.
WORD_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed value: white space as the pattern understands it.
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Longer runs of white space are cut out before the pattern is tried, which gives up at a million of them.
LONG_RUN = 1 << 16
RUNS = re.compile(f"(?<!{BLANK}){BLANK}{{{LONG_RUN},}}")

PIECES = "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, bucket int"
FLUSH_IDS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies spell them."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary file, without its special tokens."""
    spec, alphabet = json.loads(tokenizer_json), byte_alphabet()
    special = {token["content"] for token in spec.get("added_tokens", ())}
    return {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def added_ids(tokenizer_json: str) -> dict[str, int]:
    """Strings that are one id wherever they stand in a text."""
    tokens = json.loads(tokenizer_json).get("added_tokens", ())
    if any(token[flag] for token in tokens for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their neighbours are not supported")
    return {token["content"]: token["id"] for token in tokens}


class Encoder:
    """Ids of whole texts, equal to those of the tokenizers library for the same vocabulary file.

    Strings of ``added`` are found first and are one id each; what stands between them is encoded by itself.
    """

    def __init__(self, ranks: dict[bytes, int], added: dict[str, int] | None = None):
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = added or {}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.finder = re.compile("|".join(map(re.escape, longest_first))) if self.added else None

    def encode(self, text: str) -> list[int]:
        if self.finder is None or not any(token in text for token in self.added):
            return self.between(text)
        ids, at = [], 0
        for m in self.finder.finditer(text):
            ids += self.between(text[at : m.start()])
            ids.append(self.added[m.group()])
            at = m.end()
        return ids + self.between(text[at:])

    def between(self, text: str) -> list[int]:
        """Ids of a text without added tokens.  A long run of white space is one word up to its last character,
        which belongs to what follows; at the end of the text all of it is one word."""
        if len(text) <= LONG_RUN:
            return self.plain.encode_ordinary(text)
        ids, at = [], 0
        for m in RUNS.finditer(text):
            end = m.end() - (m.end() < len(text))
            ids += self.plain.encode_ordinary(text[at : m.start()])
            ids += self.plain._encode_single_piece(text[m.start() : end])
            at = end
        return ids + self.plain.encode_ordinary(text[at:])


def piece_lengths(n: int, limit: int) -> list[int]:
    """Power-of-two lengths that add up to n, none above ``limit``."""
    full, rest = divmod(n, limit)
    return [limit] * full + [1 << bit for bit in reversed(range(limit.bit_length() - 1)) if rest >> bit & 1]


def pack(docs: DataFrame, tokenizer_path: str, limit: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, bucket, sequence_id, offset.

    ``bucket`` is the binary logarithm of the length: sequences of one bucket are equally long.  A task gives its
    pieces bucket by bucket, about ``FLUSH_IDS`` ids at a time, and ``sequence_id`` follows that order, so a batch of
    consecutive sequences is of one length but for few.  ``write_buckets`` lays them out in one folder a bucket.

    Texts are whole.  With ``added_tokens``, a special-token string in a text is its one id, as in the default
    settings of the tokenizers library; else it is ordinary text.  A null or empty text is its end id
    alone, one piece of length 1.  Repeated rows are packed once each, a null id stays null, an empty table
    gives no rows.  ``limit`` must be a power of two.  Work is row-local: nothing is shuffled, and
    ``sequence_id`` is unique because it is made of partition and row.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    added = added_ids(spec) if added_tokens else {}
    ranks = spark.sparkContext.broadcast(byte_ranks(spec))  # one vocabulary, fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks.value, added).encode
        for batch in text_groups(batches):
            doc_ids = column_of(batch, "doc_id").to_pylist()
            rows, flat, held = [], [], 0
            for doc_id, text in zip(doc_ids, texts_of(batch)):
                ids = np.array([*encode(text), end_id], "<u4")
                start = 0
                for length in piece_lengths(len(ids), limit):
                    piece = ids[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids)))
                    start += length
                flat.append(ids)
                held += len(ids)
                if held >= FLUSH_IDS:
                    yield _arrow(rows, flat)
                    rows, flat, held = [], [], 0
            if rows:
                yield _arrow(rows, flat)

    pieces = documents(docs, id_col, text_col).mapInArrow(run, PIECES)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def _arrow(rows: list[tuple], flat: list[np.ndarray]) -> pa.RecordBatch:
    """The pieces, longest bucket first and else in the order they came."""
    doc_id, start, length, crc, tokens = (pa.array(c, pa.int64()) for c in zip(*rows))
    sizes = length.to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype("i4")))
    bucket = pa.array([int(n).bit_length() - 1 for n in sizes], pa.int32())
    pieces = pa.RecordBatch.from_arrays([doc_id, start, length, ids, crc, tokens, bucket],
                                        ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "bucket"])
    return pieces.take(pa.array(np.argsort(-sizes, kind="stable")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write token sequences into one folder per bucket, ready to be read a bucket at a time."""
    pieces.write.partitionBy("bucket").parquet(path)
