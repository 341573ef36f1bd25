"""Token ids as files of directly addressable codes.

A file holds the ids of consecutive documents.  Every id is cut into chunks, lowest bits first; level k keeps
the k-th chunk of all ids that have one, packed bit by bit, and a bitmap that says which of them go on to level
k + 1.  A rank directory counts the ones before every 512 bits, so the place of a chunk on the next level is one
directory entry and one popcount away: any token is read by itself, no block is decoded.

File layout (little-endian, every part padded to 8 bytes): magic; writing partition, number within it, documents,
tokens, levels; document ids and which are null; first token of each document and the end; then per level its chunk
width, length, chunks, continuation bitmap and rank directory.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailtriage.llm.common import column_of, documents, text_groups
from mailtriage.operators.lookup import is_small

MAGIC = b"DACODES1"
HEADER = struct.Struct("<8sqqqqq")
LEVEL = struct.Struct("<qq")
FILE_TOKENS = 1 << 21  # a file is closed after the document that reaches this
RANK_BITS = 512
MAX_WIDTH = 16
PACK_STEP = 1 << 18
GROUP_BYTES = 2 << 20
READ_STEP = 1 << 18
KNOWN_WORDS = 300_000  # distinct words whose ids a task keeps; past that it starts anew
ANSWER_BLOCK = 1 << 16

# a run of marks at the end of a word is always a word of its own behind a plain letter or digit
MARKS = ".,;:!?"
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿß"
BEFORE_MARKS = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ" + LETTERS)

ENTRY = "file string, part long, number long, n_docs long, n_tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids array<int>, ids_crc32 long"


# codes

def chunk_widths(values: np.ndarray) -> list[int]:
    """Chunk widths that make the levels smallest, by dynamic programming over the bit lengths that occur."""
    lengths = np.zeros(len(values), np.int64) if not len(values) else np.frexp(np.maximum(values, 1).astype(float))[1]
    longest = int(lengths.max(initial=1))
    longer = [int((lengths > bits).sum()) if bits else len(values) for bits in range(longest + 1)]
    best: list[tuple[float, list[int]]] = [(0.0, [])]  # by bits covered, from the top down
    for left in range(1, longest + 1):
        start, options = longest - left, []
        for width in range(1, min(left, MAX_WIDTH) + 1):
            rest, widths = best[left - width]
            bitmap = 0 if width == left else 1 + 32 / RANK_BITS
            options.append((longer[start] * (width + bitmap) + rest, [width, *widths]))
        best.append(min(options))
    return best[longest][1]


def _pack(values: np.ndarray, width: int) -> bytes:
    shifts = np.arange(width, dtype=np.uint32)
    return b"".join(np.packbits(((values[at : at + PACK_STEP, None] >> shifts) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()
                    for at in range(0, len(values), PACK_STEP))


def _padded(data: bytes, spare: int = 0) -> bytes:
    return data + bytes(spare + -(len(data) + spare) % 8)


def _rank_directory(bitmap: bytes) -> np.ndarray:
    """Ones before every block of RANK_BITS bits."""
    counts = np.bitwise_count(np.frombuffer(bitmap, "<u8")).reshape(-1, RANK_BITS // 64).sum(1, dtype=np.int64)
    return (np.cumsum(counts) - counts).astype("<u4")


def coded(values: np.ndarray) -> bytes:
    """Levels of an array of non-negative ids below 2^32."""
    values = values.astype(np.uint32)
    out = []
    widths = chunk_widths(values)
    for level, width in enumerate(widths):
        out += [LEVEL.pack(width, len(values)), _padded(_pack(values & np.uint32((1 << width) - 1), width), spare=4)]
        if level + 1 < len(widths):
            rest = values >> np.uint32(width)
            bits = np.packbits(rest > 0, bitorder="little").tobytes()
            bitmap = bits + bytes(-len(bits) % (RANK_BITS // 8))
            out += [bitmap, _padded(_rank_directory(bitmap).tobytes())]
            values = rest[rest > 0]
    return struct.pack("<q", len(widths)) + b"".join(out)


def _chunks_at(places: np.ndarray, width: int, chunks: np.ndarray) -> np.ndarray:
    bit = places * width
    byte = bit >> 3
    word = chunks[byte].astype(np.uint32) | chunks[byte + 1].astype(np.uint32) << 8 | chunks[byte + 2].astype(np.uint32) << 16
    return word >> (bit & 7).astype(np.uint32) & np.uint32((1 << width) - 1)


def _rank(places: np.ndarray, bitmap: np.ndarray, directory: np.ndarray) -> np.ndarray:
    """Ones before each place: those before its block, those of the block's whole words since, those below it in its word."""
    words = bitmap.view("<u8")
    word, block = places >> 6, places // RANK_BITS
    ones, first = directory[block].astype(np.int64), block * (RANK_BITS // 64)
    for step in range(RANK_BITS // 64 - 1):
        inside = first + step < word
        ones[inside] += np.bitwise_count(words[first[inside] + step])
    below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
    return ones + np.bitwise_count(words[word] & below)


class TokenFile:
    """One file, read in place: ``ids(places)`` fetches tokens at any places, ``span`` and ``document`` consecutive ones."""

    def __init__(self, content: bytes):
        magic, self.part, self.number, self.n_docs, self.n_tokens, _ = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        self.doc_ids = np.frombuffer(content, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.no_id = np.frombuffer(content, np.bool_, self.n_docs, at)
        at += self.n_docs + -self.n_docs % 8
        self.starts = np.frombuffer(content, "<i8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        (levels,) = struct.unpack_from("<q", content, at)
        at += 8
        self.levels = []
        for level in range(levels):
            width, n = LEVEL.unpack_from(content, at)
            at += LEVEL.size
            size = -(-n * width // 8) + 4
            chunks = np.frombuffer(content, np.uint8, size, at)
            at += size + -size % 8
            bitmap = directory = None
            if level + 1 < levels:
                blocks = -(-n // RANK_BITS)
                bitmap = np.frombuffer(content, np.uint8, blocks * RANK_BITS // 8, at)
                at += len(bitmap)
                directory = np.frombuffer(content, "<u4", blocks, at)
                at += 4 * blocks + -4 * blocks % 8
            self.levels.append((width, chunks, bitmap, directory))

    def ids(self, places: np.ndarray) -> np.ndarray:
        """Tokens at any places of the file: one chunk, one bit and one rank a level."""
        out = np.zeros(len(places), np.uint32)
        rows, shift = np.arange(len(places)), 0
        for width, chunks, bitmap, directory in self.levels:
            out[rows] |= _chunks_at(places, width, chunks) << np.uint32(shift)
            if bitmap is None:
                break
            goes_on = (bitmap[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
            rows, places = rows[goes_on], _rank(places[goes_on], bitmap, directory)
            shift += width
        return out

    def span(self, start: int, end: int) -> np.ndarray:
        """Tokens of consecutive places; their chunks are consecutive on every level, so one rank a level is enough."""
        out = np.zeros(end - start, np.uint32)
        rows, shift, n = np.arange(end - start), 0, end - start
        for width, chunks, bitmap, directory in self.levels:
            out[rows] |= _chunks_at(np.arange(start, start + n), width, chunks) << np.uint32(shift)
            if bitmap is None or not n:
                break
            bits = np.unpackbits(bitmap[start >> 3 : (start + n + 7) >> 3], bitorder="little")[start & 7 : (start & 7) + n]
            rows = rows[bits.astype(bool)]
            start, n = int(_rank(np.array([start]), bitmap, directory)[0]) if len(rows) else 0, len(rows)
            shift += width
        return out

    def document(self, i: int) -> np.ndarray:
        return self.span(int(self.starts[i]), int(self.starts[i + 1]))

    def pieces(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, end document, their ids), about READ_STEP tokens at a time."""
        first = 0
        while first < self.n_docs:
            end = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + READ_STEP, side="right")) - 1)
            yield first, end, self.span(int(self.starts[first]), int(self.starts[end]))
            first = end


def file_bytes(part: int, number: int, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    return b"".join([
        HEADER.pack(MAGIC, part, number, len(doc_ids), len(ids), 0),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), _padded(np.array([d is None for d in doc_ids], np.bool_).tobytes()),
        starts.tobytes(), coded(ids)])


# encoding

class WordEncoder:
    """Ids of whole texts through the tokenizers library, each distinct word once.

    Meant for vocabularies that drop white space and never let a word cross it, so a text has the ids of its words
    one after the other.  Words are cut at ASCII white space; ASCII words are lower-cased first if the vocabulary
    does so, and the marks behind a letter are looked up apart.  Words with a bar stay as they are, since they may
    hold an added token.  Words of plain Latin letters go to the library's model at once, other words through all its steps.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        normalizer, splitter, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        normal = (lambda text: text) if normalizer is None else normalizer.normalize_str
        self.lower = normal("Ab") == "ab"
        # letters that the steps before the model leave alone, or spell by themselves, inside a word
        spelt = {c: splitter.pre_tokenize_str(f"a{c}a") for c in LETTERS} if splitter is not None else {}
        self.spelling = {ord(c): found[0][0][1:-1] for c, found in spelt.items() if normal(c) == c and len(found) == 1}
        self.plain = re.compile(f"[{''.join(map(chr, self.spelling))}]+" if self.spelling else "(?!)").fullmatch
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.pool, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        plain, rest, lists, tokenize = [], [], [], self.model.tokenize
        for word in words:
            if self.plain(word):
                plain.append(word)
                lists.append([t.id for t in tokenize(word if word.isascii() else word.translate(self.spelling))])
            else:
                rest.append(word)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum()))
        if rest:
            found = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
            ids = np.concatenate([ids, np.array(found.ids, np.int32)])
            sizes = np.concatenate([sizes, np.bincount(np.array(found.word_ids, np.int64), minlength=len(rest))])
        self.known.update(zip(plain + rest, range(len(self.starts), len(self.starts) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, ids])

    def _parts(self, words: list[str]) -> list[str]:
        """Every word as two: itself and the marks behind it, or itself and nothing."""
        parts = []
        for word in words:
            if "|" in word:
                parts += (word, "")
                continue
            if self.lower and word.isascii():
                word = word.lower()
            core = word.rstrip(MARKS)
            parts += (core, word[len(core):]) if core[-1:] in BEFORE_MARKS and core else (word, "")
        return parts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        parts = self._parts(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        new = list({p: None for p in parts if p not in self.known})
        if new:
            self._learn(new)
        of_part = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        pool, sizes = _runs(self.pool, self.starts[of_part], self.sizes[of_part]), self.sizes[of_part].reshape(-1, 2).sum(1)
        starts, row = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        before = np.concatenate([[0], np.cumsum(sizes[row])])
        return _runs(pool, starts[row], sizes[row]), np.diff(before[offsets])


def _runs(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of the pool that begin at ``starts``, one after the other."""
    begins = np.cumsum(sizes) - sizes
    return pool[np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))]


@functools.lru_cache(maxsize=1)
def _encoder(spec: str) -> WordEncoder:
    """One for all tasks of a Python worker, so that words are learnt once."""
    return WordEncoder(spec)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
          file_tokens: int = FILE_TOKENS) -> None:
    """Write the ids of all documents, each with ``end_id`` behind it, in ascending order of id.

    ``path/ids`` gets the token files, ``path/files`` a table with one row a file: its name, documents, tokens
    and the tokens before it.  Documents without an id come first; those with the same id are ordered by a hash of
    their text, repeated rows are written once each; a null or empty text is its end id alone; an empty table gives
    no file.  Added-token strings in a text are their ids, as in the library's default settings.

    Texts are dealt by ranges of (id, hash of the text), each task encodes and writes its own range.  Files go through
    Spark's committer: what a lost executor had written does not count, and its tasks run again.  A file ends after
    ``file_tokens`` tokens, so a task holds one file at a time, whatever the size of its range.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary, fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(spec.value), TaskContext.get().partitionId(), 0
        names, lengths, flat, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            content = file_bytes(part, number, names, np.concatenate(lengths), np.concatenate(flat))
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in text_groups(batches, GROUP_BYTES):
            ids, counts = encoder.encode(column_of(batch, "text"))
            doc_ids = column_of(batch, "doc_id").to_pylist()
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            ends, first, begin = np.cumsum(counts), 0, 0
            while first < len(doc_ids):
                last = min(int(np.searchsorted(ends, begin + file_tokens - held)) + 1, len(doc_ids))
                names += doc_ids[first:last]
                lengths.append(counts[first:last])
                flat.append(ids[begin : ends[last - 1]])
                held += int(ends[last - 1]) - begin
                first, begin = last, int(ends[last - 1])
                if held >= file_tokens:
                    yield closed()
                    number += 1
                    names, lengths, flat, held = [], [], [], 0
        if names:
            yield closed()

    read = documents(docs, id_col, text_col).withColumn("_h", F.xxhash64("text"))
    laid = read.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    files = laid.mapInArrow(run, "content binary").select(F.col("content").cast("string"))
    # the line writer stores the bytes as they are, with one line end behind them, which no reader reaches
    files.write.option("maxRecordsPerFile", 1).text(f"{path}/ids")
    entries = _files(spark, path).mapInArrow(_entries, ENTRY)
    within = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    parts = entries.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row a writing task
    before = parts.select("part", F.coalesce(F.sum("_n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    entries = entries.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(before, "part")
    entries.select("file", "n_docs", "n_tokens", (F.col("_before") + F.col("_within")).alias("before")).write.parquet(f"{path}/files")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of the token files; a task without rows leaves an empty one behind, which is passed over."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").where(f"length >= {HEADER.size}")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [HEADER.unpack_from(content.as_buffer()) for content in column_of(batch, "content")]
        columns = [pa.array([h[i] for h in heads], pa.int64()) for i in (1, 2, 3, 4)]
        yield pa.RecordBatch.from_arrays([column_of(batch, "file"), *columns], ["file", "part", "number", "n_docs", "n_tokens"])


def _with_place(spark: SparkSession, path: str) -> DataFrame:
    """(file, content, before): the files with the number of tokens before each."""
    table = spark.read.parquet(f"{path}/files").select("file", "before")
    return _files(spark, path).join(F.broadcast(table) if is_small(table) else table, "file")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids, ids_crc32 of every document, from its file; ``start`` counts the ids of all
    documents before it.  A folder written from an empty table gives no rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, before in zip(column_of(batch, "content"), column_of(batch, "before").to_pylist()):
                tokens = TokenFile(content.as_buffer())
                for first, end, ids in tokens.pieces():
                    starts = tokens.starts[first : end + 1]
                    cuts = starts - starts[0]
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(tokens.doc_ids[first:end], pa.int64(), mask=tokens.no_id[first:end]), pa.array(starts[:-1] + before, pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts.astype("i4")), pa.array(ids.astype("i4"))),
                        pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return _with_place(spark, path).mapInArrow(run, DOCUMENT)


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place_col: str = "place") -> DataFrame:
    """(place, id) for every distinct place of a table, counted over all files from 0; places outside the files, and
    null ones, give no row.

    A place finds its file by an equality join on spans of FILE_TOKENS tokens.  Places of one file are asked for in
    blocks of bounded size, so a file that everyone reads is sent to several tasks.
    """
    wanted = places.select(F.col(place_col).cast("long").alias("place")).where("place >= 0").distinct()
    table = spark.read.parquet(f"{path}/files").where("n_tokens > 0")
    span = F.explode(F.sequence(F.expr(f"before div {FILE_TOKENS}"), F.expr(f"(before + n_tokens - 1) div {FILE_TOKENS}")))
    spans = table.select("file", "before", "n_tokens", span.alias("span"))
    found = (wanted.withColumn("span", F.expr(f"place div {FILE_TOKENS}")).join(spans, "span")
             .where("place >= before and place < before + n_tokens"))
    blocks = found.groupBy("file", F.expr("place % (n_tokens div {0} + 1)".format(ANSWER_BLOCK)).alias("block")).agg(
        F.first("before").alias("before"), F.collect_list("place").alias("places"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = column_of(batch, "places")
            for row, (content, before) in enumerate(zip(column_of(batch, "content"), column_of(batch, "before").to_pylist())):
                places = asked[row].values.to_numpy()
                ids = TokenFile(content.as_buffer()).ids(places - before)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(ids.astype("i8"))], ["place", "id"])

    return _files(spark, path).join(blocks.drop("block"), "file").mapInArrow(run, "place long, id long")
