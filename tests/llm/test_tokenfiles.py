"""Token files against the tokenizers library and plain arrays."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailtriage.llm import tokenfiles
from mailtriage.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start long, n_tokens long, file string, _h long"
TEXTS = [
    "Plain words, it's THE end.", "<|endoftext|> and <|ENDOFTEXT|>. a<|startoftext|>b", "  lead\n\n\ttrail  ", "", None,
    "naïve Ünïcode ΣΑΣ. ΟΔΟΣ İI K H̱ é. ﬁ日本語 😀!! x́. 12.5% don't!? \x00 a b c", "z" * 5000, "a b " * 20_000,
    "." * 3000, "tail.,;:!? ...x ?", "́start x́,", "end's. we'll, I'M", " " * 200_000 + "x",
]


def library_ids(text):
    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("values", [
    [], [0], [0] * 700, [2**32 - 1, 0, 1], list(range(3000)), [5, 300, 70_000, 2**20, 2**31] * 400, [49_407] * 513,
])
def test_codes_hold_every_value(values):
    ids = np.array(values, np.uint32)
    file = tokenfiles.TokenFile(tokenfiles.file_bytes(3, 4, [7, None], np.array([len(ids) // 2, len(ids) - len(ids) // 2]), ids))
    assert (file.part, file.number, file.n_tokens) == (3, 4, len(ids))
    assert (file.span(0, len(ids)) == ids).all()
    places = np.random.default_rng(0).permutation(len(ids))
    assert (file.ids(places) == ids[places]).all()
    assert np.concatenate([file.document(0), file.document(1)]).tolist() == values
    for at in range(0, len(ids), 97):
        assert (file.span(at, min(at + 130, len(ids))) == ids[at : at + 130]).all()


def test_chunk_widths_are_the_cheapest():
    values = np.array([1] * 900 + [1000] * 80 + [60_000] * 20, np.uint32)
    size = {}
    for first in range(1, 17):
        for second in range(0, 17 - first):
            widths = [w for w in (first, second, 16 - first - second) if w]
            covered = np.cumsum([0, *widths])
            size[tuple(widths)] = sum(
                (values >= (1 << int(c) if c else 0)).sum() * (w + (0 if i == len(widths) - 1 else 1 + 32 / tokenfiles.RANK_BITS))
                for i, (c, w) in enumerate(zip(covered, widths)))
    best = tuple(tokenfiles.chunk_widths(values))
    assert sum(best) == 16 and size.get(best, 0) <= min(size.values())


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(b"x" * 100)


def test_ids_equal_the_library_and_any_token_is_found(spark, tmp_path):
    rows = [(i, t, 0, 0, "f", 1) for i, t in enumerate(TEXTS)] + [(1, TEXTS[0], 0, 0, None, None), (1, TEXTS[0], 0, 0, None, None), (None, "no id", 1, 1, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    tokenfiles.write(docs, str(tmp_path / "a"), WORDS, file_tokens=1000)
    found = sorted(tokenfiles.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    want = sorted((r[0] if r[0] is not None else -1, library_ids(r[1])) for r in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, list(r["ids"])) for r in found) == want
    flat = []
    for r in found:
        assert r["start"] == len(flat) and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        flat += r["ids"]
    assert spark.read.parquet(str(tmp_path / "a/files")).count() > 1
    asked = [*np.random.default_rng(1).integers(0, len(flat), 300).tolist(), -1, len(flat), None, 0, 0, len(flat) - 1]
    places = spark.createDataFrame([(p,) for p in asked], "place long")
    got = {r["place"]: r["id"] for r in tokenfiles.tokens_at(spark, str(tmp_path / "a"), places).collect()}
    assert got == {p: flat[p] for p in asked if p is not None and 0 <= p < len(flat)}


def test_many_known_words_change_nothing(monkeypatch):
    with open(WORDS, encoding="utf-8") as f:
        encoder = tokenfiles.WordEncoder(f.read())
    monkeypatch.setattr(tokenfiles, "KNOWN_WORDS", 3)
    for _ in range(2):
        for text in TEXTS[:4]:
            ids, counts = encoder.encode(pa.array([text, text]))
            assert ids.tolist() == library_ids(text)[:-1] * 2 and counts.tolist() == [len(ids) // 2] * 2


def test_empty_table_gives_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    tokenfiles.write(none, str(tmp_path / "none"), WORDS)
    assert tokenfiles.read(spark, str(tmp_path / "none")).count() == 0
    assert tokenfiles.tokens_at(spark, str(tmp_path / "none"), spark.range(3).withColumnRenamed("id", "place")).count() == 0


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op11_tokenfiles"](spark, sf).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in docs.select("doc_id").orderBy("doc_id").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.where(F.col("doc_id") % 5 == 0).collect()}
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["doc_id"] in texts:
            ids = library_ids(texts[r["doc_id"]])
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
