"""Phrase mining against plain counting of every n-gram."""

import random
import re
from collections import Counter

import pytest

from checks.compare import compare, connect
from mailtriage.llm import bits, collocations
from mailtriage.llm.bits import BitTable

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, words int"


def grams(docs):
    counts, words = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lower):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    return counts, words


def plain(docs, least, top):
    counts, words = grams(docs)
    candidates = {g: f for g, f in counts.items() if len(g[1]) > 1 and f >= least}
    covered = set()
    for (lang, w), f in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * f >= 80 * counts[lang, w[i : i + k]]:
                    covered.add((lang, w[i : i + k]))
    rows = []
    for lang in words:
        kept = []
        for (other, w), a in candidates.items():
            if other == lang and (lang, w) not in covered:
                cuts = []
                for k in range(1, len(w)):
                    l, r = counts[lang, w[:k]], counts[lang, w[k:]]
                    cuts.append((2_000_000 * a // (l + r), k, l, r))
                score, _, l, r = min(cuts)
                kept.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(rows)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, g, "p", 1, 2) for i, (t, g) in enumerate(docs)], SCHEMA).repartition(3)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "New", "York", "état", "日本", "x-1", "don't"]
    fixed = ["New York the state of", "alpha beta gamma delta", "of the, état of"]
    docs = []
    for i in range(n):
        text = " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(1, 60)))
        docs.append((text + rng.choice(["", ".", "!\n", "\r\n x", "\t\ttab", "\x0b"]), rng.choice(["en", "fr", None])))
    return docs


@pytest.mark.parametrize("one_in, sample_least, bold", [(1, 1, 0.25), (3, 2, 0.25), (10**9, 1, 0.25), (2, 500, 0), (2, 8, 1e9), (10**9, 1, 1e9)])
def test_the_sample_never_changes_the_result(spark, monkeypatch, one_in, sample_least, bold):
    monkeypatch.setattr(collocations, "BOLD", bold)
    docs = prose(1, 150)
    got = collocations.collocations(frame(spark, docs), least=5, top=40, sample_one_in=one_in, sample_least=sample_least).collect()
    assert sorted(map(tuple, got)) == plain(docs, 5, 40)


def test_a_tiny_bit_table_costs_time_only(spark, monkeypatch):
    monkeypatch.setattr(bits, "TABLE_BITS", 6)
    docs = prose(2, 80)
    got = collocations.collocations(frame(spark, docs), least=4, top=50).collect()
    assert sorted(map(tuple, got)) == plain(docs, 4, 50)


def test_passes_close_whatever_was_proposed(spark):
    docs = frame(spark, prose(3, 100)).selectExpr("lang", "text").na.fill("und")
    counts, words = grams(prose(3, 100))
    want = {(lang, " ".join(w)): f for (lang, w), f in counts.items() if f >= 5} | {(lang, ""): n for lang, n in words.items()}
    table, passes = collocations.closed_table(docs, BitTable.empty(), 5)
    assert 2 <= passes <= collocations.LONGEST + 1
    assert collocations.closed_table(docs, table, 5)[1] == 1  # the right proposals need one pass
    assert {(r["lang"], r["phrase"]): r["f"] for r in collocations._spelt(docs, table, 5).collect()} == want


def test_odd_rows_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GROUP_BYTES", 50)
    monkeypatch.setattr(collocations, "OUT_ROWS", 3)
    docs = [(None, "en"), ("", "en"), (None, None), ("...", "en"), ("a b " * 3000, "en"), ("A B.\x00 a b", ""), ("a\tb  a b c\u0085d", "en")]
    docs += [("same row of words", "en")] * 9
    got = collocations.collocations(frame(spark, docs), least=2, top=100).collect()
    assert sorted(map(tuple, got)) == plain(docs, 2, 100)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows, problem = compare(spark, connect(sf), sf, "op13_collocations")
    assert not problem and rows > 0
