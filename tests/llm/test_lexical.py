"""Ranked search against a plain evaluation of every document for every query."""

import math
import random
import re
from collections import Counter

import pytest

from checks.compare import compare, connect
from mailtriage.llm import lexical

DOCS = "doc_id long, text string, term string, row long, n long, item long"
ITEMS = "item_id long, text string, ord int, doc_id long"


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, top):
    """Sorted (item_id, rank, doc_id, score), each row a document or query of its own."""
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(b.values()) for _, b in bags]
    total, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, bag), n in zip(bags, sizes):
            score = 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * n * total) // length
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        out += [(item_id, rank, d if known else None, -s) for rank, (s, known, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def both(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "t", 1, 2, 3) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 0, None) for i, t in items], ITEMS)
    found = lexical.ranked(d.repartition(3), q, **options).collect()
    return sorted(map(tuple, found), key=repr), plain(docs, items, options.get("top", lexical.TOP))


def crowd(seed, n_docs, n_items):
    """Words of very different frequency, copies, ties, and long queries."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 10, 40, 200])))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[rng.randrange(40)][1]) for i in range(n_docs // 2)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 150])))) for i in range(n_items)]
    return docs, items


@pytest.mark.parametrize("first, growth", [(64, 4), (1, 1), (0, 0)])
def test_every_schedule_of_reads_gives_the_plain_result(spark, monkeypatch, first, growth):
    monkeypatch.setattr(lexical, "FIRST_READ", first)
    monkeypatch.setattr(lexical, "GROWTH", growth)
    docs, items = crowd(1, 300, 12)
    got, want = both(spark, docs, items, top=7)
    assert got == want


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SMALL_BYTES", -1)
    docs, items = crowd(2, 200, 6)
    got, want = both(spark, docs, items)
    assert got == want


def test_odd_rows(spark):
    docs = [(1, "The cat, the CAT; 42 cats"), (1, "The cat, the CAT; 42 cats"), (2, None), (3, ""), (4, "--- !!!"),
            (None, "cat naïve 日本語 \x00 é"), (5, "cat " * 5000 + "ÀB àb"), (6, "the dog"), (7, "the dog")]
    items = [(1, "cat cat THE the the"), (1, "dog"), (None, "naïve 日本語"), (2, None), (3, ""), (4, "unknown words"), (5, "àb ÀB Àb"),
             (6, " ".join(f"x{i}" for i in range(200)) + " cat dog")]
    got, want = both(spark, docs, items, top=3)
    assert got == want


def test_empty_tables(spark):
    some, none = [(1, "a b")], []
    assert both(spark, none, some)[0] == both(spark, some, none)[0] == both(spark, none, none)[0] == []
    assert both(spark, [(1, None)], some)[0] == both(spark, [(1, "c")], some)[0] == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows, problem = compare(spark, connect(sf), sf, "op12_nra")
    assert not problem and rows > 0
