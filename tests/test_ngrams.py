"""N-gram counts, certified vocabularies, vectors, and the published model."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailtriage.operators import ngrams as NG, tfidf as T
from mailtriage.plans import train as TR

WORDS, CHARS = {"w": "words"}, {"c": "chars"}


def char_grams(text):
    out = []
    for word in filter(None, text.split(" ")):
        padded = f" {word} "
        out += [padded[i : i + n] for n in (3, 4, 5) if len(padded) >= n for i in range(len(padded) - n + 1)]
    return out


def word_grams(text):
    words = [w for w in text.split(" ") if w]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows):
    stats = {}
    for words, chars in rows:
        for block, grams in (("w", word_grams(words or "")), ("c", char_grams(chars or ""))):
            for term, n in Counter(grams).items():
                tf, df = stats.get((block, term), (0, 0))
                stats[block, term] = tf + n, df + 1
    return stats


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "words string, chars string").repartition(3)


ODD = [(None, None), ("", ""), ("a", "a"), ("ab cd ab cd ab", "ab"), ("日本 語", "日本語 x 😀😀"), ("naïve \x00 x", "naïve \x00\x00 \x00"), ("x " * 3000, "y " * 3000),
       ("same", "same text"), ("same", "same text"), ("ÿ Ā ࿿ က", "ÿĀ࿿က")]


def test_counts_equal_plain_counts(spark, monkeypatch):
    rows = ODD + [("", "".join(map(chr, range(0x4E00, 0x4E00 + 5000))))]  # more letters than a packed window holds
    got = NG.gram_stats(frame_of(spark, rows), WORDS, CHARS).collect()
    assert {(r["block"], r["term"]): (r["tf"], r["df"]) for r in got} == plain(rows)


def test_an_empty_table_has_no_terms(spark):
    none = frame_of(spark, [])
    assert NG.gram_stats(none, WORDS, CHARS).count() == 0
    assert NG.vocabularies(none, WORDS, CHARS, {"w": 3, "c": 3}).count() == 0


@pytest.mark.parametrize("skewed", [True, False])
@pytest.mark.parametrize("first", [1, 16])
def test_vocabulary_equals_the_full_count(spark, skewed, first):
    rng = random.Random(4)
    names = [f"{a}{b}{c}" for a in "abcde" for b in "xyz" for c in "klm"]
    weights = [1 / (i + 1) if skewed else 1 for i in range(len(names))]
    rows = [(" ".join(rng.choices(names, weights, k=30)), " ".join(rng.choices(names, weights, k=10))) for _ in range(60)]
    sizes, stats = {"w": 20, "c": 15}, plain(rows)
    want = {}
    for block, size in sizes.items():
        kept = sorted((-tf, t, df) for (b, t), (tf, df) in stats.items() if b == block and df >= 2)[:size]
        want |= {(block, t): (-tf, df) for tf, t, df in kept}
    got = NG.vocabularies(frame_of(spark, rows), WORDS, CHARS, sizes, first=first).collect()
    assert {(r["block"], r["term"]): (r["tf"], r["df"]) for r in got} == want


@pytest.mark.parametrize("words", [True, False])
def test_block_vectors_equal_plain_weights(spark, words):
    rows = ODD + [("ab cd ef", "abcd abc")]
    texts = [r[0 if words else 1] for r in rows]
    grams = [Counter((word_grams if words else char_grams)(t or "")) for t in texts]
    terms = sorted({g for c in grams for g in c if not re.search("[x😀]", g)})[:40]
    weights = [1 + i / 10 for i in range(len(terms))]
    T.register_block(spark, f"block_of_test_{words}", words, terms, weights)
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.call_function(f"block_of_test_{words}", F.col("t")).alias("v")).orderBy("i").collect()
    for row, counts in zip(got, grams):
        value = np.array([(1 + np.log(counts[t])) * w if counts[t] else 0 for t, w in zip(terms, weights)])
        norm = np.linalg.norm(value)
        assert np.allclose(row["v"].toArray(), value / norm if norm else value)


def test_a_broken_save_leaves_the_published_model(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    assert TR.published(spark, path) is None
    with pytest.raises(FileNotFoundError):
        TR.load(spark, path)

    class Half:
        model = property(lambda self: self)
        feature_names, weights, functions, metrics = [("subject_word", "a")], [1.0], {}, {"f1": 1.0}

        def write(self):
            return self

        def save(self, folder):
            spark.range(1).write.parquet(f"{folder}/metadata")
            raise OSError("executor lost")

    with pytest.raises(OSError):
        TR.save(Half(), spark, path)
    assert TR.published(spark, path) is None  # model files are there, nothing points to them
    trained = []
    monkeypatch.setattr(TR, "fit", lambda corpus, **options: trained.append(1))
    monkeypatch.setattr(TR, "save", lambda *a: TR.publish(spark, path, "v1"))
    TR.train_or_load(spark, path, None)
    assert trained and TR.published(spark, path) == f"{path}/versions/v1"
    TR.publish(spark, path, "v2")
    assert TR.published(spark, path) == f"{path}/versions/v2"


def test_only_blocks_that_left_something_out_are_counted_again(spark, monkeypatch):
    again, recounted = [], NG._recounted
    monkeypatch.setattr(NG, "_recounted", lambda df, words, chars, wanted: again.append((words, chars)) or recounted(df, words, chars, wanted))
    df = spark.createDataFrame([("ab ab ab ab cd cd ef", "ab ab cd")] * 3 + [("ab gh ij kl", "ab")], "w string, c string")
    got = {(r["block"], r["term"]): (r["tf"], r["df"]) for r in NG.vocabularies(df, {"words": "w"}, {"chars": "c"}, {"words": 1, "chars": 9}, first=3).collect()}
    assert got[("words", "ab")] == (13, 4) and got[("chars", " ab")] == (7, 4)
    assert again == [({"words": "w"}, {})]
