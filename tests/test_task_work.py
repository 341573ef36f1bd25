"""Terms, weights and reasons are counted, weighed and chosen inside the tasks."""

import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X, urls as U
from mailtriage.operators import explain as E, ngrams as NG, scoring as S, tfidf as T
from mailtriage.plans import train as TR
from mailtriage.session import staged_table


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_a_task_hands_on_every_word_and_pair_once(monkeypatch):
    monkeypatch.setattr(NG, "GROUP_BYTES", 8)  # many groups
    batch = pa.RecordBatch.from_arrays([pa.array(["ab cd ab", "ab cd", None, "cd ab cd", ""])], ["t"])
    found = [(t, n, d) for _, terms, tf, df in NG._task_counts([batch], {"w": "t"}, {}) for t, n, d in zip(terms.to_pylist(), tf, df)]
    assert sorted(found) == [("ab", 4, 3), ("ab cd", 3, 3), ("cd", 4, 3), ("cd ab", 2, 2)]


def test_large_batches_are_cut_before_they_are_counted(monkeypatch):
    monkeypatch.setattr(NG, "GROUP_BYTES", 10)
    texts = pa.array(["a" * 9, None, "b" * 9, "", "c" * 50, "d"])
    pieces = list(NG.text_groups(texts))
    assert len(pieces) > 2 and sum((p.to_pylist() for p in pieces), []) == texts.to_pylist()


@pytest.mark.parametrize("block", T.BLOCKS, ids=lambda b: b.name)
def test_weights_of_repeated_and_missing_keys(spark, block):
    rows = [(1, "ab cd ab"), (2, "cd"), (2, "cd ab"), (None, "ab"), (3, ""), (4, None), (5, "zz")]
    df = spark.createDataFrame(rows, f"email_id long, {block.text} string")
    vocab = [{"term": t, "df": d} for t, d in ([("ab", 3), ("cd", 2), ("cd ab", 2)] if block.words else [(" ab", 3), ("cd ", 2), ("ab ", 3)])]
    got = {(r["email_id"], r["term"]): r["weight"] for r in T.tfidf_rows(df, block, "email_id", vocab, 7).collect()}
    names, expected = [v["term"] for v in vocab], {}
    for key in (1, 2):
        text = [t for k, t in rows if k == key]
        counts = {n: sum(f" {t} ".count(n) if not block.words or " " in n else t.split().count(n) for t in text) for n in names}
        w = {v["term"]: (1 + math.log(counts[v["term"]])) * (math.log(8 / (1 + v["df"])) + 1) for v in vocab if counts[v["term"]]}
        expected |= {(key, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    assert got.keys() == expected.keys()
    assert np.allclose([got[k] for k in expected], list(expected.values()))


def test_vector_entries_are_those_other_than_zero(spark):
    rows = [(Vectors.sparse(4, [1, 3], [0.0, -2.5]),), (Vectors.dense([1.0, 0.0, 0.0, 3.0]),), (Vectors.sparse(4, [], []),)]
    df = spark.createDataFrame(rows, ["v"])
    got = [[tuple(e) for e in r["e"]] for r in df.select(TR.vector_entries("v").alias("e")).collect()]
    assert got == [[(3, -2.5)], [(0, 1.0), (3, 3.0)], []]


def test_indicators_carry_no_list_of_all_names(spark):
    names = [("subject_word", "alpha"), ("body_word", "beta"), ("combined_char", "alp"), ("body_word", "gamma_ray"), ("numeric", "url_count"), ("body_word", "gamma ray")]
    solved = SimpleNamespace(coefficients=Vectors.dense([1.0, 1.0, 9.0, 0.25, 5.0, 2.0]))
    fitted = TR.TrainedModel(SimpleNamespace(stages=[solved]), names)
    df = spark.createDataFrame([(1, Vectors.sparse(6, [0, 1, 2, 3, 5], [0.12345, 0.12345, 1.0, 1.0, 0.5])), (2, Vectors.dense([0.0, -1.0, 1.0, 0.0, 1.0, 0.0]))], ["email_id", "features"])
    out = TR._indicators(fitted, df, 2, False)
    got = {r["email_id"]: [tuple(x) for x in r["model_indicators"]] for r in out.collect()}
    assert got == {1: [('Body contains "gamma ray"', 1.0), ('Body contains "beta"', 0.1234)], 2: []}
    assert "_names" not in plan_of(out)


def test_top_reasons_of_rows_with_one_key(spark):
    rows = [(1, [("body_word", "alpha", 0.5), ("body_word", "beta", 0.25), ("combined_char", "zzz", 9.0), ("body_word", "gamma", -1.0)]),
            (1, [("body_word", "beta", 0.75), ("subject_word", "alpha", 0.5)]), (2, []), (None, [("body_word", "delta", None)])]
    df = spark.createDataFrame(rows, "email_id long, contributions array<struct<source:string,value:string,contribution:double>>")
    got = sorted((r["email_id"], r["place"], r["reason"], r["impact"]) for r in E.top_reason_rows(df, limit=2).collect())
    assert got == [(1, 1, 'Body contains "beta"', 0.75), (1, 2, 'Body contains "alpha"', 0.5)]


ODD_TEXTS = [
    "verify verify.verify re-verify 'verify' éverify verify2 reverify verify\tverify  (click) click—here clicḱ login_ login‍",
    "reset your \n password, password reset reset password\x1creset your passwords click  here.", "i̇accept ä otp o-t-p otp", "", " ", "plain words only",
    "verify your account verify your\naccount xverify your account verify your account2 verify  your account", None,
]


def test_pieces_hold_every_hit_and_little_else(spark):
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string").withColumn("p", X.term_pieces(F.col("t"), K.KEYWORD_WEIGHTS))
    for find in (X.term_hits, X.token_terms):
        for r in df.select("t", find(F.col("t"), K.KEYWORD_WEIGHTS).alias("a"), find(F.col("p"), K.KEYWORD_WEIGHTS).alias("b")).collect():
            assert r["a"] == r["b"], r["t"]
    assert [r["p"] for r in df.where("t = 'plain words only'").collect()] == [""]
    assert X.term_pieces(F.col("t"), ["log in"])._jc.toString() == F.col("t")._jc.toString()


@pytest.mark.parametrize("phrase", K.PHRASE_WEIGHTS)
def test_phrases_are_counted_in_the_raw_text(spark, phrase):
    text = F.concat(F.lower(F.coalesce("t", F.lit(""))), F.lit(f" {phrase} {phrase}s {phrase.replace(' ', chr(0xa0) + chr(10))} x{phrase} {phrase}"))
    rows = spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string").select(
        X.phrase_count(text, phrase).alias("n"), F.size(X.term_hits(X.normalise(text), [phrase])).alias("m")).collect()
    assert all(r["n"] == r["m"] >= 3 for r in rows)


def test_links_of_a_body_are_cut_out_once(spark):
    df = spark.createDataFrame([("see https://a.example.com/x and www.b.org", ""), (None, "u")], "body string, url string").select(
        S.raw_links(F.col("body"), F.col("url")).alias("links"))
    assert [r["links"] for r in df.collect()] == [["example.com", "b.org"], ["u"]]
    assert str(df._jdf.queryExecution().analyzed()).count("regexp_extract_all") == 1


def test_addresses_are_looked_for_in_texts_with_one(spark):
    df = spark.createDataFrame([("write to a.b@mail.example.com or https://c.org/x",), ("no such sign",), ("@",), (None,)], "t string")
    found = df.select(U.text_domains(F.col("t")).alias("d"))
    assert [r["d"] for r in found.collect()] == [["c.org", "example.com"], [], [], []]
    assert "contains" in str(found._jdf.queryExecution().analyzed()).lower()


def test_vectors_of_all_blocks_are_made_in_pieces(monkeypatch):
    texts = [pa.array(["ab cd", None, "cd", "ab ab"]), pa.array(["", "cd ab", "cd", None])]
    entries = [T._term_entries(True, ["ab", "cd"]), T._term_entries(False, [" cd", "ab "])]
    weights = [np.array([1.0, 2.0]), np.array([3.0, 4.0])]
    whole = [v for p in T._block_vectors(entries, weights, texts) for v in p.to_pylist()]
    monkeypatch.setattr(T, "VECTOR_BYTES", 4)
    pieces = list(T._block_vectors(entries, weights, texts))
    assert len(pieces) > 2 and [v for p in pieces for v in p.to_pylist()] == whole
    assert [v["indices"] for v in whole] == [[0, 1], [2, 3], [1, 2], [0]] and {v["size"] for v in whole} == {4}
    assert np.allclose(whole[1]["values"], [0.6, 0.8])


def test_entries_of_a_vector_are_not_sent_to_python(spark):
    df = spark.createDataFrame([(Vectors.sparse(4, [1, 3], [0.0, -2.5]),)], ["v"])
    assert "Python" not in plan_of(df.select(TR.vector_entries("v").alias("e")))


def test_staged_tables_are_made_of_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    texts = spark.range(24, numPartitions=1).select(F.repeat(F.lit("a"), 1 << 20).alias("t"))
    found = [r["n"] for r in staged_table(texts.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(found) >= 24 << 20 and max(found) <= 10 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before
