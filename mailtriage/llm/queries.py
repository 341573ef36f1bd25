"""Registered queries of the operators: op<N>_<name>, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtriage.llm import collocations, hmm, langid, lexical, licenses, minhash, packing, pii, pivots, sentencepieces, spotsigs, tokenfiles, toxicity
from mailtriage.llm import sql
from mailtriage.llm.common import fold
from mailtriage.session import staging_dir

#: Key of the pseudonyms; whoever has it can undo them, so a real job sets its own.
PII_KEY_SETTING, PII_KEY = "spark.mailtriage.pii.key", b"mailtriage pseudonym key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii_key(spark: SparkSession) -> bytes:
    """The session's key; without one the demonstration key, so that the queries run anywhere."""
    found = spark.conf.get(PII_KEY_SETTING, None)
    return found.encode() if found else PII_KEY


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold("doc_id", 4) != 2)
    return langid.identify(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii_key(spark))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "hits")


def op7_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.edited_likeness(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepieces.decode(sentencepieces.encode(table(spark, sf_dir, "documents"), model), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "sequence_id", "offset")


def op11_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    tokenfiles.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfiles.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash, "op2_language": op2_language, "op3_hmm": op3_hmm, "op4_pii": op4_pii, "op5_licenses": op5_licenses, "op6_toxicity": op6_toxicity, "op7_pivots": op7_pivots, "op8_spotsigs": op8_spotsigs, "op9_sentencepiece": op9_sentencepiece,
    "op10_packing": op10_packing, "op11_tokenfiles": op11_tokenfiles, "op12_nra": op12_nra, "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {"op12_nra": sql.RANKED, "op13_collocations": sql.COLLOCATIONS}
