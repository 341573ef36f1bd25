"""Corpus preparation in five stages over ``documents``; each stage is written and reread by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtriage.llm import langid, minhash, packing, pii, toxicity
from mailtriage.llm.common import fold
from mailtriage.llm.queries import pii_key, table
from mailtriage.session import staged_table


def clean_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the lexicon is learnt from the labels of those that came in.

    Null and empty texts have no hit and stay; repeated rows share their fate; null ids are kept; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose best language has less than 0.35 of the positions, go.

    So null and empty texts go; repeated rows share their fate; null ids are kept; an empty table stays empty.
    """
    return langid.drop_unknown(docs, langid.fit(docs, fold("doc_id", 4) != 2), min_score=0.35)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the document with the smallest id stays.

    Repeated rows are one class; an empty table stays empty.  Further cases: ``minhash.drop_duplicates``.
    """
    return minhash.drop_duplicates(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms under the session's key; ``n_chars`` counts the new text, which may be longer or shorter.

    Null and empty texts stay as they are, with their ``n_chars``; repeated rows and null ids are kept; an empty table stays empty.
    """
    hidden = pii.hide(docs, pii_key(spark))
    if "n_chars" not in docs.columns:
        return hidden
    counted = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return hidden.withColumn("n_chars", counted)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one document each, with their ids and their bucket of equal lengths.

    A null or empty text is its end id alone; repeated rows are packed once each; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [("toxicity", clean_toxic), ("language", known_language), ("minhash", one_of_each), ("pii", hide_personal_data), ("packing", pack)]
#: The stages score, sample hashes and encode tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
