"""Readers for mail files, tables and lists."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from mailtriage import schemas as SC
from mailtriage.functions import text as X, urls as U
from mailtriage.operators.domains import ranked_sites
from mailtriage.sources import mime


def mail_folders(spark: SparkSession, root: str, spam_folder: str = r"spam[^/]*") -> DataFrame:
    """path, label, message of every file below a folder, read as Latin-1.

    The label is 1 for files below a folder whose name starts with ``spam``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    spam = F.col("path").rlike(rf"/{spam_folder}/(?:[^/]*/)*[^/]*\Z")
    return files.select("path", F.when(spam, 1).otherwise(0).alias("label"),
                        F.decode("content", "ISO-8859-1").alias("message"))


def corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned corpus with quoted multi-line bodies."""
    return (spark.read.schema(SC.CLEAN_MAIL).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def corpus_csv_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The same scan; a missing file gives an empty frame with the same schema."""
    try:
        return corpus_csv(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SC.CLEAN_MAIL)


def domain_column(df: DataFrame, column: str = "domain") -> DataFrame:
    """Distinct trimmed lower-case values of a column, blanks dropped."""
    name = F.lower(X.strip(F.col(column)))
    return df.select(name.alias("domain")).where("domain <> ''").distinct()


def domain_list_csv(spark: SparkSession, path: str) -> DataFrame:
    return domain_column(spark.read.option("header", True).csv(path))


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case non-blank lines of a text file."""
    return domain_column(spark.read.text(path), "value").withColumnRenamed("domain", "line")


def safe_hosts(spark: SparkSession, path: str, suffixes: Iterable[str] | None = None) -> DataFrame:
    """Registrable domains of comma-separated URL lines."""
    lines = spark.read.text(path)
    return lines.select(F.explode(U.safe_line_domains(F.col("value"), suffixes)).alias("domain")).distinct()


MOST_RULES = 50_000


def suffix_rules(spark: SparkSession, path: str) -> list[str]:
    """Rules of a public-suffix file for the ``suffixes`` argument of the jobs: one a line,
    comments and blank lines dropped.  More than ``MOST_RULES`` are refused."""
    line = F.lower(F.regexp_extract("value", r"^\s*([^\s/][^\s]*)", 1))
    found = spark.read.text(path).select(line.alias("rule")).where("rule <> ''").distinct().limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} suffix rules")
    return sorted(r["rule"] for r in found)


def reputation_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """Reputation table, or None when the file or a needed column is missing."""
    try:
        found = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    if SC.missing_columns(found, SC.REPUTATION.names):
        return None
    values = {f.name: F.col(f.name).try_cast(f.dataType) for f in SC.REPUTATION}
    values["sources"] = F.coalesce(values["sources"], F.lit(""))
    return found.select(*[c.alias(name) for name, c in values.items()])


def site_list(reputation: DataFrame) -> DataFrame:
    """rank, domain in list order."""
    return ranked_sites(reputation)


def mail_requests_json(spark: SparkSession, path: str) -> DataFrame:
    """Mail records with optional keys; ``_corrupt`` holds lines that are no JSON objects."""
    schema = SC.T.StructType(SC.MAIL_REQUEST.fields + [SC.T.StructField("_corrupt", SC.T.StringType())])
    # the id may be missing: scoring makes row keys of its own
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").json(path))


def eml_files(spark: SparkSession, path: str) -> DataFrame:
    """path, subject, sender_email, body, parse_status of ``.eml`` files.

    MIME needs a parser, so this scan uses Python workers, one Arrow batch at a time.
    Files that fail there fall back to patterns on the raw text, in the JVM.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.eml").load(path).select("path", "content"))
    schema = ("path string, raw string, subject string, sender_email string, "
              "parts array<struct<html:boolean,text:string>>")

    def parse(batches):
        for pdf in batches:
            rows = [{"path": p} | mime.read_message(bytes(c)) for p, c in zip(pdf["path"], pdf["content"])]
            yield pd.DataFrame(rows, columns=["path", "raw", "subject", "sender_email", "parts"])

    parsed = files.mapInPandas(parse, schema)
    raw, ok = F.col("raw"), F.col("raw").isNull()
    subject = F.regexp_extract(raw, r"(?m)^Subject:[ \t]*(.*)$", 1)
    sender = F.regexp_extract(
        raw, r"(?im)^From:.*?([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}).*$", 1)
    texts = F.transform("parts", lambda p: F.when(p["html"], X.strip_html(p["text"])).otherwise(X.strip(p["text"])))
    return parsed.select(
        "path", X.strip(F.when(ok, F.col("subject")).otherwise(subject)).alias("subject"),
        F.when(ok, F.col("sender_email")).otherwise(sender).alias("sender_email"),
        F.when(ok, F.array_join(F.filter(texts, lambda t: t != ""), "\n\n"))
        .otherwise(X.plain_part(raw, F.lit(""))).alias("body"),
        F.when(ok, "parsed").otherwise("fallback").alias("parse_status"))
