"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailtriage.operators.domains import legitimate
from mailtriage.operators.links import safe_url_lines


def write_mails(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raw or cleaned corpus; CSV keeps a header and quoted line breaks."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_reputation(table: DataFrame, full_path: str, legitimate_path: str, threshold: int = 70) -> None:
    """Full table first; its legitimate part is read back from what was written."""
    table.write.mode("overwrite").parquet(full_path)
    saved = table.sparkSession.read.schema(table.schema).parquet(full_path)
    legitimate(saved, threshold).write.mode("overwrite").parquet(legitimate_path)


def write_safe_urls(mails: DataFrame, path: str) -> None:
    safe_url_lines(mails).write.mode("overwrite").text(path)


def as_json(df: DataFrame, key: str) -> DataFrame:
    """key and the whole row as one JSON text."""
    return df.select(key, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
