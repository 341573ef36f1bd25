"""Scoring a stream of JSON mails with the batch job, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mailtriage import schemas as SC
from mailtriage.plans.score import split_requests
from mailtriage.session import staged_table, staging_scope


def mail_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """JSON mails from a folder; ``_corrupt`` holds lines that are no JSON objects."""
    schema = SC.T.StructType(SC.MAIL_REQUEST.fields + [SC.T.StructField("_corrupt", SC.T.StringType())])
    return (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt")
            .option("maxFilesPerTrigger", max_files).json(path))


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, dead_letters: str,
                 checkpoint: str, key: str = "id", trigger: dict | None = None) -> StreamingQuery:
    """Write verdicts and error records of every micro-batch; ids may be missing.

    A batch is read once, into a staged table; what it stages is deleted when it is
    written.  ``trigger`` takes the arguments of ``DataStreamWriter.trigger`` (default: all
    that is there, once).

    ``score`` is the batch job, so stream and batch share one code path.  Each batch writes
    to a folder of its own number and replaces it when it is repeated after a failure.
    """
    def handle(batch: DataFrame, number: int) -> None:
        with staging_scope(batch.sparkSession, f"batch-{number}"):
            good, bad = split_requests(staged_table(batch, "requests"), key)
            score(good).write.mode("overwrite").parquet(f"{out}/batch={number}")
            bad.write.mode("overwrite").json(f"{dead_letters}/batch={number}")

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
