"""Scoring a table of mails with a model, dimension tables and an output path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import features as FE
from mailtriage.functions.literals import mapping
from mailtriage.operators import lexicon, scoring as S
from mailtriage.plans import train as TR


def scored(mails: DataFrame, fitted: TR.TrainedModel, trusted: DataFrame, safe: DataFrame,
           reputation: DataFrame | None, key: str = "id", suffixes: Iterable[str] | None = None,
           small: bool = False, **options) -> DataFrame:
    """Verdict per mail with the model's probability, indicators, threshold and metrics.

    The model is applied row by row and its output goes straight into the narrow signal
    table, so mail texts are not shuffled.
    """
    threshold = float(fitted.metrics.get("threshold", K.MODEL_THRESHOLD))
    verdicts = S.score_mails(TR.annotate(fitted, mails), trusted, safe, reputation, key=key, suffixes=suffixes, small=small,
                             carry=["model_indicators"], threshold=threshold, **options)
    none = F.array().cast(verdicts.schema["model_indicators"].dataType)
    shown = F.when(F.col("model_confidence") > 0, F.coalesce("model_indicators", none)).otherwise(none)
    figures = {k: float(v) for k, v in fitted.metrics.items() if isinstance(v, (int, float))}
    return verdicts.withColumns({
        "model_indicators": shown, "model_threshold": F.lit(threshold), "model_metrics": mapping(figures),
        **{f"model_{k}" if k != "model_name" else k: F.lit(v)
           for k, v in fitted.metrics.items() if k in ("model_name", "trained_at")}})


def with_highlights(verdicts: DataFrame, mails: DataFrame, key: str = "id") -> DataFrame:
    """Add highlighted subject and body.  This joins whole texts; leave it out where
    verdicts are enough."""
    texts = S.mail_requests(mails, key).select(key, "subject", "body")
    marked = lexicon.highlighted(texts.join(verdicts.select(key, "matched"), key))
    return verdicts.join(marked.select(key, "subject_highlighted", "body_highlighted"), key)


def split_requests(requests: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Mails that can be scored, and error records for lines that are no JSON."""
    good = requests.where(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = requests.where(F.col("_corrupt").isNotNull())
    return good, S.error_record(bad.select(key, "_corrupt"), F.concat(F.lit("not a JSON object: "), "_corrupt"))


def rejected(requests: DataFrame) -> DataFrame:
    """Requests without subject, body and URL."""
    return requests.where(~FE.admissible(requests))
