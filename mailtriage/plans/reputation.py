"""Reputation tables and list files from a labelled corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from mailtriage.operators.domains import reputation
from mailtriage.sources.sinks import write_reputation, write_safe_urls


def run(mails: DataFrame, out: str, suffixes: Iterable[str] | None = None, threshold: int = 70) -> None:
    """Write ``domain_analysis``, ``legitimate_domains`` and ``safe_urls`` below ``out``."""
    write_reputation(reputation(mails, suffixes), f"{out}/domain_analysis", f"{out}/legitimate_domains", threshold)
    write_safe_urls(mails, f"{out}/safe_urls")
