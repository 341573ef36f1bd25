"""Headline queries on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.queries import REGISTRY
from mailtriage.session import local_session

HEADLINE = [
    "domain_reputation", "sender_reputation", "lexicon_scores", "numeric_features", "link_assessment", "nearest_sites",
    "close_page_hosts", "cleaned_corpus", "distinct_messages", "html_text", "term_frequencies", "stratified_split",
    "roc_auc", "risk_verdicts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    REGISTRY["label_distribution"][0](spark, sf_dir).collect()  # starts the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
