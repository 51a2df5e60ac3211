"""Times the headline queries; prints one JSON line.

`$BENCH_SF_DIR` is the folder of tables, `$BENCH_CPUS` the number of cores. Each query is run as a
whole, its result handed to Spark's noop sink; the time is the better of two runs.
"""

from __future__ import annotations

import json
import os
import re
import time

from textflow.plans.queries import QUERIES
from textflow.session import local_session
from textflow.sources.tables import INPUT_TASKS

HEADLINES = (
    "intake_first_wins",
    "intake_status",
    "preprocess",
    "tokens_no_stop",
    "total_words",
    "word_count",
    "sentiment",
    "entity_names",
    "entity_links",
    "token_tags_json",
    "fitted_model_tokens",
    "fitted_model_quality",
    "side_by_side_enrichers",
    "merged_predictions",
    "prediction_bodies",
    "enriched_view",
    "agreement",
    "stream_dispatch",
    "stream_enrich",
    "stream_merge",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "textflow-bench")
    # The tables are single files of few splits.
    spark.conf.set(INPUT_TASKS, str(2 * int(cpus)))
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    for name in HEADLINES:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "documents": documents,
        "documents_per_second": {n: round(documents / s) for n, s in seconds.items()},
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
