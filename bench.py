"""Time the headline queries. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query name ...]

Each query is computed in full (every row and column, nothing kept). A short warm-up on the smallest
tables starts the JVM and the Python workers, so that it is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from commentlens import plans
from commentlens.session import local_session

HEADLINE = [
    "cleaned_label_distribution",
    "clean_html_text",
    "clean_raw",
    "raw_clean_report",
    "validate_and_clean",
    "quality_report",
    "dedup_exact",
    "merge_batches",
    "json_text",
    "resume_anti_join",
    "distinctive_words",
    "topk_words",
    "keyword_overlap_match",
    "monthly_trend",
    "sentiment_summary",
    "classification_metrics",
    "history_trim",
    "chat_contents",
    "stratified_split",
    "tfidf_vocab",
    "tfidf_weights",
    "train_multinomial_nb",
    "train_logreg",
    "train_linear_svm",
    "compare_models",
    "predict_batch",
    "label_batch",
    "label_backlog",
    "stream_ingest_dedup",
    "stream_trend",
    "stream_label_resume",
]
WARM_UP = ["clean_html_text", "topk_words"]


def run(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    plans.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    for name in WARM_UP:
        run(spark, small if os.path.isdir(small) else sf, name)
    seconds = {name: round(run(spark, sf, name), 3) for name in sys.argv[1:] or HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
