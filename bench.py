"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from labelloom.catalog import QUERIES
from labelloom.session import build_session

HEADLINE = (
    "tag_histogram",
    "neighbouring_tags",
    "html_prose_and_code",
    "tag_samples",
    "term_counts",
    "tfidf",
    "hashed_features",
    "keyword_scores",
    "bernoulli_fold_scores",
    "multinomial_fold_scores",
    "suggest_tags",
    "document_f1",
    "pca_features",
    "tag_cooccurrence",
    "survey_linear_svc",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "labelloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["tag_histogram"](spark, folder).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
