"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then twice; the median of the timed runs is
reported.  Results go to the no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from captide.session import build_session  # noqa: E402
from captide.suite.queries import QUERIES  # noqa: E402

HEADLINE = (
    "collapse_phrases",
    "phrase_stats_by_lang",
    "clean_captions",
    "clean_pages",
    "transform_captions",
    "refresh_silver",
    "pending_transcripts",
    "classify_failures",
    "metadata_files",
    "snapshot_labels",
    "upsert_videos",
    "upsert_membership",
    "refresh_membership",
    "refresh_videos",
    "replace_silver",
    "artifact_audit",
    "validation_report",
    "gold_documents",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "captide-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
