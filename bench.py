"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times for its median; results go to
the noop sink, so all rows and columns are produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from folioworks.plans.catalog import QUERIES
from folioworks.session import build_session

HEADLINE = [
    "token_count",
    "exact_dedup",
    "probe",
    "source_select",
    "paragraph_weld",
    "page_labels",
    "strip_headers",
    "drop_boiler",
    "clean_chain",
    "bundle",
    "language_tag",
    "md_cells",
    "html_tables",
    "clean_tables",
    "best_table",
    "engine_cascade",
    "ingest_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {}
    for name in names:
        took = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": seconds,
             "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
