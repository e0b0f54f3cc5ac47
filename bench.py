"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is built and run to the end
(its rows go to Spark's no-op sink) once after a warm-up scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wardloom.plans.queries import QUERIES
from wardloom.session import build_session

HEADLINE = (
    "distinct_devices",
    "distinct_users",
    "surrogate_key",
    "records_newline",
    "records_literal_delim",
    "corpus_index",
    "random_text_assign",
    "sentiment_score",
    "notes_admission",
    "doctor_notes",
    "append_insert",
    "upsert_single_key",
    "upsert_composite_key",
    "load_devices",
    "load_watch_facts",
    "load_users",
    "load_renewal_history",
    "load_provider",
    "incremental_scan",
    "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_customers"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
