"""Times the headline queries and prints one line of JSON.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the number of timed runs per query (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from workload.check import local_session
from workload.queries import QUERIES

HEADLINE = [
    "transform_job",
    "clean_html",
    "normalize_html",
    "result_records",
    "new_records",
    "first_wins",
    "file_index",
    "group_members",
    "parent_child",
    "hash_audit",
    "records_with_content",
    "ingest_attach",
    "pagination_chain",
    "ingest_job",
    "stream_ingest",
    "before_after",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("clean_html")  # starts the Python workers
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
