"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and run to completion through the ``noop`` sink (all
rows produced, nothing collected), once to warm up and then ``BENCH_RUNS``
times; the median wall time is reported.  ``value`` is the sum of medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docindex.plans.catalog import QUERIES  # noqa: E402
from docindex.session import local_session  # noqa: E402

# The headline queries (one per inventory group).
HEADLINE = [
    "scan_sum",
    "flatten_hits",
    "query_range",
    "query_range_date",
    "query_match",
    "query_match_phrase",
    "query_bool",
    "query_min_should",
    "query_nested",
    "query_wildcard",
    "score_bm25",
    "score_bool",
    "bulk_update",
    "bulk_mixed",
    "bulk_actions",
    "hits_json_roundtrip",
    "types_dates",
    "map_document_batches",
    "write_roundtrip",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus)
    out: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
