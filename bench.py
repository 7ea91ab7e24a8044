"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink (every column and
row computed, nothing collected).  JVM start and one warm-up query are not
timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import registry as R  # noqa: E402
from quarry.session import get_spark  # noqa: E402

HEADLINE = [
    "extract_pages",
    "match_query",
    "simple_search",
    "multi_match",
    "match_phrase",
    "one_phrase_search",
    "multi_phrase_search",
    "wildcard_search",
    "site_search",
    "document_search",
    "highlight",
    "pagerank",
    "history_fold",
    "suggest",
    "personal_rerank",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * cpus))))
    spark = get_spark(cores=cpus, shuffle_partitions=parts, app="quarry-bench")
    # warm-up (JIT, Python workers); not timed
    R.QUERIES["history_fold"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        R.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
