"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line.

Each query runs to completion through the ``noop`` sink (every row is produced, nothing is
collected). One untimed warm-up query compiles the common code paths first. Set
``BENCH_QUERIES=all`` to time every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "taxonomy_topk",        # flagship: parse -> lookup -> classify -> unpivot -> aggregate -> rank
    "parse_submissions",
    "classify_answer",
    "lookup_join",
    "state_counts",
    "progress_summary",
    "taxonomy_report",
    "html_summary",
    "bitmap_encode",
    "bitmap_membership",
    "shard_assignment",
    "number_rows",
    "merge_release",
    "daily_status",
    "recent_events",
    "backoff_spans",
    "stream_annotate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from labelsmith.session import local_session
    from labelsmith.plans.registry import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus)), app="labelsmith-bench")
    names = list(QUERIES) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("state_counts")  # warm-up, not timed
    timings = {}
    for name in names:
        timings[name] = round(run(name), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
