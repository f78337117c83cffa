"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (sum of per-query medians, sec),
"unit", "queries": {name: median sec}, "sf"}.  Each query runs once to warm
up, then $BENCH_REPS times (default 3); the result is fully materialised with
a no-op sink so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "negative_tokens",
    "sentence_extract",
    "exact_match",
    "near_match",
    "language_pivot",
    "memory_lookup",
    "paragraph_assemble",
    "html_lines",
]

SPREAD = ("documents", "lineitem", "pages", "conversations")


def spread_copy(spark, sf_dir: str, parts: int) -> str:
    """The tables as a cluster would hold them: the test files have one row group
    each, which one task reads, so the bench (not the library) deals the larger
    ones over ``parts`` files, outside the timed runs."""
    out = tempfile.mkdtemp(prefix="sentforge-bench-")
    for f in sorted(os.listdir(sf_dir)):
        name = f.removesuffix(".parquet")
        src, dst = os.path.join(sf_dir, f), os.path.join(out, f)
        if name in SPREAD:
            spark.read.parquet(src).repartition(parts).write.parquet(dst)
        else:
            os.symlink(src, dst)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    cpus = cpus if cpus.isdigit() else str(os.cpu_count() or 8)
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from sentforge.plans.registry import QUERIES
    from sentforge.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="sentforge-bench")
    data = spread_copy(spark, sf_dir, int(cpus) * 2)
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        build = QUERIES[name]

        def run() -> float:
            spark.catalog.clearCache()  # no reuse of persisted inputs across runs
            t0 = time.perf_counter()
            build(spark, data).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            warm = run()
            times[name] = round(statistics.median(run() for _ in range(reps)), 3)
        except Exception as e:  # noqa: BLE001 - report, keep the other queries
            print(f"[bench] {name} FAILED: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr, flush=True)
            times[name] = None
            continue
        print(f"[bench] {name}: warm-up {warm:.2f}s, median {times[name]:.2f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_query_seconds_sum",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
