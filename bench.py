"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5, after one warm-up pass over all queries).  Each query is executed to the end
with the ``noop`` sink (every row computed, nothing collected to the driver);
the reported time per query is the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["cdc_replay", "as_of_timestamp", "snapshot_upsert", "merchant_totals",
            "stream_cdc_apply", "cdc_merge", "latest_per_key", "snapshot_diff",
            "quality_report", "gold_daily"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from changeledger.plans.registry import QUERIES
    from changeledger.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": "16g"})
    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times, errors = {}, {}
    for name in HEADLINE:              # one warm-up pass over everything (JIT, caches, listing)
        try:
            run(name)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    for name in HEADLINE:
        if name in errors:
            continue
        try:
            times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        except Exception as exc:  # noqa: BLE001
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": cpus, "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
