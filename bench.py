"""Headline-query benchmark: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query result is
fully materialised with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "next_batch", "incremental_sync", "full_reconcile", "table_profile", "track_legs", "retention_delete",
    "port_calls", "nearest_port", "attribute_changes", "shard_batches", "count_drift", "port_event_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from tidemark.catalog import QUERIES
    from tidemark.session import local_session
    from tidemark.sources.tables import read_table

    spark = local_session(cores=cpus, partitions=int(cpus) * 2, app="tidemark-bench")
    events_rows = read_table(spark, sf_dir, "events").count()
    warm_failed: list[str] = []
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir:
        # JIT / codegen warm-up on the smallest data set; not timed
        for name in names:
            try:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception as exc:  # noqa: BLE001 - reported, and the run fails
                print(f"warm-up of {name} failed: {exc}", file=sys.stderr)
                warm_failed.append(name)
    timings, failures = {}, {f"warm-up {n}": "see stderr" for n in warm_failed}
    for name in names:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.time() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and continue
            failures[name] = f"{type(exc).__name__}: {exc}"[:300]
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sync_s = timings.get("incremental_sync")
    out = {
        "metric": "headline_queries_wall_time",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "events_rows": events_rows,
        "sync_rows_per_sec": round(events_rows / sync_s, 1) if sync_s else None,
        "baseline_rows_per_sec_per_node": {"steady": 5000, "catchup": 10000},
    }
    if failures:
        out["failures"] = failures
    print(json.dumps(out))
    spark.stop()
    if failures:
        sys.exit(1)


if __name__ == "__main__":
    main()
