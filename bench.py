"""Benchmark: the medallion over the driver's tables at one scale factor.

Replays two file deliveries (hours before 2024-01-18, then the rest) through
the stored pipeline -- streaming ingest, raw -> bronze stream, silver and
gold full builds, then one chained incremental refresh -- and times each
step; then times the headline registered queries with a no-op sink.

Prints one JSON line. env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickmart.plans import queries as Q  # noqa: E402
from clickmart.plans import refresh as R  # noqa: E402
from clickmart.session import build_session, scratch_path  # noqa: E402

HEADLINE = ["bronze", "devices", "all_events", "session_journey", "devices_merge",
            "all_events_incr", "session_journey_incr"]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(out: dict, name: str, fn):
    t0 = time.perf_counter()
    res = fn()
    out[name] = round(time.perf_counter() - t0, 3)
    return res


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="clickmart-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    # warm-up (JVM, code paths) on the smallest scale, not timed
    noop(Q.q_all_events(spark, "/root/testdata/sf0.001"))
    warm = scratch_path(spark, "bench-warm")
    Q._write_delivery(spark, "/root/testdata/sf0.001", f"{warm}/landing", 1)
    R.initial_build(spark, warm, f"{warm}/landing", Q.LOAD_TS_1)
    Q._write_delivery(spark, "/root/testdata/sf0.001", f"{warm}/landing", 2)
    R.run_increment(spark, warm, f"{warm}/landing", Q.LOAD_TS_2)

    root = scratch_path(spark, "bench")
    landing = f"{root}/landing"
    setup: dict[str, float] = {}
    steps: dict[str, float] = {}
    timed(setup, "deliver_1", lambda: Q._write_delivery(spark, sf_dir, landing, 1))
    timed(steps, "load_bronze_1", lambda: R.load_bronze(spark, root, landing, Q.LOAD_TS_1))
    timed(steps, "build_silver", lambda: R.build_silver(spark, root, Q.LOAD_TS_1))
    timed(steps, "build_gold", lambda: R.build_gold(spark, root))
    timed(setup, "deliver_2", lambda: Q._write_delivery(spark, sf_dir, landing, 2))
    timed(steps, "load_bronze_2", lambda: R.load_bronze(spark, root, landing, Q.LOAD_TS_2))
    timed(steps, "refresh_silver", lambda: R.refresh_silver(spark, root, Q.LOAD_TS_2))
    timed(steps, "refresh_gold", lambda: R.refresh_gold(spark, root))
    timed(steps, "refresh_noop", lambda: R.run_increment(spark, root, landing, Q.LOAD_TS_2))

    queries: dict[str, float] = {}
    for name in HEADLINE:
        noop(Q.QUERIES[name](spark, "/root/testdata/sf0.001"))  # warm-up, same plan shape
        timed(queries, name, lambda n=name: noop(Q.QUERIES[n](spark, sf_dir)))

    total = round(sum(steps.values()) + sum(queries.values()), 3)
    print(json.dumps({
        "metric": "medallion_pipeline_plus_queries_total",
        "value": total,
        "unit": "sec",
        "queries": {**{f"step_{k}": v for k, v in steps.items()}, **queries},
        "setup": setup,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
