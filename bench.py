"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line. Each query is materialised with the ``noop`` sink (every
row computed, nothing collected) and timed as the best of $BENCH_REPEAT runs.
The ledger dump (orders -> fixed-width EBCDIC/COMP-3 records) is the queries'
input; writing it is timed apart and isn't part of the total.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["gold_product", "hub_customer", "sat_account_state", "vault_join", "dlq_semantic", "kpi_report",
            "adjudicated", "rationale_by_label", "score_requests", "medallion_run"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from ledgerflow.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="ledgerflow-bench",
                          conf={"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerflow.plans.bridge import CORRUPT_EVERY
    from ledgerflow.plans.catalog import QUERIES
    from ledgerflow.plans.dumps import ledger_dump_path

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    timings: dict[str, float] = {}
    from ledgerflow.plans.bridge import orders_to_records
    from ledgerflow.session import scratch_path
    from ledgerflow.sinks.tables import write_fixed

    best = None
    for _ in range(repeat):  # orders -> 35-byte records -> fixed-width part files
        t = time.perf_counter()
        write_fixed(orders_to_records(spark.read.parquet(f"{sf_dir}/orders.parquet")), scratch_path(spark, "bench-dump"))
        elapsed = time.perf_counter() - t
        best = elapsed if best is None else min(best, elapsed)
    timings["bridge_dump"] = best
    ledger_dump_path(spark, sf_dir)
    ledger_dump_path(spark, sf_dir, CORRUPT_EVERY)

    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    dump = round(timings.pop("bridge_dump"), 3)  # writes the fixture, no headline query
    total = round(sum(timings.values()), 3)
    per_stage = {k: round(orders / v) for k, v in timings.items() if v > 0}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "fixture_dump_sec": dump,
        "records": orders,
        "records_per_sec": per_stage,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "hardware": f"{platform.machine()} {os.cpu_count()} cpus, local[{cpus}]",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
