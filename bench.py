"""Benchmark of the headline queries.

Runs each query in ``HEADLINE`` on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]``: ``$BENCH_WARMUP`` (2) untimed passes over all
queries, then ``$BENCH_REPEATS`` (3) timed runs per query; a query's time is
its fastest run (``median`` has the middle one), from building the DataFrame to
the end of a full execution into the no-op sink. Prints one JSON line whose
``value`` is the flagship query (the sales cube) and ``total_sec`` the sum.
``BENCH_EVENT_LOG=<dir>`` writes Spark's event log there for
``tools/stage_times.py``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans.registry import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402

HEADLINE = [
    "sales_cube",
    "top10_receipt_cur",
    "top10_amount_cur",
    "top10_amount_prev",
    "top10_receipt_prev",
    "top10_stored_receipt_cur",
    "top10_stored_amount_prev",
    "dashboard_region",
    "dashboard_period",
    "row_counts_report",
    "load_contract_warehouse",
    "pk_violations",
    "sales_cube_part_grain",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus,
                          event_log=os.environ.get("BENCH_EVENT_LOG"))
    failed = {}
    for _ in range(warmup):  # JIT and generated-code warm-up, untimed
        for name in names:
            if name in failed:
                continue
            try:
                run_once(spark, name, sf_dir)
            except Exception as e:  # keep timing the others; report the failure
                failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    times = {name: sorted(run_once(spark, name, sf_dir) for _ in range(repeats))
             for name in names if name not in failed}
    best = {name: t[0] for name, t in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    flagship = "sales_cube" if "sales_cube" in best else next(iter(best), names[0])
    print(json.dumps({
        "metric": f"{flagship}_warm",
        "value": round(best[flagship], 3) if flagship in best else None,
        "unit": "sec",
        "total_sec": round(sum(best.values()), 3),
        "queries": {k: round(v, 3) for k, v in best.items()},
        "median": {k: round(t[len(t) // 2], 3) for k, t in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
