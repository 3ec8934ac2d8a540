"""Benchmark: wall time of the headline catalogue queries.

Runs each query to completion with the no-op sink (full execution, nothing
collected to the driver) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and
prints one JSON line.  The value is the sum of per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "innings_summary_analog", "order_points_table", "day_slot_assignment", "json_nested_explode",
    "document_header", "top2_per_group", "pivot_top2", "venue_lookup", "schedule_enriched",
    "hourly_lookup", "incremental_ingest", "customer_order_summary", "json_scalar", "dq_unique",
]


def main() -> None:
    from matchlake.plans.catalogue import QUERIES
    from matchlake.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", app="matchlake-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    # warm-up: JVM, class loading, parquet footers
    QUERIES["top2_per_group"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    per_query: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        times = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
            per_query[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            per_query[name] = None
            errors[name] = str(e).splitlines()[0][:300]
    sf = os.path.basename(sf_dir).replace("sf", "")
    total = round(sum(v for v in per_query.values() if v is not None), 3)
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec", "queries": per_query,
           "sf": sf, "cpus": cpus, "runs": runs, "spark": spark.version}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
