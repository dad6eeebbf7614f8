"""Time the headline queries and print one JSON line.

Queries get one warm-up and the median of three runs; whole pipelines, which come last, one warm-up and one
run. Inputs are prepared inside the timer: the fixture's joins, its shuffle by key at every size, and
where a query reads a topic, its encoding. Round 1 took means of two runs, and pipelines cold.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contract.queries import QUERIES  # noqa: E402
from ingotflow.session import create_session  # noqa: E402

HEADLINE = [
    "gold_daily_revenue",
    "gold_order_status_summary",
    "gold_top_products",
    "silver_dedup_latest",
    "silver_merge_join",
    "record_decode",
    "silver_first_write",
    "silver_merge_upsert",
    "stream_to_bronze",
    "pipeline_file",
    "pipeline_stream",
]
WARM_UPS, RUNS = 1, 3


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        n_runs = 1 if name.startswith("pipeline") else RUNS
        runs = [timed(spark, name, sf_dir) for _ in range(WARM_UPS + n_runs)]
        seconds[name] = round(statistics.median(runs[WARM_UPS:]), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
