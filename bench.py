"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Lazy queries are run to completion without a sink; jobs (silver_job, gold_job, upsert) write
their tables. The Bronze CSV files the Silver job starts from are written before the
clock starts. Every entry is the better of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakemart.plans import gold, silver  # noqa: E402
from lakemart.session import build_session, work_path  # noqa: E402
from workload import batches, checks, marts, roles, rows  # noqa: E402

LAZY = {
    **marts.QUERIES,
    "latest_state_dedup": rows.latest_state_dedup,
    "fk_chain_reason": rows.fk_chain_reason,
    "fanout_factor": rows.fanout_factor,
    "late_event_restatement": batches.late_event_restatement,
    "quality_report": checks.quality_report,
    "control_totals": checks.control_totals,
    "frequency_profile": checks.frequency_profile,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "lakemart-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = work_path(spark, "bench")
    arrived = 0
    for name, df in roles.raw(spark, sf_dir).items():
        df.repartition(int(cpus)).write.option("header", True).csv(f"{lake}/bronze/{name}")
        arrived += df.count()

    def timed(job) -> float:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            job()
            best = min(best, time.perf_counter() - start)
        return round(best, 3)

    seconds = {
        "silver_job": timed(lambda: silver.run_silver(spark, lake)),
        "gold_job": timed(lambda: gold.run_gold(spark, lake)),
        "upsert": timed(lambda: batches.upsert(spark, sf_dir).count()),
    }
    for name, query in LAZY.items():
        seconds[name] = timed(
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    result = {
        "metric": "total seconds over all headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "bronze_rows": arrived,
        "silver_rows_per_second": round(arrived / seconds["silver_job"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
