"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   data folder   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores   (default: all)

Each query is planned, run and written to the no-op sink once, after one untimed
pass over the flagship query that starts the JVM and warms its compiler.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks import queries
from tidewater.session import build_session

HEADLINE = (
    "date_dim",
    "cdc_decode",
    "cdc_latest_state",
    "raw_land_and_scan",
    "stream_ingest",
    "silver_clean",
    "sql_transformer_partitions",
    "upsert_global",
    "upsert_partition_scoped",
    "upsert_composite_key",
    "hard_delete",
    "incremental_read",
    "as_of_savepoint",
    "clustered_snapshot",
    "earnings_batch",
    "earnings_sum_tips",
    "earnings_incremental",
    "earnings_incremental_reference",
    "gold_driver_month_year",
    "gold_driver_year",
    "gold_tips_by_driver",
    "gold_top5_tips",
    "gold_rides_month_year",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries.registered()
    run(known["gold_driver_month_year"], spark, sf_dir)
    seconds = {name: round(run(known[name], spark, sf_dir), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
