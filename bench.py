"""Seconds per registered query: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.  Prints one JSON line.

The tables all queries share are built first, under their own names, so that no query pays for them.
"""

from __future__ import annotations

import json
import os
import sys
import time

import driver_queries
import driver_tables
from pactlens.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    seconds: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{seconds[name]:8.2f}s {name}", file=sys.stderr, flush=True)

    timed("contracts_table", lambda: driver_tables.contracts(spark, sf_dir))
    timed("features_table", lambda: driver_tables.features(spark, sf_dir))
    for name, query in driver_queries.QUERIES.items():
        timed(name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
