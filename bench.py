"""Wall-clock of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import time

import catalog
from highmark.session import build_session

HEADLINE = [
    "clean_daily",
    "resolve_observations",
    "hourly_daily_extremes",
    "record_events",
    "record_events_dense",
    "station_coverage",
    "coverage_gaps",
    "records_by_month_group",
    "stations_by_month_group",
    "top_by_month_max",
    "recent_records",
    "station_summary",
    "station_documents",
    "stats_document",
    "rankings_document",
    "merge_provisional",
    "parse_daily_summary",
    "daily_cycle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().count()
    queries = catalog.queries()
    # one pass that is not counted, on the smallest data: code is compiled, workers are up
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(warm) else []:
        queries[name](spark, warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
