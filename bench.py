"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the tables and the cores. Each query runs once to warm up; the time given is
the median of BENCH_RUNS (default 3) further runs, planning included. Results go
to Spark's ``noop`` sink, so that all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gates import QUERIES
from tablewright import build_session

HEADLINE = {
    "sales_transform": "m1_sales_transform",
    "sales_output": "m2_sales_output",
    "artworks_transform": "m3_artworks_transform",
    "artworks_transform_distributed": "m3_artworks_transform_distributed",
    "artworks_by_tier": "m6_artworks_by_tier",
    "contract": "q12_contract_runner",
    "validation_report": "q4_validation_report",
    "rank": "w2_rank_all_rows",
    "rank_distributed": "w2_rank_all_rows_distributed",
    "group_measures": "w6_group_measures",
    "running_total": "w7_running_total",
    "group_by": "a1_group_by",
    "join_chain": "j7_join_chain",
    "table_diff": "u2_table_diff",
    "title_case": "e2_title_case",
    "strip": "e3_strip",
    "search_documents": "x1_search_documents",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for label, name in HEADLINE.items():
        once(name)
        times[label] = round(statistics.median(once(name) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
