"""Headline queries on local cores; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query is written to a no-op sink once to warm up and then BENCH_RUNS times (default 3); the median
counts.  Tables a query stages are part of its time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fieldbook.session import build_session
from fieldbook.workbook.queries import registered

HEADLINE = (
    "history_all", "make_history", "lapse", "r3", "rank_sale", "participants_county", "churn_agecat", "scaleup_sex",
    "calc_metrics", "dashboard_all", "fill_missing_months", "month_recruits", "sale_group", "prep_pop",
    "hist_samp", "trend_sex_age", "cust_sample", "check_foreign_keys", "check_allowed_values",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        **({} if os.environ.get("BENCH_SHARED_DIR") is None else {"spark__checkpoint__dir": os.environ["BENCH_SHARED_DIR"]}),
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry, seconds = registered(), {}
    for name in names or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
