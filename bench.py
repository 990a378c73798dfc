"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads. Each
query is run once to warm up and then timed; the result goes to a sink that
computes every row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from tabkit.queries import QUERIES
from tabkit.session import build_session

HEADLINE = (
    "clean_trips",
    "clean_observations",
    "error_counts",
    "missing_pct_guarded",
    "max_quantiles",
    "global_quantiles",
    "exceeding_rows",
    "group_means",
    "impute_train",
    "impute_window",
    "standardise",
    "normalise_pop",
    "exact_split",
    "prepare_observations",
    "regression_metrics",
    "mlp_forward",
    "ridge_cv",
    "gbt_fit",
    "mlp_train",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "tabkit-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "tabkit headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
