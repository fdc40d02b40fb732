"""Benchmark of the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 2) set the run.
Each query gets a warm-up, then the median of its timed runs counts. Results go to the ``noop`` sink: every column of
every row is computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnspark import catalog
from txnspark.session import get_session

HEADLINE = [
    "stg_02_03_staged_transactions",
    "dim_01_date",
    "dim_02_location",
    "dim_07_merchants",
    "fct_01_transactions",
    "fct_02_transactions",
    "fct_04_indicators",
    "view_01_fraud_analysis",
    "view_02_fraud_analysis",
    "view_03_ml_features",
    "win_02_avg_rows",
    "win_03_count_range",
    "win_04_lag",
    "agg_05_having",
    "agg_08_deduplicate",
    "agg_09_pivot",
    "set_02_union_relations",
    "set_04_unpivot",
    "gen_02_date_spine",
    "fn_13_14_15_urls",
    "fn_16_surrogate_key",
    "fn_20_haversine",
    "qc_05_equality",
    "qc_08_mutually_exclusive_ranges",
    "qc_14_relationships_where",
    "qc_15_sequential_days",
    "qc_16_unique_combination",
    "qc_26_contract_violations",
    "dash_01_daily_transactions",
    "dash_02_fraud",
    "dash_03_indicators",
    "ml_01_training_set",
    "ml_03_smote_counts",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "txnspark-bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_driver_host="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.registered()
    times = {}
    for name in HEADLINE:

        def once(fn=queries[name]):
            start = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
