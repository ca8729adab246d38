"""Times the headline queries and prints one JSON line.

Each query is written to Spark's no-op sink, so every row and column is computed and nothing is
collected. The value is the sum over queries of the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_incremental",
    "latest_per_key",
    "snapshot_scd1",
    "snapshot_scd2",
    "cdc_scd1",
    "cdc_scd2",
    "cdc_track_columns",
    "change_feed_read",
    "incremental_mv",
    "quality_metrics",
    "quarantine_batch",
    "recon_key_hash",
    "dim_customer",
    "fact_order_line",
    "daily_metrics",
    "sales_summary_month",
    "join_temporal",
    "scd_fact_asof",
    "ops_usage_priced",
    "agg_percentile",
    "win_rolling_stats",
    "st_session",
    "st_tumbling",
    "join_stream_stream",
    "profile_columns_approx",
    "profile_value_counts",
    "metric_query",
    "vec_topk",
    "vec_keyword",
    "ops_lineage_chain",
]


def main() -> None:
    from laminae.plans import catalog
    from laminae.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="laminae-bench-", dir="/tmp")
    spark = build_session(
        "laminae-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    timings: dict[str, float] = {}
    for name in chosen:
        taken = []
        for i in range(runs + 1):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - began)
        timings[name] = round(statistics.median(taken), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
