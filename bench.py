"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs
twice over its whole tables, with every column written to the noop sink; the second time counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brightledger.plans.catalog import REGISTRY  # noqa: E402
from brightledger.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "agg_monthly",
    "agg_quarter_stats",
    "join_multi_table",
    "join_exists",
    "win_topk_qualify",
    "win_dedup_latest",
    "win_zscore_centered",
    "gold_customer_metrics",
    "gold_fact_sales",
    "gold_agg_daily_sales",
    "json_report",
    "dq_order_rules",
    "dq_ref_integrity",
    "cdc_net_changes",
    "scd2_merge",
    "src_csv_typed",
    "surrogate_key",
    "ts_forecast",
    "ts_anomaly",
    "ml_top_insights",
    "text_sentiment",
    "text_summarize",
    "text_extract_answer",
    "text_classify",
    "stream_hourly_rollup",
    "incr_monthly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="bench", shared=tempfile.mkdtemp(prefix="bench-"))
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
