"""Time the headline queries: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). The first query builds the
shared stage tables (lead base, feature table) and pays for them; the training, scoring and monitoring
queries read them, as the steps of a daily run do. ``daily_scoring`` and the two feature tables are built
from the source tables. Results go to the noop sink.
"""

from __future__ import annotations

import json
import os
import time

from leadwright.plans import catalog
from leadwright.session import build_session

HEADLINE = [
    "features_scan", "daily_scoring", "final_feature_table", "final_feature_table_reference", "stage_lead_base",
    "stage_append_logs", "asof_visit_cf", "asof_visit_hz", "shortview_features", "events_before_alloc",
    "follow_tags_asof", "call_sequence", "label_base", "subscribe_flags_daily", "woe_table", "woe_apply",
    "woe_auto_bins", "l1_fit", "rank_leads", "roc_curve", "auc", "decile_table", "decile_table_approx",
    "weekly_performance", "psi_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["subscribe_flags_daily"](spark, sf_dir).count()  # start the executor threads
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
