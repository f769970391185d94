"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 5; the median counts);
              a query is not timed again once its runs took LONG seconds
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from claimworks.queries import QUERIES
from claimworks.session import build_session

HEADLINE = (
    "gold_telematics_avg", "gold_star_join", "gold_enriched", "silver_policy", "silver_claim",
    "silver_customer", "silver_telematics", "silver_speed_impute", "silver_metadata",
    "cdc_parse_envelope", "cdc_net_changes", "cdc_apply_log", "cdc_merge_ops", "silver_upsert",
    "insert_if_absent", "dedupe_composite", "clean_claims", "check_unique", "check_foreign_key",
    "geocode_udf", "json_map_project", "topic_encode_json", "image_features", "split_lines",
    "train_metrics", "stream_json_map_append", "stream_cdc_apply", "stream_silver_upsert",
    "medallion_run",
)


LONG = 6.0


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        taken = []
        while len(taken) < runs and sum(taken) < LONG:
            taken.append(run(spark, name, sf_dir))
        times[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
