"""Time the headline queries: BENCH_SF_DIR and BENCH_CPUS choose data and cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from abacist.queries import QUERIES  # noqa: E402
from abacist.session import local_session  # noqa: E402

HEADLINE = [
    "supplier_yoy", "action_pivot", "ad_kpi_fact", "kpi_apportioned", "channel_rollup", "market_union", "report_flatten",
    "rolling_reload", "fanout_avg", "remerge_sum", "in_semi", "intersect_keys", "freq_table", "unique_profile",
    "describe_profile", "running_total_skip", "running_total_one_group", "driver_basetable", "rfm_basetable",
    "donor_basetable", "median_impute", "winsorize_04", "stratified_split", "freq_encode", "interpolate", "ma_forecast",
    "kaplan_meier", "logrank_stat", "cox_tv", "woe_categorical", "woe_monotone", "woe_transform", "auc_rank", "lift_table",
    "model_lr", "model_dt", "nearest_vectors",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="abacist-bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["supplier_yoy"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        if runs > 1:
            timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
