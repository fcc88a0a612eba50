"""Time the headline queries: prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS] (default: all cores).
Every query runs to completion into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.legs import PERIODS, ROLES, legs
from checks.queries import REGISTERED, RATE, _scaled, FEATURES
from latemark.plans import TreeConfig, run_trees
from latemark.training.descent import RowBlocks

HEADLINES = [
    "clean_legs", "cleaning_report", "delay_rates_one_scan", "group_medians", "frequency_encode_test",
    "target_mean_encode", "target_mean_encode_shuffled", "hash_split", "stratified_split",
    "roc_auc_exact", "roc_auc_fine_scores", "gd_weights_weighted", "descent_job", "onehot_job", "gbt_scores",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def iteration_seconds(spark: SparkSession, sf_dir: str, rounds: int = 20) -> float:
    """Seconds of one gradient-descent iteration once rows are packed."""
    train, _ = _scaled(spark, sf_dir)
    with RowBlocks(train, FEATURES, "label") as blocks:
        weights, bias = [0.0] * len(FEATURES), 0.0

        def descend(count: int) -> None:
            nonlocal weights, bias
            for _ in range(count):
                *slopes, slope = blocks.gradient_sums(weights, bias)
                weights = [w - RATE * s / blocks.rows for w, s in zip(weights, slopes)]
                bias -= RATE * slope / blocks.rows

        descend(3)
        return round(seconds(lambda: descend(rounds)) / rounds, 4)


def like_for_like(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if not os.path.isdir(small):
        return {}
    config = TreeConfig(roles=ROLES, periods=PERIODS, rounds=50, depth=6, positive_weight=None, patience=50)
    rows = legs(spark, small)

    def trees() -> None:
        run = run_trees(spark, config, rows)
        run.scored.write.format("noop").mode("overwrite").save()
        run.discard(spark)

    def onehot() -> None:
        REGISTERED["logit_scores"](spark, small).write.format("noop").mode("overwrite").save()

    return {
        "sf0.01_gd_iteration": iteration_seconds(spark, small), "sf0.01_onehot_fit_score": seconds(onehot),
        "sf0.01_trees_50_depth_6": seconds(trees),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("latemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINES if not sys.argv[1:] or n in sys.argv[1:]]
    REGISTERED["label_counts"](spark, sf_dir).collect()  # start-up of the JVM is not measured

    def run(name: str) -> float:
        return seconds(lambda: REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    times = {name: run(name) for name in names}
    total = round(sum(times.values()), 3)
    if not sys.argv[1:]:
        times["gd_iteration"] = iteration_seconds(spark, sf_dir)
        times |= like_for_like(spark, sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
