"""Times the headline queries on local[$BENCH_CPUS] and prints one JSON line.

Every query is run to the end (all rows and columns are produced, into a sink
that discards them) after one untimed warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from amberline.catalog import QUERIES  # noqa: E402
from amberline.session import recommended  # noqa: E402

HEADLINE = ["region_summary", "rated_lines", "top_per_tier", "worst_lines", "score_profile", "first_of_key", "removed_rows",
            "range_rules_fixed", "imputed_medians", "median_filled_dates", "clean_accident_table", "dirty_profile",
            "label_codes", "codes_by_table", "index_by_data_maximum", "describe", "describe_by_narrowing", "value_shares",
            "stratified_split", "shuffled_folds", "block_folds", "large_sample", "class_weights", "scaled_columns",
            "class_report", "roc_auc_by_class", "model_metrics", "region_summary_by_class", "answers",
            "logistic_scores", "forest_scores", "boosted_scores", "scored_routes", "streamed_answers"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {**recommended(local_cores=int(cpus)), "spark.driver.memory": "16g"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
