"""Time the headline queries and model fits: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from creditmill.catalog import QUERIES
from creditmill.catalog.learned import frames
from creditmill.operators import models
from creditmill.session import builder

HEADLINE = [
    "default_rate_by_grade", "top20_states_by_default_rate", "portfolio_summary", "realized_loss_by_grade",
    "feature_pipeline", "risk_factors", "score_portfolio", "tier_summary", "null_profile", "rate_by_category",
    "box_stats", "pearson_matrix", "spearman_matrix", "validation_report", "impute_median", "scale_robust",
    "label_encode", "target_encode", "outliers_iqr", "preprocess", "stratified_split", "stratified_folds",
    "undersample", "roc_auc", "gain_lift", "model_comparison", "column_drift", "mutual_information",
    "business_explanation", "smote_neighbors",
]


def timed(action):
    start = time.time()
    action()
    return round(time.time() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (builder("bench").master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["default_rate_by_grade"](spark, sf_dir).collect()  # warm up the session
    times = {}
    for name in names:
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        train, _, used = frames(spark, sf_dir)
        train = train.persist()
        train.count()
        for name in models.SPECS:  # at full settings
            times[f"fit_{name}"] = timed(lambda: models.train(name, train, used))
            print(f"fit_{name} {times[f'fit_{name}']}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
