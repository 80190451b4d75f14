"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores. Each query's whole result is
computed and thrown away by the no-op sink. Queries run once after a warm-up of
the session and the Python workers; BENCH_RUNS repeats them and takes the median.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskcheck import QUERIES  # noqa: E402
from riskcheck.session import local_session  # noqa: E402

HEADLINE = [
    "a1_scan_csv", "b1_normalize_categoricals", "b3_binarize_label", "b5_zero_to_null",
    "c1_class_median_impute", "c1_class_median_lineitem", "c2_mean_impute", "c3_mode_impute",
    "c4_median_impute", "c5_knn_impute", "c6_range_report",
    "d1_interactions", "d6_class_weights", "d7_string_index", "d8_one_hot", "d10_standardize",
    "s1_stratified_split", "s2_exact_stratified_split", "s5_smote_local", "s6_smote_balance",
    "s7_gaussian_noise", "s9_shuffle_rows", "augment_table",
    "e1_classification_metrics", "e2_auc_roc", "e4_classification_report",
    "p2_describe_lineitem", "p2_describe_approximate", "p4_histogram", "p5_correlation",
    "p7_crosstab", "p9_melt_features", "prepare_table", "prepare_then_balance",
    "m2_random_forest", "m3_gbt", "m4_logreg", "m6_score_batch",
]


def timed(spark, name, sf_dir):
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    timed(spark, "s5_smote_local", sf_dir)
    seconds = {n: round(statistics.median(timed(spark, n, sf_dir) for _ in range(runs)), 3)
               for n in names}
    print(json.dumps({"metric": "total time of the headline queries",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
