"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs to a
no-op sink so that every row and column is computed. One small query runs first
to start the JVM's code paths; it is not counted.
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

HEADLINE = (
    "k08_drift_audit",
    "k01_psi_numeric",
    "k02_psi_categorical",
    "k03_two_sample_ks",
    "k05_chi2_homogeneity",
    "k09_quality_audit",
    "k13_retraining_decisions",
    "i03_roc_auc",
    "i08_reliability_table",
    "i12_metric_record",
    "i15_threshold_sweep",
    "i16_segment_errors_numeric",
    "p03_threshold_guardrail",
    "p07_decisions_table",
    "e01_variance",
    "e02_correlation",
    "e03_mutual_information",
    "e04_anova",
    "g09_method_agreement",
    "d02_three_way_split",
    "d03_stratified_folds",
    "d09_monitoring_windows",
    "c03_standard_scaling",
    "c06_fit_transform",
    "f05_permutation_importance",
    "x01_partial_dependence",
    "x05_explained_errors",
    "h01_logistic_regression",
    "h02_random_forest",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = sys.argv[1:] or HEADLINE

    from plumbline.plans import QUERIES, load_all
    from plumbline.session import local_session

    load_all()
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["i01_confusion_counts"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    match = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(match.group(1)) if match else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
