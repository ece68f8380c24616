"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query whose turn comes after ``$BENCH_SECONDS`` is not started, and one that runs when the bench is told to stop is left
out and named; what was measured until then is printed in any case.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from pitlake.plans import casebook  # noqa: E402
from pitlake.plans.reports import REPORTS  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "abt_comarca_180", "abt_customer_180", "abt_full", "abt_book_365", "dq_profile", "dq_checks",
    "constraint_report", "dedupe_keep_first", "pseudonyms", "sig_round", "scrub_documents",
    "pii_scan_documents", "sensitive_documents", "risk_linkage", "l_diversity", "suppress_k5",
    "profile_columns", "target_summary", "hist_log", "eta_squared", "spearman", "by_group", "monthly",
    "quarterly_filled", "temporal_split", "ts_folds", "target_encode", "impute_standardise",
    "vocab_index", "reg_metrics", "cls_metrics", "roc_auc", "error_slices", "wilcoxon_stat", "peer_z",
    "bootstrap_ci", "isolation_flags", "incremental_features", "stream_gate", "perm_importance",
    "tree_shap_additivity", "score_batch",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    limit = time.monotonic() + float(os.environ.get("BENCH_SECONDS", 1_500))
    seconds, left = {}, []

    def printed(*_) -> None:
        total = round(sum(seconds.values()), 3)
        line = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(FOLDER).name}
        print(json.dumps(line | ({"not_run": left} if left else {})), flush=True)

    def stopped(*_) -> None:
        left.extend(q for q in wanted if q not in seconds and q not in left)
        printed()
        os._exit(0)

    signal.signal(signal.SIGTERM, stopped)
    signal.signal(signal.SIGINT, stopped)

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()  # start the JVM's work before timing
    # The derived case table is written once and read by the other queries, so it has its own line.
    timed("load_cases", lambda: consume(casebook.cases(spark, FOLDER)))
    for name in wanted:
        if time.monotonic() > limit:
            left.append(name)
        else:
            timed(name, lambda: consume(REPORTS[name](spark, FOLDER)))
    printed()
    spark.stop()


if __name__ == "__main__":
    main()
