"""``python -m pitlake <step>``: run a job or one of its steps."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from pitlake import schema
from pitlake.plans import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="pitlake")
    parser.add_argument(
        "step",
        choices=[
            "run-testbed", "anonymise", "load", "features", "explore", "train", "explain", "anomalies",
            "check-pii", "run-book", "book-prepare", "book-load", "export",
        ],
    )
    parser.add_argument("--workspace", required=True, help="shared folder for all tables")
    parser.add_argument("--source", help="raw or source table (CSV or Parquet)")
    parser.add_argument("--track", choices=["testbed", "book"], default="testbed")
    parser.add_argument("--key-variable", default="PITLAKE_KEY", help="environment variable with the secret key")
    parser.add_argument("--checksum")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--digits", type=int, default=2, help="significant digits, 0 = exact")
    parser.add_argument("--suppress-k", type=int, default=0, help="0 = off")
    parser.add_argument("--task", choices=["both", *schema.TASKS], default="both")
    parser.add_argument("--n-iter", type=int)
    parser.add_argument("--max-cases", type=int)
    parser.add_argument("--window-days", type=int)
    args = parser.parse_args()

    book = args.track == "book" or args.step in ("run-book", "book-prepare", "book-load")
    track = schema.BOOK if book else schema.TESTBED
    n_iter = args.n_iter or (4 if book else 8)
    max_cases = args.max_cases  # none given: every case of the test window
    ws, key = jobs.Workspace(args.workspace), os.getenv(args.key_variable, "")
    spark = SparkSession.builder.appName(f"pitlake-{args.step}").getOrCreate()
    steps = {
        "run-testbed": lambda: jobs.run_testbed(
            spark, args.source, ws, key, args.digits, args.suppress_k, args.task, n_iter, max_cases
        ),
        "anonymise": lambda: jobs.anonymise_step(spark, args.source, ws, key, args.digits, args.suppress_k),
        "load": lambda: jobs.load_step(spark, ws),
        "features": lambda: jobs.features_step(spark, ws, track, args.window_days),
        "explore": lambda: jobs.explore_step(spark, ws, track),
        "train": lambda: jobs.train_step(spark, ws, track, args.task, n_iter),
        "explain": lambda: jobs.explain_step(spark, ws, track, args.task, max_cases),
        "anomalies": lambda: jobs.anomaly_step(spark, ws),
        "check-pii": lambda: jobs.pii_check_step(spark, args.source or ws.path("silver", "anonymised")),
        "run-book": lambda: jobs.run_book(
            spark, args.source, ws, args.checksum, args.force, args.task, n_iter, max_cases
        ),
        "book-prepare": lambda: jobs.prepare_book_step(spark, args.source, ws, args.checksum, args.force),
        "book-load": lambda: jobs.load_book_step(spark, ws),
        "export": lambda: jobs.export_step(spark, ws, track, args.task),
    }
    print(steps[args.step]())


if __name__ == "__main__":
    main()
