"""Sinks: idempotent tables, checked rebuilds, JSON reports and the aggregate-only snapshot."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.operators import rules
from pitlake.session import path_exists, swap_into_place


def write_table(
    df: DataFrame, path: str, order: list | None = None, partition_by: list[str] | None = None, as_csv: bool = False
) -> None:
    """Overwrite a table. ``order`` sorts at the sink only (a range-partitioned sort)."""
    rows = df.orderBy(*order) if order else df
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_csv:
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None]) -> DataFrame:
    """Write beside the target, check what was written, then swap it in.

    The input is computed once. A failed check or write leaves the old table as it was.
    """
    spark = df.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex[:8]}"
    df.write.parquet(staging)
    try:
        check(spark.read.schema(df.schema).parquet(staging))
    except Exception:
        target = spark._jvm.org.apache.hadoop.fs.Path(staging)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        raise
    swap_into_place(spark, staging, path)
    return spark.read.schema(df.schema).parquet(path)


def rebuild_table(df: DataFrame, path: str, row_rules: list[rules.Rule], key: str) -> DataFrame:
    """Replace a table if every row keeps the rules and the key is unique."""
    return publish(df, path, lambda written: rules.enforce(written, row_rules, key))


def write_report(spark: SparkSession, value: dict, path: str) -> None:
    """A JSON document as a one-file text table, readable on any file system."""
    text = json.dumps(value, indent=2, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such report: {path}")
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


# Columns that may leave in a public snapshot: aggregates only, nothing per case.
PUBLIC_TABLE_COLUMNS = {
    "leaderboard": {"model", "cv_score", "cv_score_std", "params"},
    "importance": {"feature", "importance"},
    "global_importance": {"feature", "mean_abs_shap", "mean_shap_signed", "share_pct"},
}
PUBLIC_CARD_KEYS = (
    "target", "model", "test_metrics", "primary_metric", "primary_metric_ci95", "secondary_metric",
    "secondary_metric_ci95", "baseline_model", "baseline_test_metrics", "p_value_vs_baseline",
    "best_params", "n_train", "n_test", "cutoff_date", "features", "versions",
)
PUBLIC_EXPLANATION_KEYS = (
    "explainer", "n_cases_explained", "additivity_max_error", "additivity_ok", "output_space", "top5_global",
)


def _aggregate_only(table: DataFrame, kind: str) -> DataFrame:
    allowed = PUBLIC_TABLE_COLUMNS[kind]
    extra = [c for c in table.columns if c not in allowed and not (kind == "leaderboard" and c.startswith("test_"))]
    if extra:
        raise ValueError(f"{kind} has columns that may not be published: {extra}")
    return table


def public_snapshot(
    cards: dict[str, dict],
    leaderboards: dict[str, DataFrame],
    importances: dict[str, DataFrame],
    explanations: dict[str, tuple[dict, DataFrame]],
    top: int = 10,
) -> dict:
    """Per task: card, leaderboard, strongest features, explanation summary; and all candidates."""
    tasks, names = {}, None
    for task, card in cards.items():
        board = _aggregate_only(leaderboards[task], "leaderboard")
        models = board.select("model")
        names = models if names is None else names.unionByName(models)
        summary, overall = explanations[task]
        important = _aggregate_only(importances[task], "importance")
        overall = _aggregate_only(overall, "global_importance")
        tasks[task] = {
            "task": task,
            **{k: card.get(k) for k in PUBLIC_CARD_KEYS},
            "leaderboard": [r.asDict() for r in board.orderBy(F.desc("cv_score")).collect()],
            "permutation_importance_top10": [
                r.asDict() for r in important.orderBy(F.desc("importance"), "feature").limit(top).collect()
            ],
            "shap": {k: summary.get(k) for k in PUBLIC_EXPLANATION_KEYS}
            | {
                "global_top10": [
                    r.asDict() for r in overall.orderBy(F.desc("mean_abs_shap"), "feature").limit(top).collect()
                ]
            },
        }
    candidates = names.agg(F.sort_array(F.collect_set("model"))).first()[0] if names is not None else []
    return {
        "candidates": candidates,
        "privacy": "Aggregate metrics only: no case-level rows, identifiers or model files.",
        "tasks": tasks,
    }
