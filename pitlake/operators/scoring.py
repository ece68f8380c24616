"""Scoring and explaining requests, in a batch or on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.operators import attribution, rules
from pitlake.operators.models import FittedModel

# Result column and decimals per task.
RESULT = {"regression": ("predicted_claim_value", 2), "classification": ("probability_unfavorable", 4)}


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``errors``)."""
    checked = rules.validate_requests(requests)
    return checked.filter("valid").drop("valid", "errors"), checked.filter("NOT valid").drop("valid")


def score(model: FittedModel, requests: DataFrame) -> DataFrame:
    """Add the result, the model name and when it was trained. Unseen ids and absent optional
    features are allowed."""
    name, digits = RESULT[model.task]
    return model.predict(requests).withColumns(
        {
            name: F.round("prediction", digits),
            "model": F.lit(model.name),
            "trained_at": F.lit(model.card.get("created_at")),
        }
    ).drop("prediction")


def explain_requests(model: FittedModel, requests: DataFrame, key: str = "request_id", k: int = 5) -> DataFrame:
    """Per request: base value, raw output, additivity error, top contributions and the result.

    Raises for a model without exact attribution rather than approximating silently.
    """
    name, digits = RESULT[model.task]
    explained = attribution.explain_rows(model, requests, key)
    rebuilt = F.col("base_value") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)
    return attribution.with_top(explained, model.encoder.names(), k).select(
        key,
        F.lit(model.output_space()).alias("unit"),
        "base_value",
        F.col("raw_output").alias("raw_prediction"),
        F.abs(rebuilt - F.col("raw_output")).alias("additivity_error"),
        "top_contributions",
        F.round("prediction", digits).alias(name),
    )
