"""Connected components by hooking to smaller neighbours, pointer jumping and contraction.

Edges inside an Arrow batch become a forest first, so a dense group shrinks before any shuffle. Each
round then at least halves the vertices that still have edges. Every round is written to the shared folder, and the
tables it replaces are deleted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import drop_table
from pitlake.session import stage


def smallest_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest vertex of each vertex's component, for vertices 0..n-1 and edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _forest(batches):
    for batch in batches:
        ids, place = np.unique(batch[["u", "v"]].to_numpy(), return_inverse=True)
        place = place.reshape(-1, 2)
        label = smallest_labels(place[:, 0], place[:, 1], len(ids))
        child = np.flatnonzero(label != np.arange(len(ids)))
        yield pd.DataFrame({"u": ids[label[child]], "v": ids[child]})


def _compact(edges: DataFrame) -> DataFrame:
    ordered = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v")
    return ordered.mapInPandas(_forest, "u long, v long").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every vertex with an edge; the component is its smallest vertex (longs)."""
    work = stage(_compact(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    result = None
    while not work.isEmpty():
        ends = work.select(F.col("v").alias("node"), F.col("u").alias("up")).unionAll(work.select(F.col("u"), F.col("u")))
        parent = stage(ends.groupBy("node").agg(F.min("up").alias("up")), "parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = stage(parent.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "parents")
            drop_table(parent)
            parent = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        roots = lambda of: parent.select(F.col("node").alias(of), F.col("up").alias(f"root_{of}"))  # noqa: E731, B023
        contracted = work.join(roots("u"), "u").join(roots("v"), "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
        rest = stage(_compact(contracted), "edges")
        if result is None:
            result, merged = parent, None
        else:
            merged = result.join(parent.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left")
            merged = stage(merged.select("node", F.coalesce("top", "up").alias("up")), "roots")
            drop_table(result)
            drop_table(parent)
            result = merged
        drop_table(work)
        work = rest
    if result is None:
        return work.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return result.select("node", F.col("up").alias("component"))
