"""Review queue: amounts that are strange for their peer group."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlake.operators.ordering import BUCKET_ROWS, cumulative, exact_quantiles, null_safe_join, quantiles_of
from pitlake.session import spread, stage

# Smallest peer group with its own statistics, MAD-to-sigma factor, scale floor.
MIN_GROUP = 20
MAD_SCALE = 1.4826
SCALE_FLOOR = 1e-6
TREES = 200
TREE_SAMPLE = 256
_OVERSAMPLE = 4


def peer_z(
    df: DataFrame,
    value: str = "claim_value",
    peers: tuple[str, ...] = ("comarca", "vara"),
    min_group: int = MIN_GROUP,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``log_claim`` and ``peer_z`` = (x - median) / scaled MAD of the peer group.

    Small groups use the statistics of the whole table. Rows without a value are left out.
    """
    keys = list(peers)
    rows = df.filter(F.col(value).isNotNull()).withColumn(
        "log_claim", F.log1p(F.col(value).cast("double"))
    )

    # The whole table first: its two medians become literals, so no row is copied for it and no key
    # stands for all rows. Only distinct values with counts are ordered and joined from here on.
    middle = exact_quantiles(rows, "log_claim", {"median": 0.5}, bucket_rows=bucket_rows).first()
    overall = middle["median"] if middle else None
    if overall is None:
        raise ValueError(f"{value} holds no values")
    apart = rows.select(F.abs(F.col("log_claim") - F.lit(overall)).alias("gap"))
    overall_mad = exact_quantiles(apart, "gap", {"mad": 0.5}, bucket_rows=bucket_rows).first()["mad"]

    own = rows.select(*keys, F.col("log_claim").alias("x"))
    values = cumulative(own, ["x"], {"n": F.count("x")}, keys, bucket_rows)
    medians = stage(quantiles_of(values, "x", {"_median": 0.5}, keys, "n", ["n"]), "medians")
    gaps = null_safe_join(values, medians.drop("n"), keys).select(
        *keys, F.abs(F.col("x") - F.col("_median")).alias("gap"), F.col("n").alias("_n")
    )
    spreads = cumulative(gaps, ["gap"], {"m": F.sum("_n")}, keys, bucket_rows)
    mads = quantiles_of(spreads, "gap", {"_mad": 0.5}, keys, "m")
    stats = stage(null_safe_join(medians, mads, keys).withColumnRenamed("n", "_size"), "peers")
    enough = F.col("_size") >= min_group
    centre = F.when(enough, F.col("_median")).otherwise(F.lit(overall))
    scale = F.when(enough, F.greatest(MAD_SCALE * F.col("_mad"), F.lit(SCALE_FLOOR))).otherwise(
        F.lit(max(MAD_SCALE * overall_mad, SCALE_FLOOR))
    )
    return (
        null_safe_join(rows, stats, keys, "left")
        .withColumn("peer_z", (F.col("log_claim") - centre) / scale)
        .select(*rows.columns, "peer_z")
    )


def _tree_samples(points: DataFrame, key: str, trees: int, size: int, seed: int) -> DataFrame:
    """(tree, x, z): up to ``size`` rows for each tree, chosen by hash.

    One scheme for every size: a row is drawn for a hashed number of distinct trees whose mean is
    trees x share, with the share of rows that a tree needs to fill its sample with room to spare. Only
    drawn (row, tree) pairs are made; on a small table the share is 1 and the number is all trees.
    """
    share = min(1.0, size * _OVERSAMPLE / max(points.count(), 1))
    mean = trees * share

    def uniform(*cols):
        return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)

    # Steps that share no factor with the number of trees lead through distinct trees.
    steps = [k for k in range(1, trees + 1) if math.gcd(k, trees) == 1]
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.col(key), F.lit(seed + salt)), F.lit(n))
    number = F.floor(F.lit(mean) + uniform(F.col(key), F.lit(seed + 1))).cast("int")
    step = F.get(F.array(*map(F.lit, steps)), hashed(2, len(steps)).cast("int"))
    drawn = points.withColumn("_n", F.least(number, F.lit(trees))).filter("_n > 0")
    drawn = drawn.withColumns({"_first": hashed(3, trees), "_step": step})
    turns = F.sequence(F.lit(0), F.col("_n") - 1)
    tree = F.transform(turns, lambda i: F.pmod(F.col("_first") + i * F.col("_step"), F.lit(trees)).cast("int"))
    candidates = drawn.withColumn("tree", F.explode(tree)).withColumn("u", uniform(F.col(key), F.col("tree"), F.lit(seed)))
    # About _OVERSAMPLE * size candidates per tree reach this window.
    smallest = Window.partitionBy("tree").orderBy("u", key)
    return (
        candidates.withColumn("_r", F.row_number().over(smallest))
        .filter(F.col("_r") <= size)
        .select("tree", "log_claim", "peer_z")
    )


def _path_length(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + np.euler_gamma) - 2 * (n[big] - 1) / n[big]
    return out


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, length) of a tree of random splits.

    A leaf points to itself, and its length is its depth plus what its points would still need.
    """
    rest = _path_length(np.arange(len(points) + 1))
    nodes: list[tuple] = [()]
    open_nodes = [(0, points, 0)]
    while open_nodes:
        at, part, depth = open_nodes.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = [f for f in range(part.shape[1]) if high[f] > low[f]]
        if depth >= max_depth or not usable:
            nodes[at] = (0, np.inf, at, at, depth + float(rest[len(part)]))
            continue
        feature = usable[int(rng.integers(len(usable)))]
        threshold = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] <= threshold
        left = len(nodes)
        nodes += [(), ()]
        nodes[at] = (feature, threshold, left, left + 1, 0.0)
        open_nodes += [(left, part[below], depth + 1), (left + 1, part[~below], depth + 1)]
    return nodes


def _forest_length(x: np.ndarray, forest: tuple, max_depth: int) -> np.ndarray:
    """Summed path length over all trees, walking every tree at once in blocks of rows."""
    roots, feature, threshold, child, length = forest
    total = np.empty(len(x))
    for start in range(0, len(x), 512):
        block = x[start : start + 512]
        at = np.broadcast_to(roots, (len(block), len(roots)))
        for _ in range(max_depth):
            value = np.where(feature[at] == 0, block[:, :1], block[:, 1:])
            at = child[2 * at + (value > threshold[at])]
        total[start : start + 512] = length[at].sum(axis=1)
    return total


def flag_anomalies(
    df: DataFrame,
    contamination: float = 0.01,
    key: str = "case_id",
    trees: int = TREES,
    sample: int = TREE_SAMPLE,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(key, anomaly_score, is_anomaly) from an isolation forest on amount and peer z-score.

    Higher is stranger. Each tree is grown in its own task from at most ``sample`` rows, so the
    forest has a fixed size bound and can travel to every scoring task.
    """
    points = stage(peer_z(df, bucket_rows=bucket_rows).select(key, "log_claim", "peer_z"), "points")
    max_depth = math.ceil(math.log2(max(sample, 2)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["log_claim", "peer_z"])
        nodes = _grow(pdf[["log_claim", "peer_z"]].to_numpy(), np.random.default_rng([seed, tree]), max_depth)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "length"])
        return out.assign(tree=tree, node=range(len(nodes)), size=len(pdf))

    layout = "tree int, node int, feature int, threshold double, left int, right int, length double, size int"
    order = [c.split()[0] for c in layout.split(", ")]
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    grown = (
        _tree_samples(points, key, trees, sample, seed)
        .repartition(tasks, "tree")
        .groupBy("tree")
        .applyInPandas(lambda pdf: build(pdf)[order], layout)
        .toPandas()  # at most trees * (2 * sample - 1) rows
        .sort_values(["tree", "node"], ignore_index=True)
    )
    roots = np.flatnonzero(grown["node"].to_numpy() == 0)
    shift = np.repeat(roots, np.diff([*roots, len(grown)]))
    child = (grown[["left", "right"]].to_numpy() + shift[:, None]).ravel()
    forest = (
        roots,
        grown["feature"].to_numpy(dtype=np.int8),
        grown["threshold"].to_numpy(),
        child,
        grown["length"].to_numpy(),
    )
    typical = float(_path_length(np.array([grown.groupby("tree")["size"].first().mean()]))[0]) or 1.0
    trees_grown = len(roots)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        for pdf in batches:
            x = pdf[["log_claim", "peer_z"]].to_numpy()
            mean = _forest_length(x, shared.value, max_depth) / trees_grown
            yield pdf[[key]].assign(anomaly_score=2.0 ** (-mean / typical))

    key_type = points.schema[key].dataType.simpleString()
    scored = stage(spread(points).mapInPandas(score, f"{key} {key_type}, anomaly_score double"), "scores")
    threshold = exact_quantiles(
        scored, "anomaly_score", {"t": 1 - contamination}, bucket_rows=bucket_rows
    ).first().t
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(threshold))
