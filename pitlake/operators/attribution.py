"""Additive explanations of single predictions.

A tree's output is a sum over its leaves. For one leaf, a feature is either in agreement with the
row (o = 1 if the row passes all splits on it) or averaged over the training rows (z, the share of
them that pass). The leaf's game is v * prod(o or z), and its Shapley value for feature i is

    v * (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} ((1 - t) z_j + t o_j)

a polynomial in t, which Gauss-Legendre nodes integrate exactly. A leaf that tests few features has few games,
one for each pattern of agreements, so its contributions are looked up; leaves of like conditions share a table.
Rows are mapped in Arrow batches against blocks of leaves of bounded bytes. Contributions add up over leaves, so each block adds its part to
the rows' sums; a model of one block needs one pass, a larger one a written table of sums between blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.operators.boosting import BoostedTrees
from pitlake.operators.models import OWN, FittedModel
from pitlake.operators.ordering import cumulative
from pitlake.operators.split import deterministic_sample
from pitlake.session import spread, stage, work_folder

EXACT = "exact tree attribution"
SAMPLED = "sampled-permutation attribution (approximate)"
ADDITIVITY_LIMIT = 1e-4
BLOCK_BYTES = 64 << 20  # leaves that one broadcast, and a Python worker, holds at a time
_CELLS = 2_000_000  # floats per numpy block
_TABLED = 6  # most features of a leaf whose contributions are looked up
_BITS = 7  # most conditions of a table


@dataclass(frozen=True)
class Leaves:
    """Leaves whose path tests the same number of features, as arrays of shape (leaves, width)."""

    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def has_tree_table(model: FittedModel) -> bool:
    known = hasattr(model.model, "toDebugString") and hasattr(model.model, "write")
    return known or isinstance(model.model, OWN)


def _node_table(model: FittedModel, df: DataFrame) -> pd.DataFrame:
    """One row per node of every tree; Spark's own trees are read from the saved estimator."""
    import uuid

    if isinstance(model.model, OWN):
        rows = [
            (tree, i, n["value"], float(n["rows"]), n["left"], n["left"] + 1 if n["left"] >= 0 else -1, n["feature"], n["threshold"])
            for tree, nodes in enumerate(model.model.nodes())
            for i, n in enumerate(nodes)
        ]
        return pd.DataFrame(rows, columns=["tree", "id", "prediction", "cover", "leftChild", "rightChild", "feature", "threshold"])

    path = f"{work_folder(df.sparkSession)}/estimator-{uuid.uuid4().hex[:12]}"
    model.model.write().save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.withColumn("tree", F.lit(0))
    return nodes.select(
        "tree",
        "id",
        "prediction",
        "impurityStats",
        F.col("rawCount").cast("double").alias("cover"),
        "leftChild",
        "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas()


def leaf_tables(model: FittedModel, df: DataFrame) -> tuple[float, list[Leaves]]:
    """The mean output over training rows and the leaves, scaled to the model's raw output."""
    nodes = _node_table(model, df)
    trees = nodes["tree"].nunique()
    own = isinstance(model.model, OWN)
    summed = isinstance(model.model, BoostedTrees)
    boosted = summed or hasattr(model.model, "treeWeights") and "GBT" in type(model.model).__name__
    if summed:
        weights = [1.0] * trees
    elif boosted:
        factor = 2.0 if model.task == "classification" else 1.0
        weights = [factor * w for w in model.model.treeWeights]
    else:
        weights = [1.0 / trees] * trees
    probability = model.task == "classification" and not boosted and not own

    by_width: dict[int, list[tuple]] = {}
    base = model.model.start if summed else 0.0
    for tree, part in nodes.groupby("tree"):
        node = {r.id: r for r in part.itertuples()}

        def value(n) -> float:
            if probability:
                counts = np.asarray(n.impurityStats, dtype=float)
                return counts[1] / counts.sum()
            return n.prediction

        open_paths = [(node[0], {})]
        while open_paths:
            n, path = open_paths.pop()
            if n.leftChild < 0:
                v = weights[int(tree)] * value(n)
                base += v * float(np.prod([p[2] for p in path.values()]))
                by_width.setdefault(len(path), []).append((v, path))
                continue
            for child, is_left in ((node[n.leftChild], True), (node[n.rightChild], False)):
                low, high, share = path.get(n.feature, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, n.threshold)) if is_left else (max(low, n.threshold), high)
                open_paths.append((child, path | {n.feature: (low, high, share * child.cover / n.cover)}))

    tables = []
    for width, leaves in by_width.items():
        if width == 0:  # a single-leaf tree is all base
            continue
        tables.append(
            Leaves(
                np.array([v for v, _ in leaves]),
                np.array([list(p) for _, p in leaves]),
                np.array([[c[0] for c in p.values()] for _, p in leaves]),
                np.array([[c[1] for c in p.values()] for _, p in leaves]),
                np.array([[c[2] for c in p.values()] for _, p in leaves]),
            )
        )
    return base, tables


def leaf_blocks(tables: list[Leaves], features: int, limit: int) -> list[list[Leaves]]:
    """The leaves dealt into blocks of at most ``limit`` bytes with what a worker builds of them, one leaf at least."""
    blocks: list[list[Leaves]] = [[]]
    free = limit
    for t in tables:
        width = t.feature.shape[1]
        each = 8 + width * (32 + (8 << _BITS if width <= _TABLED else 8 * features))
        at = 0
        while at < len(t.value):
            if free < each and blocks[-1]:
                blocks.append([])
                free = limit
            upto = at + max(1, free // each)
            part = Leaves(t.value[at:upto], t.feature[at:upto], t.low[at:upto], t.high[at:upto], t.share[at:upto])
            blocks[-1].append(part)
            free -= each * len(part.value)
            at = upto
    return blocks


def _games(agrees: np.ndarray, t: Leaves) -> np.ndarray:
    """Contributions of the features of every leaf, where ``agrees`` says which of them agree: (..., leaves, width)."""
    nodes, weights = np.polynomial.legendre.leggauss((t.feature.shape[1] + 1) // 2)
    integral = np.zeros(np.broadcast_shapes(agrees.shape, t.share.shape))
    for node, weight in zip((nodes + 1) / 2, weights / 2, strict=True):
        factor = (1 - node) * t.share + node * agrees
        integral += weight * factor.prod(axis=-1, keepdims=True) / factor
    return t.value[:, None] * (agrees - t.share) * integral


@dataclass(frozen=True)
class Table:
    """Contributions of some leaves by the pattern of their conditions: row p for the ones whose bits are set in p."""

    conditions: list[tuple[int, float, float]]  # (feature, low, high)
    features: list[int]
    phi: np.ndarray  # (features, patterns)


def pattern_tables(t: Leaves) -> list[Table]:
    """Leaves one after the other share a table as long as they have at most ``_BITS`` conditions together."""
    width = t.feature.shape[1]
    patterns = (np.arange(1 << width)[:, None] >> np.arange(width)) & 1
    phi = _games(patterns[:, None, :].astype(float), t)  # (patterns, leaves, width)
    conditions = [list(zip(*c, strict=True)) for c in zip(t.feature.tolist(), t.low.tolist(), t.high.tolist(), strict=True)]
    groups: list[tuple[dict, list[int]]] = []
    for leaf, mine in enumerate(conditions):
        if groups and len(groups[-1][0].keys() | set(mine)) <= _BITS:
            known, leaves = groups[-1]
        else:
            known, leaves = {}, []
            groups.append((known, leaves))
        for c in mine:
            known.setdefault(c, len(known))
        leaves.append(leaf)
    tables = []
    for known, leaves in groups:
        features = sorted({c[0] for c in known})
        out = np.zeros((len(features), 1 << len(known)))
        every = np.arange(1 << len(known))
        for leaf in leaves:
            own = sum(((every >> known[c]) & 1) << j for j, c in enumerate(conditions[leaf]))
            for j, c in enumerate(conditions[leaf]):
                out[features.index(c[0])] += phi[own, leaf, j]
        tables.append(Table(list(known), features, out))
    return tables


def prepared(tables: list[Leaves]) -> tuple[list[Table], list[Leaves]]:
    """Tables of the leaves that test few features, and the other leaves."""
    narrow = [t for t in tables if t.feature.shape[1] <= _TABLED]
    return [p for t in narrow for p in pattern_tables(t)], [t for t in tables if t.feature.shape[1] > _TABLED]


def leaf_attribution(x: np.ndarray, tables: list[Leaves]) -> np.ndarray:
    """Contributions of every feature for every row of ``x``."""
    return _attribution(x, *prepared(tables))


def _attribution(x: np.ndarray, looked_up: list[Table], others: list[Leaves]) -> np.ndarray:
    columns, sums = np.ascontiguousarray(x.T, dtype=float), np.zeros((x.shape[1], len(x)))
    for t in looked_up:
        pattern = np.zeros(len(x), dtype=np.uint8)
        for bit, (feature, low, high) in enumerate(t.conditions):
            value = columns[feature]
            holds = value <= high
            if low != -np.inf:
                holds &= value > low
            pattern |= holds.view(np.uint8) << np.uint8(bit)
        at = pattern.astype(np.intp)
        for feature, phi in zip(t.features, t.phi, strict=True):
            sums[feature] += phi.take(at)
    out = np.ascontiguousarray(sums.T)
    for t in others:
        width = t.feature.shape[1]
        scatter = [np.zeros((len(t.value), x.shape[1])) for _ in range(width)]
        for j in range(width):
            scatter[j][np.arange(len(t.value)), t.feature[:, j]] = 1.0
        step = max(1, _CELLS // t.feature.size)
        for start in range(0, len(x), step):
            cells = x[start : start + step][:, t.feature]
            phi = _games(((cells > t.low) & (cells <= t.high)).astype(float), t)
            for j in range(width):
                out[start : start + step] += phi[:, :, j] @ scatter[j]
    return out


def explain_rows(model: FittedModel, df: DataFrame, *keep: str) -> DataFrame:
    """(keep..., prediction, raw_output, base_value, feature_values, phi) for every row, exactly."""
    if not has_tree_table(model):
        raise ValueError("no exact attribution for this kind of model")
    base, tables = leaf_tables(model, df)
    scored = model.with_output(model.encoder.transform(df)).select(
        *keep, "prediction", "raw_output", vector_to_array("features").alias("feature_values")
    )
    scored = scored if df.isStreaming else stage(scored, "scored")
    layout = model.encoder.layout()
    size = sum(layout.widths) + layout.tail
    rows = spread(scored).withColumn("phi", F.array_repeat(F.lit(0.0), size))
    blocks = leaf_blocks(tables, size, BLOCK_BYTES)
    for i, block in enumerate(blocks):
        shared = df.sparkSession.sparkContext.broadcast(block)
        rows = rows.mapInPandas(_adding(shared), rows.schema)
        if i + 1 < len(blocks) and not df.isStreaming:
            rows = stage(rows, "contributions")
            shared.destroy()
    return rows.withColumn("base_value", F.lit(base))


def _adding(shared):
    """Adds the contributions of a broadcast block of leaves to ``phi``."""

    def add(batches):
        ready = prepared(shared.value)
        for pdf in batches:
            if len(pdf):
                x, phi = np.stack(pdf["feature_values"].to_numpy()), np.stack(pdf["phi"].to_numpy())
                pdf["phi"] = list(phi + _attribution(x, *ready))
            yield pdf

    return add


def explain_rows_sampled(
    model: FittedModel, df: DataFrame, background: DataFrame, *keep: str, key: str = "case_id", seed: int = 42
) -> DataFrame:
    """Fallback for any model: mean marginal change over feature orders against background rows.

    Each background row (at most 100) is walked once per case in its own order, from background to
    case, so contributions add up to the output minus the mean background output.
    """
    points = [
        r[0]
        for r in model.encoder.transform(deterministic_sample(background, 100, key, seed))
        .select(vector_to_array("features"))
        .collect()
    ]
    width = len(points[0])
    scored = stage(
        model.with_output(model.encoder.transform(df)).select(
            *dict.fromkeys([key, *keep]), "prediction", "raw_output", vector_to_array("features").alias("feature_values")
        ),
        "to-explain",
    )
    walks = scored.select(
        key,
        F.col("feature_values").alias("x"),
        F.posexplode(F.array(*[F.array(*map(F.lit, p)) for p in points])).alias("walk", "b"),
    )
    order = F.transform(
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.lit(width - 1)),
                lambda i: F.struct(F.xxhash64(F.col(key), F.col("walk"), i, F.lit(seed)).alias("h"), i.alias("i")),
            )
        ),
        lambda s: s["i"],
    )
    steps = walks.withColumn("order", order).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step")
    )
    taken = F.slice("order", F.lit(1), F.col("step"))
    mixed = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(F.array_contains(taken, i), F.get("x", i)).otherwise(F.get("b", i)),
    )
    outputs = model.with_output(steps.withColumn("features", array_to_vector(mixed))).select(
        key, "walk", "order", "step", "raw_output"
    )
    # Output at step s counts for the feature added there and against the one added next.
    signed = F.array(
        F.struct(F.get("order", F.col("step") - 1).alias("f"), F.col("raw_output").alias("d")),
        F.struct(F.get("order", F.col("step")).alias("f"), (-F.col("raw_output")).alias("d")),
    )
    per_feature = (
        outputs.select(key, F.inline(signed))
        .filter("f IS NOT NULL")
        .groupBy(key, "f")
        .agg((F.sum("d") / len(points)).alias("phi"))
        .groupBy(key)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "phi"))), lambda s: s["phi"]).alias("phi"))
    )
    base = outputs.filter("step = 0").groupBy(key).agg(F.avg("raw_output").alias("base_value"))
    return scored.join(per_feature, key).join(base, key)


def additivity(explained: DataFrame, candidates: dict[str, Column] | None = None) -> tuple[str, float]:
    """The output space that the contributions reproduce best, and the largest error in it."""
    candidates = candidates or {"raw_output": F.col("raw_output")}
    rebuilt = F.col("base_value") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)
    row = explained.agg(
        *[F.max(F.abs(c - rebuilt)).alias(f"e{i}") for i, c in enumerate(candidates.values())]
    ).first()
    errors = {name: row[f"e{i}"] for i, name in enumerate(candidates)}
    return min(errors.items(), key=lambda e: (e[1] is None, e[1]))


def output_candidates(model: FittedModel) -> dict[str, Column]:
    """Every space the contributions might live in, by unit."""
    if model.task == "regression":
        return {"log1p(BRL)": F.col("raw_output")}
    p = F.col("prediction")
    return {"class-1 probability": p, "log-odds": F.ln(p / (1 - p))}


def long_form(explained: DataFrame, names: list[str], *keep: str, drop_below: float = 1e-9) -> DataFrame:
    """(keep..., feature, feature_value, shap), without contributions of zero."""
    zipped = F.arrays_zip(
        F.array(*map(F.lit, names)).alias("feature"),
        F.col("feature_values").alias("feature_value"),
        F.col("phi").alias("shap"),
    )
    rows = explained.select(*keep, F.inline(zipped))
    return rows.filter(F.abs("shap") >= drop_below)


def global_importance(explained: DataFrame, names: list[str]) -> DataFrame:
    """(feature, mean_abs_shap, mean_shap_signed, share_pct) over all explained rows."""
    per_feature = (
        long_form(explained, names, drop_below=0.0)
        .groupBy("feature")
        .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"), F.avg("shap").alias("mean_shap_signed"))
    )
    total = per_feature.agg(F.sum("mean_abs_shap")).scalar()
    return per_feature.withColumn("share_pct", F.try_divide(100 * F.col("mean_abs_shap"), total))


def dependence(explained: DataFrame, names: list[str], k: int, key: str = "case_id") -> DataFrame:
    """Feature value against contribution for the k features that matter most."""
    top = global_importance(explained, names).orderBy(F.desc("mean_abs_shap"), "feature").limit(k)
    wanted = [r["feature"] for r in top.collect()]
    return long_form(explained, names, key, drop_below=0.0).filter(F.col("feature").isin(wanted))


def ranked_contributions(names: list[str]) -> Column:
    """Array of (feature, shap) from the strongest to the weakest; ties in name order."""
    pairs = F.zip_with(
        F.array(*map(F.lit, names)), F.col("phi"), lambda n, v: F.struct(n.alias("feature"), v.alias("shap"))
    )
    return F.array_sort(
        pairs,
        lambda a, b: F.when(F.abs(a["shap"]) > F.abs(b["shap"]), -1)
        .when(F.abs(a["shap"]) < F.abs(b["shap"]), 1)
        .when(a["feature"] < b["feature"], -1)
        .otherwise(1),
    )


def with_top(explained: DataFrame, names: list[str], k: int = 5) -> DataFrame:
    """Add ``top_contributions``, ``top_up`` and ``top_down`` per row, without a shuffle."""
    ranked = explained.withColumn("_ranked", ranked_contributions(names))
    return ranked.withColumns(
        {
            "top_contributions": F.slice("_ranked", 1, k),
            "top_up": F.slice(F.filter("_ranked", lambda c: c["shap"] > 0), 1, k),
            "top_down": F.slice(F.filter("_ranked", lambda c: c["shap"] < 0), 1, k),
        }
    ).drop("_ranked")


def pick_cases(explained: DataFrame, key: str = "case_id") -> DataFrame:
    """(pick, key, prediction) for the lowest, the median (upper of two) and the highest prediction."""
    order = cumulative(explained, ["prediction", key], {"n": F.count(F.lit(1))})
    last, middle = F.col("total_n") - 1, F.floor(F.col("total_n") / 2)
    position = F.col("before_n")
    picks = F.array_compact(
        F.array(
            F.when(position == 0, "lowest"),
            F.when(position == middle, "median"),
            F.when(position == last, "highest"),
        )
    )
    return order.select(F.explode(picks).alias("pick"), key, "prediction")


@dataclass
class Explanation:
    rows: DataFrame
    names: list[str]
    kind: str
    space: str
    error: float

    def importance(self) -> DataFrame:
        return global_importance(self.rows, self.names)

    def summary(self, key: str = "case_id") -> dict:
        top = self.importance().orderBy(F.desc("mean_abs_shap"), "feature").limit(5).collect()
        best = self.rows.orderBy(F.desc("prediction"), key).limit(1)
        story = with_top(best, self.names).first()

        def listed(part) -> list[dict]:
            return [{"feature": c["feature"], "shap": c["shap"]} for c in part]

        return {
            "explainer": self.kind,
            "n_cases_explained": self.rows.count(),
            "n_features_encoded": len(self.names),
            "additivity_max_error": self.error,
            "additivity_ok": self.error < ADDITIVITY_LIMIT,
            "output_space": self.space,
            "top5_global": [{"feature": r["feature"], "mean_abs_shap": r["mean_abs_shap"]} for r in top],
            "one_case_story": {
                "case": str(story[key]),
                "predicted_raw": story["raw_output"],
                "top_up": listed(story["top_up"]),
                "top_down": listed(story["top_down"]),
                "global_top_feature": top[0]["feature"],
            },
        }


def explain(
    model: FittedModel, test: DataFrame, target: str, max_cases: int | None = None, key: str = "case_id"
) -> Explanation:
    """Explain up to ``max_cases`` test rows (all of them with None) and check additivity."""
    if model.model is None:
        raise ValueError("a constant baseline has nothing to explain")
    rows = test if max_cases is None else deterministic_sample(test, max_cases, key)
    if has_tree_table(model):
        explained, kind = explain_rows(model, rows, key, target), EXACT
    else:
        explained, kind = explain_rows_sampled(model, rows, test, key, target, key=key), SAMPLED
    explained = stage(explained, "explained")
    candidates = output_candidates(model) if kind == EXACT else {model.output_space(): F.col("raw_output")}
    space, error = additivity(explained, candidates)
    return Explanation(explained, model.encoder.names(), kind, space, error)
