"""Embedding near-duplicates by an epsilon grid order join.

Normalised vectors with cosine >= c are within epsilon = sqrt(2 - 2c) of each other, in full and in any
orthogonal projection. Vectors are sorted by their grid cells (of side epsilon) on the leading principal
dimensions and cut into sequence intervals: blocks of ``BLOCK`` vectors, strips of ``FAN`` blocks, and so on upwards.
The join starts from the whole sequence joined with itself and descends: a pair of
intervals whose boxes are further apart than epsilon is skipped, any other is split into pairs of its parts. A surviving
pair of strips is one small group: its blocks are tested again, then compared in double precision.

Equal vectors collapse into one before the join and count with their number, so a vector that a third of all
rows share costs one comparison. A group gives out link counts and a spanning forest, never all its pairs; no
candidate is dropped or sampled. Work falls with the share of block pairs that the boxes exclude: for vectors without any structure
it stays quadratic, which this method cannot avoid.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with
nothing; vectors of different lengths never link; rows that repeat a vec_id count as separate vectors; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import drop_table
from pitlake.llm.components import components, smallest_labels
from pitlake.session import stage

COSINE = 0.95
BLOCK, FAN, LEADING = 512, 16, 8
SLACK = 1e-9  # of box tests, far above rounding


def _moments(batches):
    """Count, sums and products of normalised vectors, one row per cell of the triangle."""
    total = None
    for batch in batches:
        x = _unit(np.stack(batch["vector"].to_numpy()).astype(np.float64))
        x = np.hstack([np.ones((len(x), 1)), x])
        total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield pd.DataFrame({"cell": np.arange(total.size), "value": total.ravel()})


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """The leading eigenvectors of the covariance over all vectors, width x LEADING."""
    rows = vectors.select("vector").mapInPandas(_moments, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros((width + 1) ** 2)
    for r in rows:
        moments[r.cell] = r.value
    moments = moments.reshape(width + 1, width + 1) / moments[0]
    cov = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    return np.ascontiguousarray(np.linalg.eigh(cov)[1][:, ::-1][:, :LEADING])


def _projector(axes: np.ndarray, epsilon: float):
    def project(batches):
        for batch in batches:
            place = _unit(np.stack(batch["vector"].to_numpy()).astype(np.float64)) @ axes
            cells = np.floor(place / epsilon).astype(np.int32)
            yield batch.assign(cells=list(cells), place=list(place))

    return project


def _packer(batches):
    """Consecutive sorted rows of a partition become blocks with their bounding box."""
    from pyspark import TaskContext

    part, seq, held = TaskContext.get().partitionId(), 0, None

    def block(rows: pd.DataFrame) -> dict:
        place = np.stack(rows["place"].to_numpy())
        unit = _unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        return {
            "part": part, "seq": seq, "ids": rows["node"].to_numpy(), "weights": rows["weight"].to_numpy(),
            "data": unit.tobytes(), "low": place.min(axis=0), "high": place.max(axis=0),
        }

    for batch in batches:
        held = batch if held is None else pd.concat([held, batch])
        while len(held) >= BLOCK:
            yield pd.DataFrame([block(held.iloc[:BLOCK])])
            seq, held = seq + 1, held.iloc[BLOCK:]
    if held is not None and len(held):
        yield pd.DataFrame([block(held)])


BLOCK_TYPE = "part long, seq long, ids array<long>, weights array<long>, data binary, low array<double>, high array<double>"


def pack(vectors: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Blocks in grid order, numbered consecutively over the whole sequence."""
    placed = vectors.mapInPandas(_projector(axes, epsilon), "node long, weight long, vector array<double>, cells array<int>, place array<double>")
    ordered = placed.repartitionByRange("cells", "place").sortWithinPartitions("cells", "place")
    packed = stage(ordered.mapInPandas(_packer, BLOCK_TYPE), "blocks")
    # One count per range partition: as many rows as the shuffle has partitions.
    counts = packed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    offsets, at = {}, 0
    for r in counts:
        offsets[r.part], at = at, at + r.n
    if not offsets:
        return packed.withColumn("block", F.lit(0).cast("long"))
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    return packed.withColumn("block", (offset[F.col("part")] + F.col("seq")).cast("long"))


def _apart(a: str, b: str, epsilon: float):
    """Squared distance of two boxes exceeds epsilon squared."""
    gap = F.zip_with(
        F.zip_with(F.col(f"low_{a}"), F.col(f"high_{b}"), lambda x, y: x - y),
        F.zip_with(F.col(f"low_{b}"), F.col(f"high_{a}"), lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    square = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    return square > (epsilon + SLACK) ** 2


def _boxes(parts: DataFrame, node) -> DataFrame:
    axes = range(LEADING)
    at = lambda c, i: F.get(F.col(c), i)  # noqa: E731  fewer dimensions than LEADING give nulls
    ends = parts.groupBy(node.alias("node")).agg(*[F.min(at("low", i)).alias(f"l{i}") for i in axes], *[F.max(at("high", i)).alias(f"h{i}") for i in axes])
    joined = lambda side: F.array_compact(F.array(*[F.col(f"{side}{i}") for i in axes])).alias("low" if side == "l" else "high")
    return ends.select("node", joined("l"), joined("h"))


def interval_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(i, j), i <= j: pairs of strips whose boxes, and whose ancestors' boxes, are within epsilon."""
    level = stage(_boxes(blocks, F.floor(F.col("block") / FAN)), "boxes")
    levels = [level]
    while levels[-1].count() > FAN:
        levels.append(stage(_boxes(levels[-1], F.floor(F.col("node") / FAN)), "boxes"))
    top = levels[-1]
    side = lambda df, s: df.select(F.col("node").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}"))
    # At most FAN intervals at the top, so at most FAN * (FAN + 1) / 2 pairs begin the descent.
    names = F.sequence(F.lit(0).cast("long"), F.lit(FAN - 1).cast("long"))
    pairs = side(top, "i").withColumn("j", F.explode(names)).join(side(top, "j"), "j").filter("i <= j").filter(~_apart("i", "j", epsilon)).select("i", "j")
    pairs = stage(pairs, "pairs")
    children = lambda s: F.explode(F.transform(names, lambda k: F.col(s) * FAN + k)).alias(s)
    for lower in levels[-2::-1]:
        left = pairs.select(children("i"), F.col("j").alias("up")).join(side(lower, "i"), "i")
        wide = left.join(top.select(F.col("node").alias("up"), F.col("low").alias("low_up"), F.col("high").alias("high_up")), "up")
        near = wide.filter(~_apart("i", "up", epsilon)).select("i", "low_i", "high_i", F.explode(F.transform(names, lambda k: F.col("up") * FAN + k)).alias("j"))
        below = near.filter("i <= j").join(side(lower, "j"), "j").filter(~_apart("i", "j", epsilon)).select("i", "j")
        below = stage(below, "pairs")
        drop_table(pairs)
        pairs, top = below, lower
    return pairs


def _comparer(cosine: float, epsilon: float, width: int):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """One pair of strips: link counts (other = -1) and forest edges between nodes."""
        rows = rows.sort_values("block").drop_duplicates("block")
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        ids = [np.asarray(x) for x in rows["ids"]]
        weights = [np.asarray(x) for x in rows["weights"]]
        units = [np.frombuffer(x, np.float64).reshape(-1, width) for x in rows["data"]]
        low, high = np.stack(rows["low"].to_numpy()), np.stack(rows["high"].to_numpy())
        strip = rows["block"].to_numpy() // FAN
        at = np.cumsum([0, *map(len, ids)])
        nodes, links = np.concatenate(ids), np.zeros(at[-1], np.int64)
        label = np.arange(at[-1])
        for p in np.flatnonzero(strip == i):
            gap = np.maximum(0, np.maximum(low[p] - high, low - high[p]))
            near = (strip == j) & ((gap * gap).sum(axis=1) <= (epsilon + SLACK) ** 2)
            for q in np.flatnonzero(near):
                if q < p:
                    continue
                a, b = np.nonzero(units[p] @ units[q].T >= cosine)
                if p == q:
                    a, b = a[a != b], b[a != b]
                if not len(a):
                    continue
                links[at[p] : at[p + 1]] += np.bincount(a, weights[q][b], len(ids[p])).astype(np.int64)
                if p != q:
                    links[at[q] : at[q + 1]] += np.bincount(b, weights[p][a], len(ids[q])).astype(np.int64)
                label = smallest_labels(np.concatenate([a + at[p], np.arange(at[-1])]), np.concatenate([b + at[q], label]), at[-1])
        hit, child = np.flatnonzero(links), np.flatnonzero(label != np.arange(at[-1]))
        return pd.DataFrame({
            "node": np.concatenate([nodes[hit], nodes[child]]),
            "other": np.concatenate([np.full(len(hit), -1), nodes[label[child]]]),
            "links": np.concatenate([links[hit], np.zeros(len(child), np.int64)]),
        })

    return compare


def linked(vectors: DataFrame, cosine: float, width: int) -> DataFrame:
    """Link counts and forest edges over distinct vectors (node, weight, vector), written to the shared folder."""
    epsilon = math.sqrt(2 - 2 * cosine)
    blocks = pack(vectors, principal_axes(vectors, width), epsilon)
    pairs = interval_pairs(blocks, epsilon)
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("strip"))
    groups = sides.join(blocks.withColumn("strip", F.floor(F.col("block") / FAN)), "strip")
    found = stage(groups.groupBy("i", "j").applyInPandas(_comparer(cosine, epsilon, width), "node long, other long, links long"), "links")
    drop_table(blocks)
    return found


def near_duplicates(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``table`` (vec_id, embedding)."""
    x = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    valid = x.isNotNull() & F.forall(x, finite) & F.exists(x, lambda v: v != 0)
    rows = table.select("vec_id", F.when(F.coalesce(valid, F.lit(False)), x.cast("array<double>")).alias("vector"))
    distinct = rows.filter("vector is not null").groupBy("vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = None
    for r in distinct.select(F.size("vector").alias("n")).distinct().orderBy("n").collect():
        one = linked(distinct.filter(F.size("vector") == r.n).select("node", "weight", "vector"), cosine, r.n)
        found = one if found is None else found.unionAll(one)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.filter("other = -1").groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("other >= 0"), "node", "other")
    of = distinct.join(counts, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of = stage(of.select("vector", "weight", "first", F.coalesce("links", F.lit(0)).alias("links"), "component"), "classes")
    smallest = of.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of.join(smallest, "component").select("vector", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    drop_table(found)
    drop_table(distinct)
    out = rows.join(named, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
