"""Bootstrap intervals from replicate vectors: a row meets the weights of all replicates inside an Arrow batch.

A row's weight in a replicate is Poisson(1), from a hash of its key and the replicate's number; it repeats on any
partitioning and in any engine with 32-bit arithmetic. In a task the weights are a matrix, rows by
replicates, a block of rows at a time; what leaves it are vectors of partial sums, so nothing is written for each row and
replicate. For the area under the curve rows are range-partitioned by score; a partition walks its scores in order and
returns, for every replicate, its positives, its negatives and its ordered pairs, and the partitions combine in order. A score that
is frequent in a batch is one pair of vectors before the shuffle, so a hot score is not carried row by row.

Defined results: rows without a key or value do not count; a replicate without both labels has no area; repeated keys
share their weights; an empty table has no interval (nulls).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2_048
FREQUENT = 64  # rows of one score in a batch that become vectors


def words_of(text: str) -> tuple[int, int]:
    """Two 32-bit words of the MD5 digest of a text: the first sixteen hexadecimal digits."""
    digest = hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()
    return int(digest[:8], 16), int(digest[8:16], 16)


def spread_bits(h: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, held as 64-bit ones."""
    h = h ^ (h >> np.uint64(16))
    h = (h * np.uint64(0x7FEB352D)) & np.uint64(0xFFFFFFFF)
    h = h ^ (h >> np.uint64(15))
    h = (h * np.uint64(0x846CA68B)) & np.uint64(0xFFFFFFFF)
    return h ^ (h >> np.uint64(16))


def thresholds() -> list[int]:
    """Points of the 32-bit range at which the Poisson(1) weight grows by one."""
    p = below = math.exp(-1.0)
    points = []
    for k in range(1, 13):
        points.append(round(below * 2**32))
        p /= k
        below += p
    return points


STEPS = np.array(thresholds(), np.uint64)


def seeds(replicates: int, seed: int) -> np.ndarray:
    """Two words for each replicate."""
    return np.array([words_of(f"{seed}:{r}") for r in range(replicates)], np.uint64).reshape(-1, 2)


def weights(first: np.ndarray, second: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Matrix rows x replicates of weights, from the two words of each row and of each replicate."""
    h = spread_bits(first.astype(np.uint64)[:, None] ^ of[:, 0])
    h = spread_bits(h ^ second.astype(np.uint64)[:, None] ^ of[:, 1])
    return np.searchsorted(STEPS, h.ravel(), side="right").reshape(h.shape).astype(np.float64)


def _keyed(df: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    word = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return df.filter(F.col(key).isNotNull()).select(word(1).alias("_w1"), word(9).alias("_w2"), *columns)


def _blocks(batches):
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            yield batch.iloc[at : at + BLOCK_ROWS]


def _interval(stats: DataFrame, alpha: float) -> tuple[float | None, float | None]:
    ends = [F.percentile("stat", F.lit(p)) for p in (alpha / 2, 1 - alpha / 2)]
    return tuple(stats.agg(*ends).first())


def mean_ci(
    df: DataFrame, loss: Column, key: str = "case_id", replicates: int = 500, seed: int = 42, alpha: float = 0.05
) -> tuple[float | None, float | None]:
    """Percentile interval of a mean loss (mean absolute error, Brier score)."""
    of = seeds(replicates, seed)

    def sums(batches):
        above, below = np.zeros(replicates), np.zeros(replicates)
        for rows in _blocks(batches):
            w = weights(rows["_w1"].to_numpy(), rows["_w2"].to_numpy(), of)
            above += rows["_loss"].to_numpy() @ w
            below += w.sum(axis=0)
        yield pd.DataFrame({"above": [above.tolist()], "below": [below.tolist()]})

    rows = _keyed(df, key, [loss.cast("double").alias("_loss")]).filter("_loss IS NOT NULL")
    parts = rows.mapInPandas(sums, "above array<double>, below array<double>")
    each = parts.select(F.posexplode(F.arrays_zip("above", "below")).alias("rep", "x"))
    stats = each.groupBy("rep").agg(F.try_divide(F.sum("x.above"), F.sum("x.below")).alias("stat"))
    return _interval(stats, alpha)


def _by_score(of: np.ndarray):
    """Rows as they are, or as the vectors of their score if the batch has many of it."""
    zero = bytes(8 * len(of))

    def fold(batches):
        for batch in batches:
            score = batch["score"].to_numpy()
            value, place, n = np.unique(score, return_inverse=True, return_counts=True)
            often = n[place] >= FREQUENT
            yield batch[~often].assign(pos=None, neg=None)
            for v in np.flatnonzero(n >= FREQUENT):
                pos, neg = np.zeros(len(of)), np.zeros(len(of))
                for rows in _blocks([batch[place == v]]):
                    w = weights(rows["_w1"].to_numpy(), rows["_w2"].to_numpy(), of)
                    one = rows["label"].to_numpy() == 1
                    pos += w[one].sum(axis=0)
                    neg += w[~one].sum(axis=0)
                yield pd.DataFrame({"_w1": [0], "_w2": [0], "score": [value[v]], "label": [0], "pos": [pos.tobytes()], "neg": [neg.tobytes() or zero]})

    return fold


def _walk(of: np.ndarray):
    """A partition's positives, negatives and ordered pairs for each replicate; rows come sorted by score."""

    def area(batches):
        shape = len(of)
        wins, before = np.zeros(shape), np.zeros(shape)  # pairs so far; negatives at smaller scores
        tie, pos, neg, all_pos, start = None, np.zeros(shape), np.zeros(shape), np.zeros(shape), None
        for rows in _blocks(batches):
            score = rows["score"].to_numpy()
            w = weights(rows["_w1"].to_numpy(), rows["_w2"].to_numpy(), of)
            one = (rows["label"].to_numpy() == 1)[:, None]
            p, q = np.where(one, w, 0.0), np.where(one, 0.0, w)
            for i in np.flatnonzero(rows["pos"].notna().to_numpy()):
                p[i], q[i] = np.frombuffer(rows["pos"].iloc[i]), np.frombuffer(rows["neg"].iloc[i])
            edge = np.flatnonzero(np.concatenate([[True], score[1:] != score[:-1]]))
            p, q = np.add.reduceat(p, edge), np.add.reduceat(q, edge)
            start = score[0] if start is None else start
            if tie == score[0]:
                p[0] += pos
                q[0] += neg
            elif tie is not None:
                wins, before, all_pos = wins + pos * (before + neg / 2), before + neg, all_pos + pos
            done_p, done_q = p[:-1], q[:-1]  # the last score may go on in the next block
            wins = wins + (done_p * (before + np.cumsum(done_q, axis=0) - done_q / 2)).sum(axis=0)
            before, all_pos = before + done_q.sum(axis=0), all_pos + done_p.sum(axis=0)
            tie, pos, neg = score[-1], p[-1].copy(), q[-1].copy()
        if tie is not None:
            wins, before, all_pos = wins + pos * (before + neg / 2), before + neg, all_pos + pos
            yield pd.DataFrame({"start": [start], "pos": [all_pos.tolist()], "neg": [before.tolist()], "wins": [wins.tolist()]})

    return area


def auc_ci(
    df: DataFrame, y: str, proba: str, key: str = "case_id", replicates: int = 500, seed: int = 42, alpha: float = 0.05
) -> tuple[float | None, float | None]:
    """Percentile interval of ROC AUC; a tied pair counts half."""
    of = seeds(replicates, seed)
    rows = _keyed(df, key, [F.col(proba).cast("double").alias("score"), F.col(y).cast("int").alias("label")]).filter(
        "score IS NOT NULL AND label IS NOT NULL"
    )
    folded = rows.mapInPandas(_by_score(of), "_w1 long, _w2 long, score double, label int, pos binary, neg binary")
    ordered = folded.repartitionByRange("score").sortWithinPartitions("score")
    parts = ordered.mapInPandas(_walk(of), "start double, pos array<double>, neg array<double>, wins array<double>")
    each = parts.select("start", F.posexplode(F.arrays_zip("pos", "neg", "wins")).alias("rep", "x"))
    # For each replicate: one row a partition, in the order of scores.
    inside = F.array_sort(F.collect_list(F.struct("start", "x")))
    zero = F.struct(F.lit(0.0).alias("neg"), F.lit(0.0).alias("pos"), F.lit(0.0).alias("wins"))
    joined = F.aggregate(
        inside, zero,
        lambda a, b: F.struct(
            (a["neg"] + b["x"]["neg"]).alias("neg"), (a["pos"] + b["x"]["pos"]).alias("pos"),
            (a["wins"] + b["x"]["wins"] + b["x"]["pos"] * a["neg"]).alias("wins"),
        ),
    )
    total = each.groupBy("rep").agg(joined.alias("t"))
    return _interval(total.select(F.try_divide("t.wins", F.col("t.pos") * F.col("t.neg")).alias("stat")), alpha)
