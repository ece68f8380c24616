"""Toxicity by multiple-instance learning: sentence scores under a noisy-or, trained from document labels.

A sentence's probability is a logistic function of its distinct words and their first four and five bytes; a document is toxic if any of its sentences
is: P = 1 - prod(1 - p). Only documents carry labels, so the gradient reaches the sentences through
that formula, which is what lets the model name the offending ones afterwards.

The classifier is fitted on at most ``PER_CLASS`` labelled documents of each label (a documented bound), in
numpy; scoring is one pass over whole texts without a shuffle. The lexicon that is shipped holds
only words that at least ``LEAST_DOCS`` sample documents have, so its size is bounded by the sample.

Defined results: null and empty texts have no sentence and score 0; without labels of both kinds nothing can be learned
and every score is 0; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import free_name, held_out, labelled_sample, whole

PER_CLASS = 3_000
LEAST_DOCS, LEAST_Z = 4, 5.0
KEPT = 100_000
STEPS, RATE, DECAY = 300, 0.1, 1e-4
THRESHOLD = 0.5
ENDS = ".!?\n"
#: Sentence ends become line feeds, other ASCII marks spaces; letters, digits and non-ASCII bytes stay.
PLAIN = bytes(
    10 if chr(b) in ENDS else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)
)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[bytes, float]


def features(word: bytes) -> tuple[bytes, ...]:
    """A word, and its beginnings, which words of one stem share."""
    return (word, word[:4] + b"*", word[:5] + b"*")


def sentences(text: str) -> list[list[bytes]]:
    return [s.split() for s in text.lower().encode("utf-8", "replace").translate(PLAIN).split(b"\n")]


def informative(docs: list[list[list[bytes]]], labels: np.ndarray) -> list[bytes]:
    """Words whose document frequency differs between the labels beyond chance."""
    counts = [Counter(), Counter()]
    for doc, y in zip(docs, labels, strict=True):
        counts[y].update({f for w in {w for s in doc for w in s} for f in features(w)})
    n0, n1 = np.bincount(labels, minlength=2)
    kept = []
    for word in sorted(counts[0].keys() | counts[1].keys()):
        a, b = counts[0][word], counts[1][word]
        if a + b >= LEAST_DOCS:
            p = (a + b + 1) / (n0 + n1 + 2)
            if abs(b / n1 - a / n0) >= LEAST_Z * math.sqrt(p * (1 - p) * (1 / n0 + 1 / n1)):
                kept.append(word)
    return kept


def fit(sample: list[tuple[str, int]]) -> Model | None:
    labels = np.array([y for _, y in sample], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    docs = [[s for s in sentences(text) if s] or [[]] for text, _ in sample]
    words = informative(docs, labels)
    index = {w: i for i, w in enumerate(words)}
    sizes = np.array([len(d) for d in docs])
    feature, owner, n = [], [], 0
    for doc in docs:
        for sentence in doc:
            found = [index[f] for w in set(sentence) for f in features(w) if f in index]
            feature += found
            owner += [n] * len(found)
            n += 1
    feature, owner = np.array(feature, np.int64), np.array(owner, np.int64)
    first = np.cumsum(sizes) - sizes
    params, m, v = np.zeros(len(words) + 1), 0.0, 0.0
    params[-1] = -5.0
    for step in range(1, STEPS + 1):
        z = params[-1] + np.bincount(owner, params[feature], n)
        log_clean = np.add.reduceat(-np.logaddexp(0, z), first)
        toxic = np.clip(-np.expm1(log_clean), 1e-6, 1)
        pull = np.where(labels == 1, (toxic - 1) / toxic, 1.0) / len(labels)
        dz = np.repeat(pull, sizes) / (1 + np.exp(-z))
        grad = np.append(np.bincount(feature, dz[owner], len(words)), dz.sum()) + DECAY * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Model(float(params[-1]), dict(zip(words, params[:-1].tolist(), strict=True)))


class _Words(dict):
    """Total weight of a word's features; emptied when it holds ``KEPT`` words."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KEPT:
            self.clear()
        total = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return total


def score(text: str, bias: float, weight: _Words) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability of the text, and (start, end, p) of its offending sentences in code points."""
    log_clean, bad = 0.0, []
    for i, words in enumerate(sentences(text)):
        if words:
            z = bias + math.fsum(map(weight.__getitem__, set(words)))
            log_clean -= max(z, 0.0) + math.log1p(math.exp(-abs(z)))
            if z >= 0:
                bad.append((i, 1 / (1 + math.exp(-z))))
    spans = []
    if bad:
        ends = [-1, *(m.start() for m in re.finditer(f"[{re.escape(ENDS)}]", text)), len(text)]
        spans = [(ends[i] + 1, ends[i + 1], p) for i, p in bad]
    return float(-math.expm1(log_clean)), spans


OUT = "struct<score:double,sentences:array<struct<start:long,end:long,p:double>>>"


def scorer(docs: DataFrame, labels: DataFrame, label: str = "toxic"):
    """Fit once; gives a function that adds the score column to any table of texts."""
    model = fit(labelled_sample(docs, labels, label, PER_CLASS)) or Model(-math.inf, {})

    def run(texts: pd.Series) -> pd.DataFrame:
        rows, weight = [], _Words(model.weights)
        for text in whole(texts):
            p, spans = score(text, model.bias, weight) if model.weights else (0.0, [])
            rows.append((p, [{"start": a, "end": b, "p": q} for a, b, q in spans]))
        return pd.DataFrame(rows, columns=["score", "sentences"])

    return lambda table, text="text", output="toxicity": table.withColumn(
        output, F.pandas_udf(run, OUT)(F.col(text))
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    name = free_name(docs, "toxicity")
    return scorer(docs, labels)(docs.select("doc_id", "text"), output=name).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col(f"{name}.score"),
        (F.col(f"{name}.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col(f"{name}.sentences"),
    )
