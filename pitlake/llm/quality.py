"""Quality by a byte-level convolutional network, trained and run in numpy.

A text's UTF-8 bytes are read by ``FILTERS`` filters of ``WIDTH`` bytes every ``STRIDE`` bytes. Each
filter is maximum-pooled over chunks of 256 bytes that overlap by half and cover the whole text; a hidden layer
reads every chunk's pooled vector, its mean over the chunks gives one logit. Filters act on one-hot bytes, so
a response is a sum of table rows, and the gradient of a maximum touches one position only.

The network is fitted on at most ``PER_CLASS`` labelled documents of each label (a documented bound). Scoring is
one pass without a shuffle, in runs of ``RUN`` bytes, so a very long text needs no more memory than its own bytes.

Defined results: null and empty texts are one chunk of padding and get that chunk's score; without labels of
both kinds the score is the share of label 1, or 0.5 without labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import free_name, held_out, labelled_sample, whole

PER_CLASS = 1_500
FILTERS, HIDDEN, WIDTH, STRIDE, PLACES = 24, 16, 8, 4, 32
BLOCK = STRIDE * PLACES  # bytes of half a chunk
RUN = 1 << 18
EPOCHS, BATCH, RATE = 8, 32, 0.004
THRESHOLD = 0.3


@dataclass
class Net:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    shift: np.ndarray
    hidden: np.ndarray
    hidden_shift: np.ndarray
    out: np.ndarray
    out_shift: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.shift, self.hidden, self.hidden_shift, self.out, self.out_shift]


def fresh(seed: int = 1) -> Net:
    rng = np.random.default_rng(seed)
    draw = lambda *size, sd: rng.normal(0, sd, size).astype(np.float32)
    return Net(
        draw(WIDTH, 256, FILTERS, sd=0.15), np.zeros(FILTERS, np.float32),
        draw(FILTERS, HIDDEN, sd=FILTERS**-0.5), np.zeros(HIDDEN, np.float32),
        draw(HIDDEN, sd=HIDDEN**-0.5), np.zeros(1, np.float32),
    )


def padded(text: str) -> np.ndarray:
    """Bytes with zeros behind them, up to whole blocks and at least one filter width."""
    data = text.encode("utf-8", "replace")
    return np.frombuffer(data.ljust(-(-(len(data) + WIDTH) // BLOCK) * BLOCK, b"\0"), np.uint8)


def block_peaks(net: Net, data: np.ndarray, ends: np.ndarray, places: bool = False):
    """Largest response of each filter in each block, and where it was if asked for.

    ``data`` is followed by ``WIDTH`` bytes that the last positions may look at. The position before each
    of ``ends`` (of texts, in positions) sees only padding and the start of the next text, so it is left out.
    """
    n = (len(data) - WIDTH) // STRIDE
    response = np.zeros((n, FILTERS), np.float32)
    for j in range(WIDTH):
        response += net.table[j][data[j : j + n * STRIDE : STRIDE]]
    response[ends - 1] = -np.inf
    response = response.reshape(-1, PLACES, FILTERS)
    if not places:
        return response.max(axis=1) + net.shift, None
    at = response.argmax(axis=1)
    peaks = np.take_along_axis(response, at[:, None], axis=1)[:, 0] + net.shift
    return peaks, at + np.arange(len(at))[:, None] * PLACES


def chunk_layout(blocks_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second block of every chunk, and each document's chunk count."""
    chunks = np.maximum(1, blocks_of - 1)
    start = np.repeat(np.cumsum(blocks_of) - blocks_of, chunks)
    first = start + np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return first, first + np.repeat(blocks_of > 1, chunks), chunks


def _read(net: Net, peaks: np.ndarray) -> np.ndarray:
    return np.maximum(np.maximum(peaks, 0) @ net.hidden + net.hidden_shift, 0)


def score(net: Net, text: str) -> float:
    data = np.append(padded(text), np.zeros(WIDTH, np.uint8))
    total, chunks, carried = np.zeros(HIDDEN, np.float64), 0, None
    for at in range(0, len(data) - WIDTH, RUN):
        part = data[at : at + RUN + WIDTH]
        final = [(len(part) - WIDTH) // STRIDE] if at + RUN >= len(data) - WIDTH else []
        peaks, _ = block_peaks(net, part, np.array(final, np.int64))
        own = peaks if carried is None else np.concatenate([carried, peaks])
        carried = own[-1:]
        if len(own) > 1:
            total += _read(net, np.maximum(own[:-1], own[1:])).sum(axis=0, dtype=np.float64)
            chunks += len(own) - 1
    if not chunks:
        total, chunks = _read(net, carried)[0].astype(np.float64), 1
    return float(1 / (1 + np.exp(-(total / chunks @ net.out + net.out_shift[0]))))


def scores(net: Net, texts: list[str]) -> list[float]:
    """Scores of many texts; short ones share array operations."""
    out = np.empty(len(texts))
    rows = [padded(t) for t in texts]
    run: list[int] = []

    def flush() -> None:
        if not run:
            return
        sizes = np.array([len(rows[i]) for i in run])
        data = np.concatenate([*[rows[i] for i in run], np.zeros(WIDTH, np.uint8)])
        peaks, _ = block_peaks(net, data, np.cumsum(sizes) // STRIDE)
        first, second, chunks = chunk_layout(sizes // BLOCK)
        read = _read(net, np.maximum(peaks[first], peaks[second])).astype(np.float64)
        mean = np.add.reduceat(read, np.cumsum(chunks) - chunks) / chunks[:, None]
        out[run] = 1 / (1 + np.exp(-(mean @ net.out + net.out_shift[0])))
        run.clear()

    size = 0
    for i, row in enumerate(rows):
        if len(row) > RUN:
            out[i] = score(net, texts[i])
            continue
        if size + len(row) > RUN:
            flush()
            size = 0
        run.append(i)
        size += len(row)
    flush()
    return out.tolist()


def gradient(net: Net, docs: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    data = np.concatenate([*docs, np.zeros(WIDTH, np.uint8)])
    sizes = np.array([len(d) for d in docs])
    peaks, place = block_peaks(net, data, np.cumsum(sizes) // STRIDE, places=True)
    first, second, chunks = chunk_layout(sizes // BLOCK)
    later = peaks[second] > peaks[first]
    pooled = np.maximum(np.where(later, peaks[second], peaks[first]), 0)
    place = np.where(later, place[second], place[first])
    read = np.maximum(pooled @ net.hidden + net.hidden_shift, 0)
    mean = np.add.reduceat(read, np.cumsum(chunks) - chunks) / chunks[:, None]
    p = 1 / (1 + np.exp(-(mean @ net.out + net.out_shift[0])))
    pull = ((p - labels) / len(labels)).astype(np.float32)
    d_read = np.repeat(pull[:, None] * net.out / chunks[:, None], chunks, axis=0) * (read > 0)
    d_pooled = (d_read @ net.hidden.T) * (pooled > 0)
    filters = np.broadcast_to(np.arange(FILTERS), place.shape)
    table = np.empty_like(net.table)
    for j in range(WIDTH):
        cell = data[place * STRIDE + j].astype(np.int64) * FILTERS + filters
        table[j] = np.bincount(cell.ravel(), d_pooled.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return [table, d_pooled.sum(0), pooled.T @ d_read, d_read.sum(0), mean.T @ pull, np.array([pull.sum()])]


def fit(sample: list[tuple[str, int]]) -> Net | None:
    labels = np.array([y for _, y in sample], dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    docs = [padded(text) for text, _ in sample]
    net, rng, step = fresh(), np.random.default_rng(2), 0
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in net.parts()]
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), BATCH):
            some, step = order[at : at + BATCH], step + 1
            grads = gradient(net, [docs[i] for i in some], labels[some])
            for x, g, (m, v) in zip(net.parts(), grads, state, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(x.dtype)
    return net


def scorer(docs: DataFrame, labels: DataFrame, label: str = "quality"):
    """Fit once; gives a function that adds the score column to any table of texts."""
    sample = labelled_sample(docs, labels, label, PER_CLASS)
    net = fit(sample)
    share = float(np.mean([y for _, y in sample])) if sample else 0.5
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(texts: pd.Series) -> pd.Series:
        if shared.value is None:
            return pd.Series([share] * len(texts), dtype="float64")
        return pd.Series(scores(shared.value, whole(texts)), dtype="float64")

    return lambda table, text="text", output="quality": table.withColumn(
        output, F.pandas_udf(run, "double")(F.col(text))
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    name = free_name(docs, "score")
    return scorer(docs, labels)(docs.select("doc_id", "text"), output=name).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col(name).alias("score"),
        (F.col(name) >= THRESHOLD).cast("int").alias("predicted"),
    )
