"""Masked pseudo-likelihood scoring with a bidirectional window network trained in numpy.

Texts are sequences of pieces: a word (lower case, after one space) is one piece if it is among the most frequent
words, else it is spelled by the longest pieces that fit, down to single bytes. So no word is unknown, different words
have different spellings, and each has its own probability however many words the corpus has. Words and the pieces
of the others are counted over all documents. Each piece is predicted from the ``REACH`` pieces on either side,
itself masked; a document's log-probability is the sum over all its pieces, its score that sum for each word. The output
is a two-level softmax (class, then piece in its class), so a prediction costs two small products.

Training is data-parallel and covers the whole corpus: each task trains a copy of the network on every position of
all its documents, in each of ``ROUNDS`` passes, in batches that grow while it learns, and the copies are averaged, weighted by
positions, in a tree of shuffled groups. Only the vocabulary and one model, both of fixed size, come to the driver.

Defined results: null and empty texts have no tokens, log-probability 0 and score 0; an empty corpus has an empty
vocabulary and no rows. Repeated rows score alike. Scores depend slightly on how the corpus is partitioned, as
any data-parallel training does.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import blocks, drop_table, free_name, whole
from pitlake.session import stage

CLASSES = 64
SIZE = CLASSES * CLASSES
PAD, BYTES = 0, 256  # entry 0 stands outside the text, the next BYTES are single bytes
PIECES, LONGEST = 1024, 4  # pieces of 2 to LONGEST bytes that spell the words without an entry
WORDS = SIZE - 1 - BYTES - PIECES
KEPT, KEPT_CHARS = 300_000, 64  # spellings that a worker keeps, and the longest word among them
REACH, WIDTH = 2, 16
BATCH, LARGEST, RATE, ROUNDS = 2048, 16384, 0.02, 2  # batches grow while a task learns
HELD = 32 * BATCH  # positions that a task gathers and shuffles at a time
CHUNK, FAN = 8192, 64
OFFSETS = [j for j in range(-REACH, REACH + 1) if j]
SHAPES = [(len(OFFSETS), SIZE, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES, WIDTH, CLASSES), (CLASSES,), (CLASSES, CLASSES)]


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _count(batches):
    for batch in batches:
        counts = Counter()
        for text in whole(batch["text"]):
            counts.update(words_of(text))
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})


def _spelled(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass")


def _count_pieces(known: frozenset[str]):
    """Counts of the runs of 2 to ``LONGEST`` bytes in the words without an entry, each packed into a number."""

    def counted(spelled: list[bytes], times: list[int]):
        sizes = np.array([len(w) for w in spelled])
        joined = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))
        weight = np.repeat(np.array(times, np.float64), sizes)
        code = joined
        for size in range(2, LONGEST + 1):
            code = code[:-1] * 256 + joined[size - 1 :]
            at = np.flatnonzero(left[: len(code)] >= size)
            kinds, where = np.unique(code[at], return_inverse=True)
            n = np.bincount(where, weight[at], minlength=len(kinds)).astype(np.int64)
            yield pd.DataFrame({"size": np.full(len(kinds), size), "code": kinds, "n": n})

    def count(batches):
        spelled, times, held = [], [], 0
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"], strict=True):
                if word not in known:
                    spelled.append(_spelled(word))
                    times.append(n)
                    held += len(spelled[-1])
                if held >= 1 << 20:
                    yield from counted(spelled, times)
                    spelled, times, held = [], [], 0
        if spelled:
            yield from counted(spelled, times)

    return count


def vocabulary(docs: DataFrame) -> list[bytes]:
    """The most frequent words of all documents, ties by the word, and the pieces that save most in spelling the others."""
    counts = docs.select("text").mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(counts, "words")
    words = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    runs = counts.mapInPandas(_count_pieces(frozenset(words)), "size long, code long, n long").groupBy("size", "code").agg(F.sum("n").alias("n"))
    pieces = runs.orderBy(F.desc(F.col("n") * (F.col("size") - 1)), "size", "code").limit(PIECES).collect()
    drop_table(counts)
    return list(dict.fromkeys([*map(_spelled, words), *(r.code.to_bytes(r.size, "big") for r in pieces)]))


class _Index(dict):
    """Entries that spell a word. Spellings of words without an entry of their own are kept up to a bound.

    Texts are spelled many words at a time: a word is a number, its entries are a piece of one array.
    """

    def __init__(self, entries: list[bytes]):
        self.entries = {bytes([i]): 1 + i for i in range(BYTES)} | {e: 1 + BYTES + i for i, e in enumerate(entries)}
        of_size = [sorted(e for e in self.entries if len(e) == n) for n in range(LONGEST + 1)]
        self.codes = [np.array([int.from_bytes(e, "big") for e in same], np.int64) for same in of_size]
        self.places = [np.array([self.entries[e] for e in same], np.int64) for same in of_size]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.uint16), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> tuple[int, ...]:
        text, entries = _spelled(word), self.entries
        out, at = [], 0
        if text in entries:
            out, at = [entries[text]], len(text)
        while at < len(text):
            size = next(n for n in range(min(LONGEST, len(text) - at), 0, -1) if text[at : at + n] in entries)
            out.append(entries[text[at : at + size]])
            at += size
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[word] = tuple(out)
        return tuple(out)

    def _spell(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the words side by side, and how many each has: the longest that fits at each byte, then jumps from word to word."""
        texts = [_spelled(w) for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        until = np.cumsum(sizes)
        n = int(until[-1])
        bytes_ = np.frombuffer(b"".join(texts) + bytes(LONGEST), np.uint8).astype(np.int64)
        left = np.repeat(until, sizes) - np.arange(n)
        step, entry, code = np.ones(n, np.int64), 1 + bytes_[:n], bytes_[:n]
        for size in range(2, LONGEST + 1):
            code = code * 256 + bytes_[size - 1 : size - 1 + n]
            if len(self.codes[size]):
                at = np.minimum(np.searchsorted(self.codes[size], code), len(self.codes[size]) - 1)
                fits = np.flatnonzero((self.codes[size][at] == code) & (left >= size))
                step[fits], entry[fits] = size, self.places[size][at[fits]]
        starts = until - sizes
        own = [(i, e) for i, e in enumerate(map(self.entries.get, texts)) if e is not None]
        if own:
            of = np.array(own, np.int64)
            step[starts[of[:, 0]]], entry[starts[of[:, 0]]] = sizes[of[:, 0]], of[:, 1]
        taken, at, ends = np.zeros(n, bool), starts, until
        while len(at):
            taken[at] = True
            at = at + step[at]
            going = at < ends
            at, ends = at[going], ends[going]
        return entry[taken].astype(np.uint16), np.add.reduceat(taken, starts, dtype=np.int64)

    def spell(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of all texts side by side, how many entries each text has, and how many words."""
        if len(self.numbers) > KEPT:
            self.forget()
        rows = list(map(words_of, texts))
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        words = list(chain.from_iterable(rows))
        new = [w for w in dict.fromkeys(words) if w not in self.numbers]
        short = [w for w in new if len(w) <= KEPT_CHARS]
        long = [w for w in new if len(w) > KEPT_CHARS]
        parts, ends = [self.ids], [self.ends]
        if short:
            ids, sizes = self._spell(short)
            parts.append(ids)
            ends.append(ends[-1][-1] + np.cumsum(sizes))
        for word in long:  # few: stepped through one by one, and forgotten with this call
            parts.append(np.array(self[word], np.uint16))
            ends.append(ends[-1][-1:] + len(parts[-1]))
        self.numbers.update(zip([*short, *long], range(len(self.ends) - 1, len(self.ends) - 1 + len(new)), strict=True))
        ids, until = np.concatenate(parts), np.concatenate(ends)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        for word in long:
            del self.numbers[word]
        kept = len(until) - len(long)
        self.ids, self.ends = ids[: until[kept - 1]], until[:kept]
        sizes = until[numbers + 1] - until[numbers]
        total = np.concatenate([[0], np.cumsum(sizes)])
        out = ids[np.arange(total[-1]) + np.repeat(until[numbers] - total[:-1], sizes)]
        words_until = np.cumsum(counts)
        return out, total[words_until] - total[words_until - counts], counts


def index_of(entries: list[bytes]) -> _Index:
    return _Index(entries)


def fresh() -> list[np.ndarray]:
    rng = np.random.default_rng(3)
    return [rng.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 and s != (CLASSES, CLASSES) else np.zeros(s, np.float32) for s in SHAPES]


def flat(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def shaped(vector: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for s in SHAPES:
        n = int(np.prod(s))
        out.append(vector[at : at + n].reshape(s))
        at += n
    return out


def _logits(weight: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(outcomes, positions), the largest of each position 0."""
    z = weight.T @ h
    z += bias[:, None]
    z -= z.max(axis=0)
    return z


def _softmax(weight: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    z = _logits(weight, bias, h)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def _log_of(weight: np.ndarray, bias: np.ndarray, h: np.ndarray, outcome: np.ndarray) -> np.ndarray:
    """Log-probability of one outcome at each position."""
    z = _logits(weight, bias, h)
    own = z[outcome, np.arange(len(outcome))].astype(np.float64)
    return own - np.log(np.exp(z, out=z).sum(axis=0))


def hidden(params, around: np.ndarray) -> np.ndarray:
    """(WIDTH, positions): columns side by side, so that every step runs along the positions."""
    h = params[1] + np.take(params[0][0], around[0], axis=0)
    for j in range(1, len(OFFSETS)):
        h += np.take(params[0][j], around[j], axis=0)
    h = np.ascontiguousarray(h.T)
    return np.tanh(h, out=h)


def _by_class(around: np.ndarray, target: np.ndarray):
    """The positions sorted by the class of their target, their order, and where each class begins."""
    order = np.argsort((target // CLASSES).astype(np.uint8), kind="stable")
    target = target[order]
    group, place = target // CLASSES, target % CLASSES
    return order, np.take(around, order, axis=1), group, place, np.searchsorted(group, np.arange(CLASSES + 1)).tolist()


def predict(params, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target between its neighbours."""
    order, around, group, place, ends = _by_class(around, target)
    h = hidden(params, around)
    found = _log_of(params[2], params[4], h, group)
    for c in range(CLASSES):
        rows = slice(ends[c], ends[c + 1])
        if ends[c] < ends[c + 1]:
            found[rows] += _log_of(params[3][c], params[5][c], h[:, rows], place[rows])
    out = np.empty_like(found)
    out[order] = found
    return out


def windows(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Neighbours of the positions ``at`` of a padded sequence."""
    return np.stack([ids[at + REACH + j] for j in OFFSETS])


def positions(n: int) -> list[np.ndarray]:
    """Every position of a text of ``n`` pieces, at most ``HELD`` at a time."""
    return [np.arange(i, min(i + HELD, n)) for i in range(0, n, HELD)]


def gradient(params, around: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    _, around, group, place, ends = _by_class(around, target)
    h, n = hidden(params, around), len(target)
    every, grads = np.arange(n), [np.zeros_like(p) for p in params]
    d = _softmax(params[2], params[4], h)
    d[group, every] -= 1
    grads[2], grads[4] = h @ d.T, d.sum(axis=1)
    dh = params[2] @ d
    for c in range(CLASSES):
        rows = slice(ends[c], ends[c + 1])
        if ends[c] < ends[c + 1]:
            own = h[:, rows]
            e = _softmax(params[3][c], params[5][c], own)
            e[place[rows], every[: own.shape[1]]] -= 1
            grads[3][c], grads[5][c] = own @ e.T, e.sum(axis=1)
            dh[:, rows] += params[3][c] @ e
    dh *= 1 - h * h
    grads[1] = dh.sum(axis=1)
    at = (around + SIZE * np.arange(len(OFFSETS))[:, None]).ravel()
    sums = [np.bincount(at, np.tile(row, len(OFFSETS)), len(OFFSETS) * SIZE) for row in dh.astype(np.float64)]
    grads[0] = np.stack(sums, axis=1).astype(np.float32).reshape(SHAPES[0])
    for g in grads:
        g /= n
    return grads


def _trainer(shared):
    def train(batches):
        from pyspark import TaskContext

        entries, start = shared.value
        params, seen = [p.copy() for p in start], 0
        squares = [np.full_like(p, 1e-8) for p in params]
        held_around, held_target, held = [], [], 0

        def learn():
            nonlocal held
            around, target = np.concatenate(held_around, axis=1), np.concatenate(held_target)
            order = np.random.default_rng(len(target)).permutation(len(target))
            size = min(LARGEST, BATCH * max(1, seen // HELD))
            for i in range(0, len(order), size):
                some = order[i : i + size]
                for p, g, s in zip(params, gradient(params, np.take(around, some, axis=1), target[some]), squares, strict=True):
                    s *= 0.99
                    s += 0.01 * np.square(g)
                    g /= np.sqrt(s) + 1e-6
                    g *= RATE
                    p -= g
            held_around.clear()
            held_target.clear()
            held = 0

        for batch in batches:
            for joined, own, _ in _sequences(batch, entries):
                for some in positions(len(own)):
                    at = own[some]
                    held_around.append(windows(joined, at))
                    held_target.append(joined[at + REACH])
                    held += len(at)
                    seen += len(at)
                    if held >= HELD:
                        learn()
        if held:
            learn()
        if seen:
            vector, part = flat(params), TaskContext.get().partitionId()
            pieces = [vector[i : i + CHUNK] for i in range(0, len(vector), CHUNK)]
            yield pd.DataFrame({"chunk": range(len(pieces)), "part": part, "weight": float(seen), "vector": pieces})

    return train


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    weight = rows["weight"].sum()
    total = sum(np.asarray(v, np.float64) * w for v, w in zip(rows["vector"], rows["weight"], strict=True))
    one = rows.iloc[:1].copy()
    one["weight"], one["vector"] = weight, [(total / weight).astype(np.float32)]
    return one


def _joined(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Padded entries of texts side by side and the positions among them, from all entries and how many each text has."""
    at = np.arange(len(ids)) + np.repeat(2 * REACH * np.arange(len(sizes)), sizes)
    joined = np.full(len(ids) + 2 * REACH * len(sizes), PAD, np.int64)
    joined[at + REACH] = ids
    return joined, at


def _sequences(batch: pd.DataFrame, entries: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Padded entries, positions and sizes of runs of texts, which come as ``pieces`` or still as ``text``."""
    if "pieces" in batch:
        for some in blocks(list(batch["pieces"])):
            sizes = np.fromiter(map(len, some), np.int64, len(some)) // 2
            yield *_joined(np.frombuffer(b"".join(some), "<u2"), sizes), sizes
    else:
        index = index_of(entries)
        for texts in blocks(whole(batch["text"])):
            ids, sizes, _ = index.spell(texts)
            yield *_joined(ids, sizes), sizes


def spelled(docs: DataFrame, entries: list[bytes], text: str, output: str) -> DataFrame:
    """``docs`` with its word count and its entries as 16-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = index_of(shared.value)
        for texts in batches:
            rows = []
            for block in blocks(whole(texts)):
                ids, sizes, words = index.spell(block)
                ids, until = ids.astype("<u2", copy=False), np.cumsum(sizes).tolist()
                rows += [(n, ids[a:b].tobytes()) for n, a, b in zip(words.tolist(), [0, *until], until, strict=False)]
            yield pd.DataFrame(rows, columns=["n_tokens", "pieces"])

    return docs.withColumn(output, F.pandas_udf(run, "struct<n_tokens:long,pieces:binary>")(F.col(text)))


def train(docs: DataFrame, entries: list[bytes]) -> list[np.ndarray]:
    """The network after all rounds over ``docs``, whose only column is ``pieces`` or ``text``."""
    context, params = docs.sparkSession.sparkContext, fresh()
    kind = "chunk int, part int, weight double, vector array<float>"
    for _ in range(ROUNDS):
        copies = docs.mapInPandas(_trainer(context.broadcast((entries, params))), kind)
        partial = copies.withColumn("part", F.pmod("part", F.lit(FAN))).groupBy("chunk", "part").applyInPandas(_mean, kind)
        found = partial.groupBy("chunk").applyInPandas(_mean, kind).orderBy("chunk").collect()
        if found:
            params = shaped(np.concatenate([np.asarray(r.vector, np.float32) for r in found]))
    return params


def _scores(joined: np.ndarray, at: np.ndarray, sizes: np.ndarray, params) -> list[float]:
    logs = np.zeros(len(at))
    for some in positions(len(at)):
        logs[some] = predict(params, windows(joined, at[some]), joined[at[some] + REACH])
    until = np.concatenate([[0.0], np.cumsum(logs)])
    ends = np.cumsum(sizes)
    return (until[ends] - until[ends - sizes]).tolist()


def score_texts(texts: list[str], params, index: _Index) -> list[tuple[int, float]]:
    ids, sizes, words = index.spell(texts)
    return list(zip(words.tolist(), _scores(*_joined(ids, sizes), sizes, params), strict=True))


def scored(docs: DataFrame, text: str = "text", output: str = "lm", drop: bool = False) -> DataFrame:
    """``docs`` with word count and summed log-probability under a network trained on ``docs``; ``drop``: without the texts.

    The texts are spelled once; training and scoring read their entries from a table.
    """
    entries = vocabulary(docs.select(F.col(text).alias("text")))
    table = spelled(docs, entries, text, output)
    table = stage(table.drop(text) if drop else table, "pieces")
    pieces = F.col(f"{output}.pieces")
    shared = docs.sparkSession.sparkContext.broadcast((entries, train(table.select(pieces.alias("pieces")), entries)))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        entries, params = shared.value
        for batch in batches:
            yield pd.Series([x for found in _sequences(batch.to_frame("pieces"), entries) for x in _scores(*found, params)], dtype="float64")

    log_prob = F.pandas_udf(run, "double")(pieces)
    return table.withColumn(output, F.struct(F.col(f"{output}.n_tokens").alias("n_tokens"), log_prob.alias("log_prob")))


def report(docs: DataFrame) -> DataFrame:
    name = free_name(docs, "lm")
    n, total = F.col(f"{name}.n_tokens"), F.col(f"{name}.log_prob")
    return scored(docs.select("doc_id", "text"), output=name, drop=True).select(
        "doc_id", n.alias("n_tokens"), total.alias("log_prob"), F.when(n > 0, total / n).otherwise(0.0).alias("score")
    )
