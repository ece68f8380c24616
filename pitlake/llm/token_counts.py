"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one numpy array of symbols. Each round finds every
sequence's lowest-rank pair (``minimum.reduceat``), merges its occurrences in all sequences at once, and
looks up only the ranks beside the merges. A sequence without a pair left is done: its surviving symbols
are its count. The counts of pre-tokens seen before are remembered up to a bound.

Occurrences of one rank in one sequence merge together, since a token's uses normally come later in the
merge list than the token itself; where a list breaks that order, such a rank merges its leftmost occurrence
only. A sequence longer than ``LONG`` symbols keeps its positions by rank instead of scanning all symbols in
each round, so a text without any space costs time in proportion to its length.

Defined results: null and empty texts have no bytes and no tokens; a special string inside a text is one
token, as in the library. Whole texts of any length count; repeated rows each get their count; an empty
table gives an empty result; other columns are kept, and ``count`` replaces a column named as its output.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm import vocabulary
from pitlake.llm.common import blocks, free_name, whole

LIMIT = 512
CACHED = 600_000  # chunks whose counts a worker remembers; a full store is emptied
LONG = 2_000  # symbols from which a sequence is merged by its positions of each rank
NONE = np.int32(2**31 - 1)


def apart(hits: np.ndarray) -> np.ndarray:
    """Of ascending places of one pair, those that merge: in a row of overlapping ones every second."""
    new = np.ones(len(hits), bool)
    new[1:] = np.diff(hits) != 1
    place = np.arange(len(hits))
    return hits[(place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0]


class Merger:
    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab = vocab
        left, right, product = np.array(vocab.merges, dtype=np.int64).T
        key = left << 32 | right
        self.order = np.argsort(key)
        self.keys = np.append(key[self.order], np.int64(2**62))
        self.order = self.order.astype(np.int32)
        self.product = product
        first_use = np.full(int(max(left.max(), right.max(), product.max())) + 1, len(product))
        np.minimum.at(first_use, left, np.arange(len(product)))
        np.minimum.at(first_use, right, np.arange(len(product)))
        #: Ranks whose product is used by an earlier merge.
        self.singly = first_use[product] <= np.arange(len(product))
        self.symbol = np.array([vocab.byte_ids[b] for b in range(256)])
        self.counts: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        found = np.full(len(key), NONE)
        hit = self.keys[at] == key
        found[hit] = self.order[at[hit]]
        return found

    def surviving(self, words: list[str]) -> np.ndarray:
        """Symbols left of each pre-token once nothing merges any more."""
        data = [w.encode("utf-8", "replace") for w in words]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        result = sizes.copy()
        for i in np.flatnonzero(sizes > LONG):
            result[i] = self.surviving_long(self.symbol[np.frombuffer(data[i], np.uint8)])
        who = np.flatnonzero((sizes > 1) & (sizes <= LONG))
        if not len(who):
            return result
        data = [data[i] for i in who]
        sizes = sizes[who]
        symbols = self.symbol[np.frombuffer(b"".join(data), np.uint8)]
        ends = np.cumsum(sizes)
        rank = np.full(len(symbols), NONE)  # of each symbol with its right neighbour
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[ends - 1] = NONE
        while len(who):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            going = lowest != NONE
            if not going.all():
                result[who[~going]] = sizes[~going]
                stay = np.repeat(going, sizes)
                symbols, rank = symbols[stay], rank[stay]
                who, sizes, lowest = who[going], sizes[going], lowest[going]
                if not len(who):
                    break
            owner = np.repeat(np.arange(len(who)), sizes)
            at = apart(np.flatnonzero(rank == lowest[owner]))
            first = np.ones(len(at), bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            at = at[first | ~self.singly[lowest[owner[at]]]]
            symbols[at] = self.product[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            sizes = sizes - np.bincount(owner[at], minlength=len(who))
            symbols, rank = symbols[stay], rank[stay]
            at = at - np.arange(len(at))
            last = np.zeros(len(symbols), bool)
            last[np.cumsum(sizes) - 1] = True
            beside = np.union1d(at, at[at > 0] - 1)
            rank[beside] = NONE
            beside = beside[~last[beside]]
            rank[beside] = self.ranks(symbols[beside], symbols[beside + 1])
        return result

    def surviving_long(self, symbols: np.ndarray) -> int:
        """The same for one long pre-token: each rank's places lie in a store, lowest rank first."""
        size = left = len(symbols)
        follows = np.arange(1, size + 1)
        before = np.arange(-1, size - 1)
        rank = np.append(self.ranks(symbols[:-1], symbols[1:]), NONE)
        store: dict[int, list[np.ndarray]] = {}
        due: list[int] = []

        def keep(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            found = rank[at]
            for part in np.split(at, np.flatnonzero(np.diff(found)) + 1) if len(at) else ():
                r = int(rank[part[0]])
                if r not in store:
                    store[r] = []
                    heapq.heappush(due, r)
                store[r].append(part)

        keep(np.arange(size))
        while due:
            r = heapq.heappop(due)
            at = np.unique(np.concatenate(store.pop(r)))
            at = at[rank[at] == r]  # places that were swallowed or changed since are stale
            if not len(at):
                continue
            if self.singly[r]:
                merged, later = at[:1], at[1:]
            else:
                # Overlapping places follow each other by link, not by number.
                new = np.ones(len(at), bool)
                new[1:] = follows[at[:-1]] != at[1:]
                place = np.arange(len(at))
                merged = at[(place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0]
                later = at[:0]
            gone = follows[merged]
            after = follows[gone]
            symbols[merged] = self.product[r]
            rank[gone] = NONE
            follows[merged] = after
            inner = after < size
            before[after[inner]] = merged[inner]
            left -= len(merged)
            beside = np.union1d(merged, before[merged][before[merged] >= 0])
            rank[beside] = NONE
            known = beside[follows[beside] < size]
            rank[known] = self.ranks(symbols[known], symbols[follows[known]])
            keep(np.union1d(known, later[rank[later] == r]))
        return left

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        rows, new, extra = [], set(), []
        if len(self.counts) > CACHED:
            self.counts.clear()
        for text in texts:
            chunks, special = [], 0
            for piece, token in self.vocab.pieces(text):
                if token is None:
                    chunks += self.vocab.chunks(piece)
                else:
                    special += 1
            rows.append(chunks)
            extra.append(special)
            new.update(chunks)
        missing = list(new.difference(self.counts))
        words, ends = [], [0]
        for chunk in missing:
            words += self.vocab.words(chunk)
            ends.append(len(words))
        until = np.concatenate([[0], np.cumsum(self.surviving(words))])[ends]
        self.counts.update(zip(missing, np.diff(until).tolist(), strict=True))
        known = self.counts.__getitem__
        return [n + sum(map(known, chunks)) for n, chunks in zip(extra, rows, strict=True)]


@lru_cache(maxsize=2)
def merger(content: str) -> Merger:
    return Merger(vocabulary.parsed(content))


def count(docs: DataFrame, path: str, text: str = "text", output: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each whole text. No shuffle."""
    shared = vocabulary.load(docs.sparkSession, path)

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        own = merger(shared.value)
        return pd.Series([n for block in blocks(whole(texts)) for n in own.count(block)], dtype="int64")

    return docs.withColumn(output, tokens(F.col(text)))


def report(docs: DataFrame, path: str) -> DataFrame:
    name = free_name(docs, "n_tokens")
    return count(docs.select("doc_id", "text"), path, output=name).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(name).alias("n_tokens"),
        (F.col(name) > LIMIT).alias("over_limit"),
    )
