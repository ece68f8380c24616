"""Benchmark decontamination: one Aho-Corasick automaton over the items' normalised windows.

Every run of ``WINDOW`` consecutive item words is a pattern (a shorter item is one pattern as a whole).
A text is lowered, its words joined by single spaces, and read once; each hit marks its words, and
the word numbers map back to offsets of the original text.

The items are the small side: they are collected only up to ``MAX_ITEM_CHARS`` characters, checked before
the collect. A larger benchmark is dealt into several such automata by item id, each read by the
same scan, so nothing is dropped.

Defined results: null and empty texts have no words; items without words never occur; an item id
that repeats, or a null one, counts once per distinct id (null ids count as the text "null").
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import free_name, whole

WINDOW = 10
MAX_ITEM_CHARS = 500_000  # of one automaton; some 5 million nodes, 300 MB in a worker
# Bytes outside words, after A-Z are lowered; every byte of a non-ASCII character is in a word.
GAP = {*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)}
WORDS = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in GAP else b) for b in range(256)
)
RUN = re.compile(rb"[^\x20]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(WORDS).split(b" ")


def normalised(text: str) -> bytes:
    """`` w1 w2 w3 `` with a space on both sides of each word; empty without words."""
    words = [w for w in words_of(text) if w]
    return b" " + b" ".join(words) + b" " if words else b""


@lru_cache(maxsize=2)
def automaton(items: tuple[tuple[str, str], ...], window: int):
    """Patterns of all items; a pattern's value is (its word count, the item ids that have it)."""
    patterns: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = [w for w in words_of(text) if w]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            key = (b" " + b" ".join(part) + b" ").decode("latin-1")
            patterns.setdefault(key, (len(part), set()))[1].add(item_id)
    built = ahocorasick.Automaton()
    for key, value in patterns.items():
        built.add_word(key, value)
    if patterns:
        built.make_automaton()
    return built if patterns else None


def scan_text(text: str, built) -> tuple[int, np.ndarray, set]:
    """Word count, mask of hit words, ids of items with occurring windows."""
    line = normalised(text)
    if not line:
        return 0, np.zeros(0, bool), set()
    n_words, seen, ends = line.count(b" ") - 1, set(), []
    for end, (size, ids) in built.iter(line.decode("latin-1")) if built else ():
        ends.append((end, size))
        seen |= ids
    if not ends:
        return n_words, np.zeros(0, bool), seen
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    at, size = np.array(ends).T
    last = np.searchsorted(spaces, at)  # the pattern's final space follows its last word
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, last - size, 1)
    np.add.at(steps, last, -1)
    return n_words, np.cumsum(steps[:-1]) > 0, seen


def original_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point ranges of the runs of hit words in the text as it was."""
    data = text.encode("utf-8", "replace").translate(WORDS)
    bounds = [m.span() for m in RUN.finditer(data)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    point = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode("utf-8", "replace"), np.uint8) & 0xC0) != 0x80)])
    return [(int(point[bounds[a][0]]), int(point[bounds[b - 1][1]])) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def item_groups(items: DataFrame) -> list[tuple[tuple[str, str], ...]]:
    """The items in groups of at most ``MAX_ITEM_CHARS`` characters or so, by hash of the id."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), "text").filter("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = 1 + chars // MAX_ITEM_CHARS
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [tuple(sorted((r.id, r.text) for r in items.filter(part == i).distinct().collect())) for i in range(n)]


OUT = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:long,end:long>>>"


def scan(docs: DataFrame, items: DataFrame, text: str = "text", output: str = "leaks", window: int = WINDOW) -> DataFrame:
    """``docs`` with one more column: word counts, the items met, and the hit ranges of the text."""
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast((group, window)) for group in item_groups(items)]

    @F.pandas_udf(OUT)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        built = [automaton(*b.value) for b in shared]
        for t in whole(texts):
            n, mask, seen = scan_text(t, built[0])
            for more in built[1:]:
                _, other, ids = scan_text(t, more)
                mask = other if not mask.size else mask if not other.size else mask | other
                seen = seen | ids
            spans = [{"start": a, "end": b} for a, b in original_spans(t, mask)] if mask.any() else []
            rows.append((n, int(mask.sum()), sorted(seen), spans))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return docs.withColumn(output, find(F.col(text)))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    name = free_name(docs, "leaks")
    return scan(docs.select("doc_id", "text"), items, output=name).select(
        "doc_id",
        F.col(f"{name}.n_words"),
        F.col(f"{name}.n_hit"),
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(f"{name}.n_hit") > 0).alias("contaminated"),
    )
