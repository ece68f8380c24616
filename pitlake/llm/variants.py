"""Spelling variant grouping by finite-state composition: acceptor, one-edit transducer, acceptor again.

**Vocabulary.** Words are counted inside tasks, then over the cluster; a word stays if it is long and frequent enough.

**Initial-state partitions.** Let c be the length of the common prefix of two near words and m the length of the
shorter one. ``c`` lies in an interval [lo, hi); all pairs of such an interval share the first ``lo`` and the last ``m - hi``
code points, so words are partitioned by (m, lo, hi, those code points), and a partition's acceptors start in the state behind
them. First [0, m + 1) is cut in half. A partition whose middles hold more than ``GROUP_CHARS`` code points in
all is cut in half again, before its rows meet: the smallest interval leaves one or two code points, so at most
alphabet + alphabet^2 words meet, and no partition grows with the input. The intervals are
disjoint, so each pair has exactly one partition.

**Composition.** Each partition builds one minimised acceptor of its words of m and one of its words of m + 1 code points, with
common states. The transducer copies, then makes one edit, then copies. It is unambiguous: a replaced symbol differs from
its replacement, and the symbol after an inserted one is not the inserted one. In the composed machine the states before the edit
are pairs that read the same prefix; those behind it are pairs (p, q) that accept the same suffixes, which are
computed once for each pair and are empty for all pairs that a trimmed machine would not have. A deletion is an insertion read backwards.

What leaves a task is one row for each word that has near words: their number and the best one, never the pairs.

Defined results: null and empty texts have no words; a null doc_id is the text "null"; repeated rows count again; other
columns, whatever their names, are not read; ties of forms go to the smallest word in code-point order; very long texts
are read in slices that end between words; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import drop_table, whole
from pitlake.session import stage

LETTERS = "A-Za-zÀ-ÿ"
LEAST_CHARS, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
DROP_EVERY = 31  # of the query's contract: a run whose checksum it divides loses one code point
GROUP_CHARS = 100_000
FLUSH_WORDS = 300_000
SLICE = 1_000_000
_GAP = re.compile(f"[^{LETTERS}]")


def slices(text: str, chars: int = SLICE):
    """The text in parts that end where no run of letters does."""
    at = 0
    while len(text) - at > chars:
        m = _GAP.search(text, at + chars)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def lowered(text: str) -> str:
    """A-Z in lower case, every other letter as it is."""
    return text.lower() if text.isascii() else text.encode("utf-8", "replace").lower().decode()


def garbled(word: str, prefix: int, every: int) -> str:
    """The word, less one code point if ``every`` divides the checksum of the document's prefix and the word."""
    h = zlib.crc32(word.encode(), prefix)
    if h % every:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def _counter(least_chars: int, drop_every: int | None):
    find = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall

    def count(batches):
        seen = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], whole(batch["text"]), strict=True):
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for part in slices(text):
                    if not drop_every:
                        seen.update(find(lowered(part)))
                        continue
                    for word, n in Counter(find(lowered(part))).items():
                        word = garbled(word, prefix, drop_every)
                        if len(word) >= least_chars:
                            seen[word] += n
                if len(seen) >= FLUSH_WORDS:
                    yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})

    return count


def word_counts(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, drop_every: int | None = None
) -> DataFrame:
    """(word, n) of the runs of letters with ``least_chars`` code points and ``least_count`` occurrences or more."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc_id"), "text")
    counted = rows.mapInPandas(_counter(least_chars, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Acceptors:
    """Minimal deterministic acceptors of word lists, all in one table of states.

    A state is a number; equal right languages are equal states. The words of a list have one length.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {(): 0}
        self.moves: list[dict[str, int]] = [{}]  # state 0 accepts the empty word and nothing else
        self.right: dict[int, list[str]] = {0: [""]}
        self.shared: dict[tuple[int, int], list[str]] = {}

    def state(self, moves: list[tuple[str, int]]) -> int:
        key = tuple(moves)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.moves)
            self.moves.append(dict(moves))
        return found

    def of(self, words: list[str]) -> int | None:
        """Initial state of the acceptor of ``words``: sorted, distinct, of equal length."""
        if not words:
            return None
        open_, last = [[] for _ in words[0]], words[0]  # moves out of the states along the last word
        size = len(last)
        for word in words[1:]:
            c = 0
            while word[c] == last[c]:
                c += 1
            target = 0
            for i in range(size - 1, c, -1):
                open_[i].append((last[i], target))
                target = self.state(open_[i])
                open_[i] = []
            open_[c].append((last[c], target))
            last = word
        target = 0
        for i in range(size - 1, -1, -1):
            open_[i].append((last[i], target))
            target = self.state(open_[i])
        return target

    def suffixes(self, p: int) -> list[str]:
        """All words that state ``p`` accepts."""
        todo = [p]
        while todo:
            q = todo[-1]
            missing = [r for r in self.moves[q].values() if r not in self.right]
            if missing:
                todo += missing
                continue
            todo.pop()
            if q not in self.right:
                self.right[q] = [x + s for x, r in self.moves[q].items() for s in self.right[r]]
        return self.right[p]

    def common(self, p: int, q: int) -> list[str]:
        """The words that both states accept; they read words of equal length."""
        if p == q:
            return self.suffixes(p)
        todo = [(p, q) if p < q else (q, p)]
        top = todo[0]
        while todo:
            a, b = todo[-1]
            if (a, b) in self.shared:
                todo.pop()
                continue
            left, right = self.moves[a], self.moves[b]
            both = [(x, *((r, right[x]) if r <= right[x] else (right[x], r))) for x, r in left.items() if x in right]
            missing = [(u, v) for _, u, v in both if u != v and (u, v) not in self.shared]
            if missing:
                todo += missing
                continue
            todo.pop()
            self.shared[a, b] = [x + s for x, u, v in both for s in (self.suffixes(u) if u == v else self.shared[u, v])]
        return self.shared[top]


def composed(short: list[str], long: list[str], last: int):
    """Pairs of near words: two of ``short`` by a replacement, one of ``short`` and one of ``long`` by an insertion.

    Lists are sorted and distinct, all words of a list equally long, those of ``long`` by one code point longer.
    Insertions are made before at most ``last`` symbols were read.
    """
    machine = Acceptors()
    start, start_long = machine.of(short), machine.of(long)
    if start is None:
        return
    moves, common = machine.moves, machine.common
    todo = [("", start)]
    while todo:
        prefix, q = todo.pop()
        out = list(moves[q].items())
        for i, (x, p) in enumerate(out):
            for y, r in out[i + 1 :]:
                for s in common(p, r):
                    yield prefix + x + s, prefix + y + s
            if len(moves[p]) > 0:
                todo.append((prefix + x, p))
    todo = [("", start, start_long)] if start_long is not None else []
    while todo:
        prefix, q, r = todo.pop()
        if len(prefix) > last:
            continue
        own = moves[q]
        for x, p in moves[r].items():
            for s in common(q, p):
                if s[:1] != x:
                    yield prefix + s, prefix + x + s
            if x in own:
                todo.append((prefix + x, own[x], p))


def _near_in(m: int, lo: int, hi: int, words: list[str], counts: list[int], out: list) -> None:
    """Append (word, number of near words, most frequent of them, its count) of one partition."""
    if len(words) < 2 or m not in map(len, words):
        return
    tail = max(0, m - hi)
    middle: dict[str, tuple[str, int]] = {}
    short, long = [], []
    for word, n in zip(words, counts, strict=True):
        part = word[lo : len(word) - tail]
        middle[part] = (word, n)
        (short if len(word) == m else long).append(part)
    best: dict[str, list] = {}
    for a, b in composed(sorted(short), sorted(long), hi - lo - 1):
        for x, y in ((a, b), (b, a)):
            word, n = middle[y]
            found = best.get(x)
            if found is None:
                best[x] = [1, n, word]
            else:
                found[0] += 1
                if n > found[1] or (n == found[1] and word < found[2]):
                    found[1], found[2] = n, word
    out += [(middle[x][0], k, word, n) for x, (k, n, word) in best.items()]


NEAR = "word string, n_near long, near string, near_n long"


def _compose(batches):
    """Partitions arrive sorted; each is composed once all its rows are there."""
    at, words, counts, out = None, [], [], []
    for batch in batches:
        for m, lo, hi, key, word, n in zip(*(batch[c].tolist() for c in ("m", "lo", "hi", "key", "word", "n")), strict=True):
            if (m, lo, hi, key) != at:
                if at:
                    _near_in(*at[:3], words, counts, out)
                at, words, counts = (m, lo, hi, key), [], []
            words.append(word)
            counts.append(n)
        if out:
            yield pd.DataFrame(out, columns=["word", "n_near", "near", "near_n"])
            out = []
    if at:
        _near_in(*at[:3], words, counts, out)
    if out:
        yield pd.DataFrame(out, columns=["word", "n_near", "near", "near_n"])


def _halved(rows: DataFrame) -> DataFrame:
    """Each row (word, n, m, lo, hi) twice, for both halves of [lo, hi)."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    cut = rows.select("word", "n", "m", F.explode(halves).alias("half")).select("word", "n", "m", "half.*")
    tail = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    key = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.lit("|"), F.substring("word", F.length("word") - tail + 1, tail))
    return cut.withColumn("key", key)


PARTITION = ["m", "lo", "hi", "key"]


def near_words(words: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(word, n_near, near, near_n) by partition, for the distinct words of (word, n); several rows a word."""
    size = F.length("word").cast("int")
    lengths = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).filter("m > 0")
    rows = _halved(lengths.select("*", F.lit(0).alias("lo"), (F.col("m") + 1).alias("hi")))
    found = None
    while True:
        middle = F.length("word") - F.length("key") + 1  # the key has one mark more than what the words share
        sizes = rows.groupBy(PARTITION).agg(F.count("*").alias("k"), F.sum(middle).alias("chars"))
        large = stage(sizes.filter(f"k > 1 AND chars > {group_chars} AND hi - lo > 1").select(PARTITION), "large-partitions")
        done = large.isEmpty()
        ready = rows if done else rows.join(large, PARTITION, "left_anti")
        near = ready.repartition(*PARTITION).sortWithinPartitions(*PARTITION).mapInPandas(_compose, NEAR)
        found = near if found is None else found.unionAll(near)
        if done:
            drop_table(large)
            return found
        rows = _halved(rows.join(large, PARTITION, "left_semi").drop("key"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the last word that following forms reaches, by pointer jumping."""
    up = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("top"))
        jumped = up.join(above, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
        jumped = stage(jumped, "roots")
        drop_table(up)
        up = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return up


def variants(words: DataFrame, factor: int = FORM_FACTOR, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) of distinct words."""
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<down:long,near:string>").alias("best"))
    near = near_words(words, group_chars).select(
        "word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near")).alias("best")
    )
    whole_ = own.unionAll(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    taken = -F.col("best.down") >= factor * F.col("n")
    forms = stage(
        whole_.select("word", "n", "n_near", F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.down")).alias("form_n")), "forms"
    )
    last = roots(forms.filter("form IS NOT NULL"))
    return forms.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, drop_every: int | None = DROP_EVERY) -> DataFrame:
    return variants(stage(word_counts(docs, drop_every=drop_every), "words"))
