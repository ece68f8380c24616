"""Phrase collocations: n-grams counted by HAT-tries in tasks, their sorted runs merged by prefix partition.

**Counting.** A task gives its words numbers and counts word sequences in a HAT-trie: a shallow trie over word numbers whose
leaves are hash containers of the remaining numbers; a container that gets too large bursts into a trie node with one
container for each next word (words alone are its first nodes, kept as an array). When the trie holds ``TRIE_ENTRIES`` entries, its largest subtrees leave as sorted runs until it is half
empty. Runs are dealt into prefix partitions by the hash of a phrase's first two words, as many as the language's
words ask for, so that a partition is merged in bounded memory and no frequent word makes a large one. A row is a sorted run of one
partition, in which phrases with equal first words follow each other and name it once.

**Levels.** A phrase is at most as frequent as each of its parts, so words are counted first, then pairs of frequent
words, then phrases of three to five words all of whose pairs are frequent. What is frequent reaches
the tasks as a Bloom filter, sized from the number of entries and at most 32 MB: it never hides a
frequent phrase, and when it is full, more rows are counted, none is lost.

**Scores.** Both parts of a cut are frequent phrases, so joins with the table of frequent phrases give them. Products are exact
decimals of 38 digits. A phrase that some longer phrase contains as often is contained as often in one that is longer by one word, so two
parts of each phrase are enough for the test. The first rows of a language are picked in lots before they meet.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count again; other columns
are not read; ties of cuts go to the shorter first part; very long texts are numbered in slices; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlake.llm import bloom
from pitlake.llm.common import blocks, whole
from pitlake.session import stage

LONGEST, LEAST, FIRST = 5, 100, 2_000
PART_WORDS = 500_000  # words of a language for each of its prefix partitions
RUN_FRAME = 64
TRIE_ENTRIES = 600_000
CONTAINER_ENTRIES = 4_096
TASK_WORDS = 1_500_000  # distinct words of a task before its numbers start anew
SLICE = 2_000_000
RUN_ROWS = 50_000
LOT = 400_000  # entries that leave a trie at a time
EXACT = 16  # bytes of a word that its first and last eight bytes and its length determine
# Bytes that end a piece, and bytes between words.
ENDS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
KIND = np.array([2 if b in ENDS else 1 if b in GAPS else 0 for b in range(256)], np.uint8)
KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # the first i of eight bytes


class HatTrie:
    """Counts of number sequences. Children of a node are nodes (dict) or containers (``Container``)."""

    class Container(dict):
        """Remaining numbers of a sequence -> count."""

    def __init__(self, burst: int = CONTAINER_ENTRIES):
        self.root: dict = {}
        self.sizes: dict[int, int] = {}  # entries below each first number
        self.burst = burst
        self.entries = 0

    def add(self, first: int, rests: list[tuple], counts: list[int]) -> None:
        """Count sequences that begin with ``first``."""
        before = self.entries
        child = self.root.get(first)
        if child is None:
            child = self.root[first] = self.Container()
        if type(child) is dict:
            for rest, n in zip(rests, counts, strict=True):
                self._add_below(child, rest, n)
        else:
            held = len(child)
            for rest, n in zip(rests, counts, strict=True):
                child[rest] = child.get(rest, 0) + n
            self.entries += len(child) - held
            if len(child) > self.burst:
                self.root[first] = self._split(child)
        self.sizes[first] = self.sizes.get(first, 0) + self.entries - before

    def _split(self, container: Container) -> dict:
        """The trie node that a container bursts into; the empty rest stays under None."""
        node: dict = {}
        for rest, n in container.items():
            if rest:
                below = node.setdefault(rest[0], self.Container())
                below[rest[1:]] = n
            else:
                node[None] = n
        return node

    def _add_below(self, node: dict, rest: tuple, n: int) -> None:
        at = 0
        while at < len(rest):
            child = node.get(rest[at])
            if child is None:
                child = node[rest[at]] = self.Container()
            at += 1
            if type(child) is dict:
                node = child
                continue
            key = rest[at:]
            if key in child:
                child[key] += n
            else:
                child[key] = n
                self.entries += 1
                if len(child) > self.burst:
                    node[rest[at - 1]] = self._split(child)
            return
        self.entries += None not in node
        node[None] = node.get(None, 0) + n

    def take(self, first: int) -> list[tuple[tuple, int]]:
        """Remove the subtree of one first number; its (sequence, count) entries, unsorted."""
        out, todo = [], [((first,), self.root.pop(first))]
        self.entries -= self.sizes.pop(first)
        while todo:
            path, node = todo.pop()
            if type(node) is not dict:
                out += [(path + rest, n) for rest, n in node.items()]
                continue
            for key, child in node.items():
                if key is None:
                    out.append((path, child))
                else:
                    todo.append(((*path, key), child))
        return out

    def largest(self) -> list[int]:
        return sorted(self.sizes, key=self.sizes.get, reverse=True)


class Words:
    """The numbered (language, word) pairs of a task, with their hashes. Number 0 is the end of a piece.

    With a filter only the words that it lets through get a number; all others are 0 as well, because no
    counted phrase holds them. Without one nothing asks for hashes, and there are none.
    """

    def __init__(self, filled: np.ndarray | None = None):
        self.filled = filled
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.languages, self.text, self.hashes = [""], [""], array("Q", [0])

    def of(self, language: str, words: list[bytes]) -> np.ndarray:
        known = self.numbers.setdefault(language, {})
        found = list(map(known.get, words))
        new = [i for i, n in enumerate(found) if n is None]
        if self.filled is not None:
            seed = xxhash.xxh32_intdigest(language)
            hashes = np.array([xxhash.xxh64_intdigest(words[i], seed) for i in new], np.uint64)
            passes = bloom.may_hold(self.filled, phrase_hash([hashes]))
            for i in np.array(new, np.int64)[~passes].tolist():
                found[i] = 0
            new, hashes = np.array(new, np.int64)[passes].tolist(), hashes[passes].tolist()
        for place, i in enumerate(new):
            word = words[i]
            if word in known:  # twice in this list
                found[i] = known[word]
                continue
            found[i] = known[word] = len(self.text)
            self.languages.append(language)
            self.text.append(word.decode("utf-8", "replace"))
            if self.filled is not None:
                self.hashes.append(hashes[place])
        return np.array(found, np.int64)

    def _of_slice(self, language: str, data: bytes) -> np.ndarray:
        """Numbers of the words of ``data``, with 0 where a piece ends."""
        buffer = np.frombuffer(data + bytes(8), np.uint8)
        kind = KIND[buffer[: len(data)]]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind == 0
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = ends - starts
        eight = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
        front = eight[starts] & KEEP[np.minimum(size, 8)]
        back = np.where(size > 8, eight[np.maximum(ends - 8, 0)], np.uint64(0))
        key = bloom.mixed(bloom.mixed(front) + back * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64))
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        alone = (size > EXACT) | (front != front[first[of]]) | (back != back[first[of]]) | (size != size[first[of]])
        own = np.flatnonzero(alone)  # long words, and words that share a key with another one
        seen = np.concatenate([first, own])
        numbers = self.of(language, [data[a:b] for a, b in zip(starts[seen].tolist(), ends[seen].tolist(), strict=True)])
        ids = numbers[: len(first)][of]
        ids[own] = numbers[len(first) :]
        breaks = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int64)])
        at = np.append(breaks[starts], breaks[-1])
        return np.insert(ids, np.flatnonzero(np.diff(at, prepend=0)), 0)

    def ids(self, language: str, texts: list[str]) -> np.ndarray:
        """Numbers of all words of the texts in order, 0 between pieces and texts."""
        data, at, parts = "\n".join(texts).encode("utf-8", "replace").translate(LOWER), 0, []
        while at < len(data):
            end = data.find(b" ", at + SLICE) if len(data) - at > SLICE else -1
            end = len(data) if end < 0 else end
            parts.append(self._of_slice(language, data[at:end]))
            at = end
        return np.concatenate([*parts, [0]]) if parts else np.zeros(1, np.int64)


def phrase_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from the hashes of their words."""
    h = np.zeros_like(parts[0])
    for p in parts:
        h = bloom.mixed(h * np.uint64(0x9E3779B97F4A7C15) + p)
    return h


def hashed(phrases: DataFrame) -> DataFrame:
    """``hash`` of each (lang, phrase), as tasks compute it."""

    def rows(batches):
        for batch in batches:
            out = []
            for lang, phrase in zip(batch["lang"], batch["phrase"], strict=True):
                seed = xxhash.xxh32_intdigest(lang)
                words = [np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in phrase.encode().split(b" ")]
                out.append(phrase_hash(words)[0])
            yield pd.DataFrame({"hash": np.array(out, np.uint64).view(np.int64)})

    return phrases.select("lang", "phrase").mapInPandas(rows, "hash long")


def _pack(runs: np.ndarray, nexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (run, next) pairs as numbers: of each row its pair's number, then the pairs' first rows, then their counts."""
    _, first, of, counts = np.unique(runs << np.int64(32) | nexts, return_index=True, return_inverse=True, return_counts=True)
    return of, first, counts


def _level(ids: np.ndarray, table: Words, lengths: range, frequent: np.ndarray):
    """(sequences as an array, counts) for each length; only sequences whose words and pairs pass the filter."""
    if lengths.start == 2:
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        pairs = np.sort(ids[at] << np.int64(32) | ids[at + 1])
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        counts, pairs = np.diff(first, append=len(pairs)), pairs[first]
        yield np.stack([pairs >> np.int64(32), pairs & np.int64((1 << 32) - 1)], 1), counts
        return
    words = np.array(table.hashes, np.uint64)
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    pair = np.full(len(ids), -1, np.int64)  # number of the frequent pair that begins here
    of, first, _ = _pack(ids[at], ids[at + 1])
    good = bloom.may_hold(frequent, phrase_hash([words[ids[at[first]]], words[ids[at[first] + 1]]]))
    pair[at] = np.where(good[of], of, -1)
    at, run = np.flatnonzero(pair >= 0), None
    run = pair[at]
    for k in lengths:  # a run of k - 1 words goes on by one if the pair at its last word is frequent
        inside = at + k - 2 < len(ids)
        at, run = at[inside], run[inside]
        goes_on = pair[at + k - 2] >= 0
        at, run = at[goes_on], run[goes_on]
        if not len(at):
            return
        run, first, counts = _pack(run, ids[at + k - 1])
        rows = at[first]
        yield np.stack([ids[rows + j] for j in range(k)], 1), counts


RUN = "lang string, part int, phrases string, counts binary"
WORD_RUN = "lang string, phrase string, n long"


def _unpacked(phrases: str, counts: bytes):
    texts, first = phrases.split("\n"), ""
    for i, text in enumerate(texts):
        if text[0] == " ":
            texts[i] = first + text
        else:
            first = text[: text.index(" ")]
    return zip(texts, np.frombuffer(counts, f"<u{len(counts) // len(texts)}").tolist(), strict=True)


def _packed(table: Words, lang: str, of: int, entries: list[tuple[tuple, int]]):
    """(lang, part, phrases, counts) of sorted runs; a phrase with the first word of the one before it leaves that word out."""
    paths, counts = zip(*entries, strict=True)
    sizes = np.fromiter(map(len, paths), np.int64, len(paths))
    flat = np.fromiter(chain.from_iterable(paths), np.int64, int(sizes.sum()))
    hashes = np.array(table.hashes, np.uint64)
    # Numbers give way to places among the sorted words of these phrases; place 0 is the empty word, which fills the rows up.
    held = np.zeros(len(table.text), bool)
    held[flat] = True
    used = np.flatnonzero(held)
    words = pa.array(["", *map(table.text.__getitem__, used.tolist())], pa.string())
    order = pc.array_sort_indices(words)
    words, places = words.take(order), np.zeros(len(held), np.int64)
    places[np.insert(used, 0, 0)[order.to_numpy()]] = np.arange(len(words))
    rows = np.zeros((len(sizes), sizes.max()), np.int64)
    inside = np.arange(rows.shape[1]) < sizes[:, None]
    rows[inside] = flat
    dealt = ((hashes[rows[:, 0]] * np.uint64(31) + hashes[rows[:, 1]]) % np.uint64(of)).astype(np.int64)
    rows = places[rows]
    order = np.lexsort([*rows.T[::-1], dealt])
    rows, dealt, sizes, counts = rows[order], dealt[order], sizes[order], np.array(counts, "<i8")[order]
    begins = np.diff(dealt, prepend=-1) != 0
    edge = np.append(np.flatnonzero(begins), len(dealt))
    rows[np.flatnonzero((np.diff(rows[:, 0], prepend=-1) == 0) & ~begins), 0] = 0
    parts, at = [], []
    for k in np.unique(sizes).tolist():
        at.append(np.flatnonzero(sizes == k))
        parts.append(pc.binary_join_element_wise(*(words.take(pa.array(rows[at[-1], j])) for j in range(k)), " "))
    phrases = pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(at))))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), phrases), "\n").to_pylist()
    for part, text, a, b in zip(dealt[edge[:-1]].tolist(), texts, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        own = counts[a:b]
        yield lang, part, text, (own.astype("<u4") if own.max() < 1 << 32 else own).tobytes()


def _run(trie: HatTrie, table: Words, firsts: list[int], parts: dict[str, int]):
    """The subtrees as sorted runs, a row for each prefix partition that they meet; they leave the trie ``LOT`` entries at a time."""
    rows, own = [], {}
    for first in firsts:
        own.setdefault(table.languages[first], []).append(first)
    for lang, numbers in own.items():
        while numbers:
            entries: list = []
            while numbers and len(entries) < LOT:
                entries += trie.take(numbers.pop())
            for row in _packed(table, lang, parts[lang], entries):
                rows.append(row)
                if len(rows) == RUN_FRAME:
                    yield pd.DataFrame(rows, columns=["lang", "part", "phrases", "counts"])
                    rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["lang", "part", "phrases", "counts"])


def _merger(least: int):
    """Runs arrive sorted by partition; those of one are merged, and what is frequent goes on."""

    def frequent(lang: str, total: dict[str, int]):
        kept = [(phrase, n) for phrase, n in total.items() if n >= least]
        if kept:
            yield pd.DataFrame({"lang": lang, "phrase": [x[0] for x in kept], "n": [x[1] for x in kept]})

    def merge(batches):
        at, total = None, {}
        for batch in batches:
            for lang, part, phrases, counts in zip(*(batch[c].tolist() for c in ("lang", "part", "phrases", "counts")), strict=True):
                if (lang, part) != at:
                    if at:
                        yield from frequent(at[0], total)
                    at, total = (lang, part), {}
                for phrase, n in _unpacked(phrases, counts):
                    total[phrase] = total.get(phrase, 0) + n
        if at:
            yield from frequent(at[0], total)

    return merge


def _words_run(table: Words, counts: np.ndarray):
    """Words alone are the first nodes of the trie: a count for each number. They are added up by hash, in any order."""
    for at in range(1, len(table.text), RUN_ROWS):
        part = slice(at, at + RUN_ROWS)
        yield pd.DataFrame({"lang": table.languages[part], "phrase": table.text[part], "n": counts[part]})


def _blocks(batches):
    """(language, whole texts) of bounded size, one language each."""
    for batch in batches:
        for lang, rows in batch.groupby("lang", sort=False):
            for texts in blocks(whole(rows["text"]), SLICE):
                yield lang, texts


def _word_counter(batches):
    table, counts = Words(), np.zeros(1, np.int64)
    for lang, texts in _blocks(batches):
        ids = table.ids(lang, texts)
        seen = np.bincount(ids, minlength=len(counts))
        seen[: len(counts)] += counts
        counts = seen
        if len(table.text) > TASK_WORDS:
            yield from _words_run(table, counts)
            table, counts = Words(), np.zeros(1, np.int64)
    yield from _words_run(table, counts)


def _phrase_counter(lengths: range, shared, parts: dict[str, int], entries: int, burst: int):
    def count(batches):
        table, trie = Words(shared.value), HatTrie(burst)
        for lang, texts in _blocks(batches):
            for rows, counts in _level(table.ids(lang, texts), table, lengths, shared.value):
                order = np.argsort(rows[:, 0], kind="stable")
                rows, counts = rows[order], counts[order].tolist()
                edge = np.flatnonzero(np.diff(rows[:, 0], prepend=-1, append=-1))
                rests = list(zip(*rows[:, 1:].T.tolist(), strict=True))
                for first, a, b in zip(rows[edge[:-1], 0].tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    trie.add(first, rests[a:b], counts[a:b])
            if trie.entries > entries:
                largest, leaving, kept = trie.largest(), [], trie.entries
                while kept > entries // 2:
                    leaving.append(largest[len(leaving)])
                    kept -= trie.sizes[leaving[-1]]
                yield from _run(trie, table, leaving, parts)
            if len(table.text) > TASK_WORDS:
                yield from _run(trie, table, trie.largest(), parts)
                table, trie = Words(shared.value), HatTrie(burst)
        yield from _run(trie, table, trie.largest(), parts)

    return count


def _of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words."""
    return _of(docs).mapInPandas(_word_counter, WORD_RUN).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def counted(
    docs: DataFrame, lengths: range, frequent: DataFrame, totals: DataFrame, least: int = LEAST, entries: int = TRIE_ENTRIES, burst: int = CONTAINER_ENTRIES
) -> DataFrame:
    """(lang, phrase, k, f) of the phrases with so many words, ``least`` times or more, made of the frequent words and pairs."""
    filled = bloom.build(hashed(frequent), bloom.size_for(frequent.count()))
    shared = docs.sparkSession.sparkContext.broadcast(filled)
    parts = {r.lang: 1 + r.n // PART_WORDS for r in totals.collect()}  # a row for each language
    runs = _of(docs).mapInPandas(_phrase_counter(lengths, shared, parts, entries, burst), RUN)
    prefix = ["lang", "part"]
    merged = runs.repartition(*prefix).sortWithinPartitions(*prefix).mapInPandas(_merger(least), WORD_RUN)
    size = F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1
    return merged.select("lang", "phrase", size.cast("int").alias("k"), F.col("n").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, **limits) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases with ``least`` occurrences or more, and (lang, n) with all words of each language."""
    words = stage(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = stage(words.filter(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("k"), "f"), "frequent")
    for lengths in (range(2, 3), range(3, longest + 1)):
        if len(lengths):
            found = found.unionAll(stage(counted(docs, lengths, found, totals, least, **limits), "frequent"))
    return found, totals


def _part(first: str, size: str):
    return F.array_join(F.slice("words", F.expr(first), F.expr(size)), " ")


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of the candidates that no longer candidate replaces."""
    candidates = found.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.join(totals, "lang").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "k", "a", "n", "cut", _part("1", "cut").alias("left"), _part("cut + 1", "k - cut").alias("right"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    big = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("above div below").cast("long")
    cuts = cuts.withColumn("above", big("a") * big("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("below", big("l") * big("r"))
    cuts = cuts.withColumn("score", score)
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("low")
    best = cuts.groupBy("lang", "phrase", "k", "a", "n").agg(lowest)
    parts = F.explode(F.array(_part("1", "k - 1"), _part("2", "k - 1")))
    inside = candidates.filter("k > 2").select("lang", parts.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a")
    return kept.select("lang", "phrase", "k", "a", "low.l", "low.r", "n", "low.score")


def first_of_each(rows: DataFrame, first: int = FIRST) -> DataFrame:
    """The ``first`` rows of each language with their rank; lots by hash give up what can't be among them."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    lots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lot = rows.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(lots)))
    near = lot.withColumn("place", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).filter(F.col("place") <= first)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    return first_of_each(scored(*frequent_phrases(docs)))
