"""N-gram Jaccard join by PartEnum signatures: partitions of the feature domain, in bands of equal size.

**Signatures.** A document is its set of 5-word shingles, as 64-bit hashes. Sets r and s with J >= 0.8 differ in at most
(|r| + |s|) / 9 shingles, and their sizes are within a factor 1.25. Sizes are cut into bands; a pair is
looked for in the band of its larger set, so a set signs for its own band and for those its larger partners can be in. A band cuts the
hash domain into N equal partitions. Each shingle by which two sets differ spoils one partition,
so with k differences one of any k + 1 partitions of r is the same in s. A signature is the content of one
partition; of the possible subsets those of k + 1 partitions suffice, and which ones are taken may depend on
contents alone: the first k + 1 that hold two shingles or more (one alone is often a shared line's). At an
equal partition, the number of suitable ones before it differs between r and s by no more than they spoil, so it is among
the first k + 1 of both. It is enough that one of the two has k + 1 suitable partitions; a set that has fewer
also signs with partitions of one shingle or more, and if these are too few with its k + 1
smallest shingles, of which every set has enough.

**Join.** Equal sets are one node from the start. Rows of a signature meet sorted; those that two nodes
share are its bucket. The member that shares most signatures altogether is the bucket's hub (of near copies, mostly the
text they derive from), and every member is checked exactly against it: rows in proportion to the bucket.
A bucket whose members are not all connected then stays open. From a small one come the pairs across its components,
but for those inside the largest. The members of large ones are gathered into families, dealt into parts of
bounded bytes; a pair of parts meets in one task, which counts the overlaps of every member outside its bucket's largest
component by an inverted index, so no list of pairs is ever made. After that every pair
that shares a signature was checked or is connected: the components are exact, whatever the size at which buckets count as large.

Sets are rebuilt from the texts where they are needed; a Bloom filter of fixed size tells which nodes those are, and when
it fills up it only lets more sets through.

Defined results: null, empty and all-space texts have an empty set and link with nothing; a document with fewer
words than five is one shingle; repeated rows and repeated ids are kept, each row with its own result; rows without a
doc_id get the smallest id of their component, or null.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import blocks, bounded_batches, drop_table, free_name, give_back, whole
from pitlake.llm.components import components
from pitlake.session import stage

SHINGLE, NEAR = 5, 80  # words; percent
BAND_RATIO = 1.5
MORE = 1.2  # partitions of a band, over those that its largest sets need
SMALL = 24  # members of a bucket whose pairs are listed; others meet by parts
GROUP_SHINGLES = 400_000  # sets checked together, 8 bytes a shingle
BLOOM_BITS = 1 << 26  # 8 MB, at every size of the input

PRIME = np.uint64(0x9E3779B97F4A7C15)
SHORT = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit number over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words, of the whole text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    h = np.full(n, len(w) if len(w) < SHINGLE else 0, np.uint64) * SHORT
    for j in range(min(SHINGLE, len(w))):
        h = h * PRIME + w[j : j + n]
    return np.unique(mix(h))


def node_of(h: np.ndarray) -> int:
    return int(mix(mix(h ^ SHORT).sum(keepdims=True) + np.uint64(len(h))).view(np.int64)[0])


@cache
def band_of(n: int) -> int:
    band, top = 0, 3
    while top < n:
        band, top = band + 1, band_top(band + 1)
    return band


@cache
def band_top(band: int) -> int:
    top = 3
    for _ in range(band):
        top = max(top + 1, int(top * BAND_RATIO))
    return top


@cache
def bounds(band: int) -> np.ndarray:
    """Upper ends of the band's partitions of the hash domain, without the last."""
    parts = int(MORE * (2 * band_top(band) // 9 + 1)) + 1
    step = 2**64 // parts
    return np.array([i * step for i in range(1, parts)], dtype=np.uint64)


def signatures(h: np.ndarray) -> np.ndarray:
    """All signatures of one set; sets up to three shingles link with no other set."""
    n = len(h)
    if n < 4:
        return np.empty(0, np.uint64)
    out, sums = [], np.concatenate([[np.uint64(0)], np.cumsum(mix(h + PRIME), dtype=np.uint64)])
    largest = n * 100 // NEAR
    for band in range(band_of(n), band_of(largest) + 1):
        need = (n + min(largest, band_top(band))) * (100 - NEAR) // (100 + NEAR) + 1
        edges = np.concatenate([[0], np.searchsorted(h, bounds(band)), [n]])
        counts = np.diff(edges)
        content = sums[edges[1:]] - sums[edges[:-1]]
        for least in (2, 1):
            good = np.flatnonzero(counts >= least)
            taken = good[:need]
            salt = mix(taken.astype(np.uint64) + np.uint64((band * 4 + least) << 32))
            out.append(mix(content[taken] + salt))
            if len(good) >= need:
                break
        else:
            out.append(mix(h[:need] ^ np.uint64(band * 4 + 3)))
    return np.concatenate(out)


def _sign(batches):
    for batch in batches:
        seen = set()
        for texts in blocks(whole(batch["text"])):
            sigs, nodes = [], []
            for text in texts:
                h = shingles(text)
                if len(h) and (node := node_of(h)) not in seen:
                    seen.add(node)
                    own = signatures(h)
                    sigs.append(own)
                    nodes.append(np.full(len(own), node))
            if sigs:
                yield pd.DataFrame({"sig": np.concatenate(sigs).view(np.int64), "node": np.concatenate(nodes)})
    give_back()


def _buckets(batches):
    """Rows sorted by signature and node: the members of every signature that two nodes share.

    Only one row is carried from batch to batch, so a bucket's length does not matter.
    """
    last, given = None, False  # the last row so far, and whether it came out
    for batch in batches:
        rows = batch[["sig", "node"]].to_numpy()
        if last is not None:
            rows = np.concatenate([last, rows])
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        given = np.concatenate([[given], np.zeros(len(rows) - 1, bool)])[fresh]
        rows = rows[fresh]
        same = rows[1:, 0] == rows[:-1, 0]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        # A bucket's later rows follow a row of it that came out, or came out just now.
        out = rows[shared & ~given]
        if len(out):
            yield pd.DataFrame(out, columns=["sig", "node"])
        last, given = rows[-1:], bool(shared[-1] or given[-1])
    give_back()


def _bloom_bits(nodes: np.ndarray) -> np.ndarray:
    x = nodes.view(np.uint64)
    return np.stack([mix(x + salt) % np.uint64(BLOOM_BITS) for salt in (PRIME, SHORT)]).astype(np.int64)


def bloom(nodes: DataFrame) -> np.ndarray:
    """A bit array of fixed size that holds every node; its words are combined before they come here."""

    def words(batches):
        for batch in batches:
            bits = np.unique(_bloom_bits(batch["node"].to_numpy()).ravel())
            word, bit = bits >> 6, np.left_shift(np.uint64(1), (bits & 63).astype(np.uint64))
            at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            yield pd.DataFrame({"word": word[at], "bits": np.bitwise_or.reduceat(bit, at).view(np.int64)})

    found = nodes.mapInPandas(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    array = np.zeros(BLOOM_BITS >> 6, np.uint64)
    for part in found.toLocalIterator():
        array[part.word] = np.uint64(part.bits & 0xFFFFFFFFFFFFFFFF)
    return array


def holds(filled: np.ndarray, node: int) -> bool:
    """False only for a node that the filter was not built from."""
    return all(int(filled[b >> 6]) >> (b & 63) & 1 for b in _bloom_bits(np.array([node]))[:, 0].tolist())


def _rebuilder(shared):
    """Every row's set size and node; the set itself, once a batch, if other nodes may need it."""

    def rebuild(batches):
        filled = shared.value
        for batch in batches:
            sizes, nodes, sets, seen = [], [], [], set()
            for text in whole(batch["text"]):
                h = shingles(text)
                node, kept = (node_of(h) if len(h) else None), None
                if node is not None and node not in seen and len(h) > 3:
                    if holds(filled, node):
                        seen.add(node)
                        kept = h.tobytes()
                sizes.append(len(h))
                nodes.append(node)
                sets.append(kept)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": sizes, "node": pd.array(nodes, dtype="Int64"), "set": sets})
        give_back()

    return rebuild


def _check(key, pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one group that reach the threshold, by exact intersection."""
    held = {n: np.frombuffer(s, np.uint64) for n, s in zip(sets["node"], sets["set"], strict=True)}
    out = []
    for a, b in zip(pairs["a"], pairs["b"], strict=True):
        x, y = held[a], held[b]
        if len(x) > len(y):
            x, y = y, x
        if len(x) * 100 < NEAR * len(y):
            continue
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        both = int((y[at] == x).sum())
        if 100 * both >= NEAR * (len(x) + len(y) - both):
            out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def verified(pairs: DataFrame, sets: DataFrame, homes: DataFrame) -> DataFrame:
    """Linked pairs among ``pairs`` (a, b), checked in groups of (home, part, part)."""
    side = lambda s: homes.select(F.col("node").alias(s), F.col("home"), F.col("part").alias(f"part_{s}"))
    placed = pairs.join(side("a"), "a").join(side("b").drop("home"), "b")
    keyed = placed.select("a", "b", "home", F.least("part_a", "part_b").alias("p"), F.greatest("part_a", "part_b").alias("q"))
    ends = keyed.select(*[F.col(c).alias(f"of_{c}") for c in ("home", "p", "q")], F.explode(F.array("a", "b")).alias("node"))
    wanted = ends.distinct().join(sets, "node")
    groups = keyed.groupBy("home", "p", "q").cogroup(wanted.groupBy("of_home", "of_p", "of_q"))
    return groups.applyInPandas(_check, "a long, b long")


def _overlaps(rows: pd.DataFrame) -> pd.DataFrame:
    """Two parts of a family: links of the asking nodes to nodes of other classes, one for each connection.

    Shingles of the part lie sorted with their owners; a node's overlaps with all of them are counted at once.
    """
    part, asking = rows[~rows["asks"]], rows[rows["asks"]]
    sets = [np.frombuffer(x, np.uint64) for x in part["set"]]
    if not sets or not len(asking):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sizes = np.array([len(x) for x in sets])
    values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    names, at = np.unique(rows["class"], return_inverse=True)
    root = np.arange(len(names))
    own, nodes = at[~rows["asks"].to_numpy()], part["node"].to_numpy()
    out = []
    for node, set_, mine in zip(asking["node"], asking["set"], at[rows["asks"].to_numpy()], strict=True):
        x = np.frombuffer(set_, np.uint64)
        low = np.searchsorted(values, x)
        many = np.searchsorted(values, x, side="right") - low
        place = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(owners[place], minlength=len(sets))
        linked = np.flatnonzero((100 * both >= NEAR * (len(x) + sizes - both)) & (root[own] != root[mine]))
        for k in linked:
            if root[own[k]] != root[mine]:
                out.append((node, nodes[k]))
                root[root == root[own[k]]] = root[mine]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def dealt(families: DataFrame, sizes: DataFrame, together: bool) -> DataFrame:
    """(node, home, part): families in parts of about ``GROUP_SHINGLES``; small ones share a home if wanted."""
    sized = families.join(sizes, "node")
    totals = sized.groupBy("component").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("parts", F.ceil(F.col("total") / GROUP_SHINGLES))
    home = F.concat(F.lit("f"), F.col("component"))
    if together:
        groups = 1 + (totals.agg(F.sum("total")).first()[0] or 0) // GROUP_SHINGLES
        home = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(groups)).cast("string")).otherwise(home)
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    return stage(sized.join(totals, "component").select("node", home.alias("home"), part.alias("part"), "parts"), "homes")


def across(members: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links between classes inside the families of large open buckets (node, class, main)."""
    families = components(members.select("node", F.col("main_node").alias("hub")), "node", "hub")
    homes = dealt(families, sizes, together=False)
    about = members.groupBy("node", "class").agg(F.max(F.col("class") != F.col("main")).alias("out"))
    rows = homes.join(about, "node").join(sets, "node").withColumn("every", F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    wide = ["home", "node", "class", "set"]
    whole = rows.select(*wide, F.explode("every").alias("p"), F.col("part").alias("q"), F.lit(False).alias("asks"))
    asking = rows.filter("out").select(*wide, F.col("part").alias("p"), F.explode("every").alias("q"), F.lit(True).alias("asks"))
    return whole.unionByName(asking).groupBy("home", "p", "q").applyInPandas(_overlaps, "a long, b long")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b")


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    rows, named = _classes(docs)
    return rows.select("doc_id", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: one with its smallest doc_id. Rows with an empty set all stay.

    Only rows that the Bloom filter of nodes in larger components lets through are joined; all others
    pass in place, so the texts of documents that link with nothing are not shuffled.
    """
    rows, named = _classes(docs)
    seen = rows.filter("node is not null").groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    groups = seen.join(named, "node")
    holds_first = F.when(F.col("first").eqNullSafe(F.col("component_id")), F.col("node"))
    sizes = groups.groupBy("component").agg(F.sum("n").alias("rows"), F.min(holds_first).alias("kept")).filter("rows > 1")
    node, unsure, group, key = (free_name(docs, c) for c in ("node", "unsure", "group", "key"))
    affected = groups.join(sizes, "component").select(
        F.col("node").alias(node), F.struct("component", "component_id", "kept").alias(group)
    )
    affected = stage(affected, "affected")
    shared = docs.sparkSession.sparkContext.broadcast(bloom(affected.select(F.col(node).alias("node"))))

    def place(texts: pd.Series) -> pd.DataFrame:
        nodes = [node_of(h) if len(h := shingles(t)) else None for t in whole(texts)]
        hits = [n is not None and holds(shared.value, n) for n in nodes]
        return pd.DataFrame({"node": pd.array(nodes, dtype="Int64"), "hit": hits})

    placed = docs.withColumn(unsure, F.pandas_udf(place, "node long, hit boolean")(F.col("text")))
    alone = placed.filter(~F.col(f"{unsure}.hit")).select(docs.columns)
    met = placed.filter(F.col(f"{unsure}.hit")).withColumn(node, F.col(f"{unsure}.node")).join(affected, node, "left")
    first = (F.col(node) == F.col(f"{group}.kept")) & F.col("doc_id").eqNullSafe(F.col(f"{group}.component_id"))
    one = met.filter(F.col(group).isNull() | first)
    own = F.when(F.col(group).isNull(), F.monotonically_increasing_id())
    one = one.withColumn(key, F.struct(F.col(f"{group}.component"), own.alias("own"))).dropDuplicates([key])
    return alone.unionAll(one.select(docs.columns))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, n_shingles, node), and every node's (node, component, component_id)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    signed = docs.select("text").mapInPandas(_sign, "sig long, node long")
    sorted_rows = signed.repartition("sig").sortWithinPartitions("sig", "node")
    buckets = stage(sorted_rows.mapInPandas(_buckets, "sig long, node long"), "buckets")

    shared = spark.sparkContext.broadcast(bloom(buckets.select("node")))
    rows = stage(docs.select("doc_id", "text").mapInPandas(_rebuilder(shared), "doc_id long, n_shingles long, node long, set binary"), "sets")
    sets = rows.filter("set is not null").dropDuplicates(["node"]).select("node", "set")
    sizes = rows.filter("set is not null").groupBy("node").agg(F.max("n_shingles").alias("n"))

    degrees = buckets.groupBy("node").agg(F.count("*").alias("degree"))
    hubs = buckets.join(degrees, "node").groupBy("sig").agg(F.max(F.struct("degree", "node")).alias("m"))
    hubs = stage(hubs.select("sig", F.col("m.node").alias("hub")), "hubs")
    pairs = stage(_ordered(buckets.join(hubs, "sig"), "node", "hub").distinct(), "pairs")
    homes = dealt(components(pairs), sizes, together=True)
    links = stage(verified(pairs, sets, homes), "links")

    classes = components(links)
    members = buckets.join(classes, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("class"))
    counts = members.groupBy("sig", "class").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    open_ = counts.groupBy("sig").agg(F.sum("n").alias("size"), F.max(F.struct("n", "class", "node")).alias("m")).filter("m.n < size")
    open_ = open_.select("sig", "size", F.col("m.class").alias("main"), F.col("m.node").alias("main_node"))
    members = stage(members.join(open_, "sig"), "open")
    few = members.filter(F.col("size") <= SMALL)
    outside = few.filter("class != main").select("sig", F.col("node").alias("x"), F.col("class").alias("class_x"))
    cross = outside.join(few.select("sig", "node", "class"), "sig").filter("class != class_x")
    rest = stage(_ordered(cross, "x", "node").distinct().join(pairs, ["a", "b"], "left_anti"), "rest")
    late = verified(rest, sets, dealt(components(rest), sizes, together=True))
    late = stage(late.unionAll(across(members.filter(F.col("size") > SMALL), sets, sizes)), "links")
    final = stage(components(links.unionAll(late)), "classes")
    for table in (buckets, hubs, members, homes, pairs, rest):
        drop_table(table)

    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first")).join(final, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    smallest = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", "n_shingles", "node"), nodes.join(smallest, "component").select("node", "component", "component_id")
