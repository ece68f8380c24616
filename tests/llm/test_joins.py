"""Similarity joins and components against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlake.llm import embeddings, jaccard
from pitlake.llm.components import components


def classes(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)] + [(5, 5), (700, 701), (701, 700)]
    edges += [(1000 + rng.randrange(200), 1000 + rng.randrange(200)) for _ in range(150)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    want = classes({x for e in edges for x in e}, edges)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert components(df.limit(0)).count() == 0


def word_sets(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_copies(seed=1):
    """Chains, families, shared lines and exact copies, with edits around the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    line = [rng.choice(words) for _ in range(14)]
    rows = []
    for size in (4, 6, 8, 11, 20, 45, 120, 400):
        for _ in range(3):
            base = [rng.choice(words) for _ in range(size)]
            text = base
            for _ in range(6):
                rows.append(" ".join(text))
                rows.append(" ".join(line + text) if rng.random() < 0.4 else " ".join(text).upper())
                text = list(text if rng.random() < 0.5 else base)
                for _ in range(rng.randrange(0, 2 + size // 40)):
                    at = rng.randrange(len(text))
                    text[at : at + 1] = rng.choice([[], [rng.choice(words)], [text[at], rng.choice(words)]])
                text = text or base
    rows += [" ".join(line + [rng.choice(words) for _ in range(rng.randrange(1, 60))]) for _ in range(150)]
    rows += [None, "", " \n", "one two", "one  Two", "one two three four five", "one two three four five six"]
    ids = rng.sample(range(10**6), len(rows))
    return list(zip(ids, rows, strict=True))


def jaccard_classes(rows):
    sets = [(i, word_sets(t)) for i, t in rows]
    edges = []
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                edges.append((a, b))
    return classes([i for i, _ in rows], edges), {i: len(s) for i, s in sets}


@pytest.fixture(scope="module")
def copies(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, node string, Unsure int")
    return rows, docs.repartition(5)


def test_jaccard_classes_equal_brute_force(copies):
    rows, docs = copies
    want, sizes = jaccard_classes(rows)
    assert 1 < len(set(want.values())) < len(want)
    got = jaccard.joined(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert jaccard.joined(docs.limit(0)).count() == 0


@pytest.mark.parametrize("small", [1, 1000])
def test_jaccard_result_does_not_depend_on_group_or_bucket_sizes(copies, monkeypatch, small):
    rows, docs = copies
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 200)
    monkeypatch.setattr(jaccard, "SMALL", small)
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs).collect()} == jaccard_classes(rows)[0]


def test_every_linked_pair_shares_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(1500):
        n = int(rng.integers(4, 200))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, max(1, len(base) // 8) + 1))
        other = np.unique(np.concatenate([rng.permutation(base)[drop:], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8)), dtype=np.int64).astype(np.uint64)]))
        both = len(np.intersect1d(base, other))
        if 100 * both >= 80 * (len(base) + len(other) - both) and len(base) + len(other) > 2 * both:
            assert np.intersect1d(jaccard.signatures(base), jaccard.signatures(other)).size


def test_buckets_do_not_depend_on_batches():
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"sig": np.sort(rng.integers(0, 40, 300)), "node": rng.integers(0, 60, 300)}).sort_values(["sig", "node"], ignore_index=True)
    whole = pd.concat(list(jaccard._buckets([rows])))
    for step in (1, 2, 3, 7, 50):
        parts = pd.concat(list(jaccard._buckets([rows.iloc[i : i + step] for i in range(0, len(rows), step)])))
        assert parts.values.tolist() == whole.values.tolist()
    members = rows.drop_duplicates()
    assert whole.values.tolist() == members[members.groupby("sig")["node"].transform("size") > 1].values.tolist()


def test_one_row_of_each_component_stays(spark, copies):
    rows, docs = copies
    again = docs.unionAll(docs.filter("doc_id % 7 = 0")).unionAll(spark.createDataFrame([(None, None, None, None), (None, "alone here", None, None)], docs.schema))
    want, sizes = jaccard_classes(rows)
    kept = jaccard.one_of_each(again)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.filter("doc_id is not null").collect() if sizes[r.doc_id]]
    assert sorted(found) == sorted({c for i, c in want.items() if sizes[i]})
    assert kept.filter("doc_id is null").count() == 2


def vectors(seed=4, dims=24):
    rng, rows = np.random.default_rng(seed), []
    for size in (1, 2, 5, 40, 90):
        for _ in range(4):
            centre = rng.normal(size=dims)
            for _ in range(size):
                rows.append((centre + rng.normal(size=dims) * rng.choice([0.02, 0.12, 0.22])) * rng.uniform(0.5, 3))
    rows += [rows[3]] * 30
    return [[float(x) for x in r] for r in rows]


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "FAN", 2)
    rows = vectors()
    odd = [None, [], [0.0] * 24, [math.nan] * 24, [math.inf] + [1.0] * 23, [None] + [1.0] * 23, [1e-200] * 24, [1e-200] * 24, [1.0, 2.0], [2.0, 4.0]]
    data = [(7 * i % 100_003, v, 1) for i, v in enumerate(rows + odd)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(4)
    good = {i: np.array(v) / np.abs(v).max() for i, v, _ in data if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.sqrt(v @ v) for i, v in good.items()}
    edges = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    want, links = classes([i for i, _, _ in data], edges), {i: 0 for i, _, _ in data}
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    got = embeddings.near_duplicates(table).collect()
    assert len(got) == len(data)
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embeddings_of_empty_and_invalid_tables(spark):
    table = spark.createDataFrame([(1, None), (None, [0.0, 0.0]), (2, [])], "vec_id long, embedding array<float>")
    assert {(r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(table).collect()} == {(1, 0, 1), (None, 0, None), (2, 0, 2)}
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_jaccard_keeps_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (4, "a b c d e f g"), (None, "z")], "doc_id long, text string")
    got = jaccard.joined(docs).orderBy(F.col("doc_id").asc_nulls_first(), "component_id").collect()
    assert sorted([(r.doc_id, r.component_id) for r in got], key=str) == sorted([(None, 4), (4, 4), (None, None)], key=str)
