"""Spelling variants, quality rules and collocations against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from pitlake.llm import bloom, collocations, quality_rules, variants

SCHEMA = "doc_id long, text string, lang string, source string, word string, n long, score double"
SYLLABLES = ["an", "the", "tion", "er", "in", "ou", "st", "ré", "ß"]


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, "clash", 7, 0.5)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 6))) for _ in range(260)]
    letters = "abcxyzé"
    for word in vocabulary[:120]:  # near words by every kind of edit
        i, c = rng.randrange(len(word) + 1), rng.choice(letters)
        vocabulary += [word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :]]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, weights, k=rng.randrange(5, 120))
        marks = [w + rng.choice(["", "", "", ",", ".", "\n", "\t", "ÄÖ"]) for w in words]
        rows.append(row(i, " ".join(marks).capitalize(), rng.choice(["en", "de", None])))
    rows += [row(900, None), row(901, ""), row(None, "alonesome alonesome"), row(902, "x" * 3000 + " " + "x" * 3000), row(903, "...\n  \n"), rows[3], rows[3]]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


# --- spelling variants ----------------------------------------------------------------------


def plain_variants(rows, every=31):
    counts = collections.Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        found[w] = (len(others), best if best and n[best] >= 10 * n[w] else None)
    out = set()
    for w, (k, form) in found.items():
        root = w
        while found[root][1]:
            root = found[root][1]
        out.add((w, form, root, n[w], k, n.get(form)))
    return out


@pytest.mark.parametrize("group_chars", [variants.GROUP_CHARS, 40])
def test_variants_equal_brute_force(docs, corpus, group_chars):
    words = variants.word_counts(docs, drop_every=31).cache()
    got = variants.variants(words, group_chars=group_chars).collect()
    want = plain_variants(corpus)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100
    assert any(r.form for r in got) and any(r.n_near > 1 for r in got)


def test_composition_finds_each_pair_once():
    rng = random.Random(3)
    short = sorted({"".join(rng.choice("ab") for _ in range(6)) for _ in range(40)})
    long = sorted({"".join(rng.choice("ab") for _ in range(7)) for _ in range(60)})
    got = [tuple(sorted(p, key=lambda w: (len(w), w))) for p in variants.composed(short, long, 9)]
    want = {(a, b) for a in short for b in short if a < b and sum(x != y for x, y in zip(a, b, strict=True)) == 1}
    want |= {(a, b) for a in short for b in long if any(b[:i] + b[i + 1 :] == a for i in range(7))}
    assert len(got) == len(set(got)) and set(got) == want


def test_acceptors_are_minimal():
    machine = variants.Acceptors()
    start = machine.of(sorted(a + b + c for a in "abc" for b in "xy" for c in "pq"))
    assert len(machine.moves) == 4 and sorted(machine.suffixes(start))[:2] == ["axp", "axq"]


def test_long_texts_are_cut_between_words():
    text = "alpha beta " * 50 + "gammagamma"
    parts = list(variants.slices(text, 100))
    assert "".join(parts) == text and all(not p[0].isalpha() for p in parts[1:]) and len(parts) > 3


def test_variants_of_nothing(docs):
    assert variants.report(docs.limit(0)).count() == 0
    assert variants.report(docs.filter("doc_id IN (900, 901, 903)")).count() == 0


# --- quality rules --------------------------------------------------------------------------


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("text", ["", None, "a b c d e a b c d e", "a\n a\na\n\n \n a", "x " * 40, "\x0b\x1c é # é|<>\nü", "a b c d e f " * 3 + "z " * 9])
def test_counts_equal_their_definition(text):
    assert quality_rules.measured(text or "")[:5] == plain_counts(text)


def test_chi_square_quantiles():
    assert quality_rules.chi_square_quantile(0.5, 5) == pytest.approx(4.3515, abs=1e-3)
    assert quality_rules.chi_square_quantile(0.9999, 5) == pytest.approx(25.745, abs=1e-2)


def plain_mcd(z, start, steps=60):
    """Concentration steps on one group in numpy, from a start whose half is given by distances."""
    h, ridge, near = len(z) // 2 + 1, np.diag(np.square(quality_rules.FLOORS)), start
    for _ in range(steps):
        half = z[np.argsort(near, kind="stable")[:h]]
        centre, cov = half.mean(axis=0), np.cov(half.T, bias=True) + ridge
        near = np.einsum("ij,jk,ik->i", z - centre, np.linalg.inv(cov), z - centre)
    return centre, near


@pytest.fixture(scope="module")
def mixed(spark):
    rng, rows = random.Random(4), []
    for i in range(900):
        lang, source = rng.choice(["en", "de"]), rng.choice(["hot", "hot", "cold", "rare" if i % 90 == 1 else "hot"])
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(40, 90))]
        junk = i % 5 == 0
        rows.append(row(i, " ".join(w + "#$%" for w in words) if junk else " ".join(words), lang, source))
    rows += [row(2000, None), row(2001, ""), row(2002, "few words"), row(2003, rows[1][1], None, None), row(2004, "word " * 30_000), rows[7], rows[7]]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_outliers_of_each_group_are_rejected(mixed):
    got = {r.doc_id: r for r in quality_rules.report(mixed).collect()}
    assert len(got) == 905 and mixed.count() == 907
    for i in range(900):
        assert got[i].kept == (i % 5 != 0), i
    assert [got[i].base_failed for i in range(2000, 2005)] == [True, True, True, False, True]
    assert got[2003].kept and not got[2000].kept and got[2000].n_words == 0


def test_estimate_equals_plain_concentration_steps(spark, mixed):
    counted = quality_rules.statistics(mixed.filter("lang = 'en' AND source = 'hot' AND doc_id < 900"))
    rows = counted.select("doc_id", *[v.alias(z) for v, z in zip(quality_rules.vector(), quality_rules.Z, strict=True)])
    grouped = rows.selectExpr("'g' AS g", "CAST(doc_id % 5 AS INT) AS salt", *quality_rules.Z)
    limits = quality_rules.fit(grouped, steps=40).first()
    z = np.array([list(r)[1:] for r in rows.collect()])
    middle = np.abs(z - np.median(z, axis=0)) / np.array(quality_rules.FLOORS)
    centre, near = plain_mcd(z, (middle**2).sum(axis=1))
    assert [limits[m] for m in quality_rules.MU] == pytest.approx(centre.tolist(), abs=0.01)
    white = np.zeros((quality_rules.SIZE, quality_rules.SIZE))
    for i, j in quality_rules.PAIRS:
        white[i, j] = limits[f"w{i}_{j}"]
    own = np.square((z - np.array([limits[m] for m in quality_rules.MU])) @ white.T).sum(axis=1)
    assert np.median(own) == pytest.approx(np.median(near), rel=0.1) and (own > 26).sum() == (near > 26).sum()


def test_small_tables_are_judged_by_the_base_rules_alone(spark, mixed):
    assert quality_rules.report(mixed.limit(0)).count() == 0
    few = quality_rules.report(mixed.filter("doc_id < 20")).collect()
    assert len(few) == 22 and all(r.kept for r in few)  # the repeated row is there three times


# --- collocations ---------------------------------------------------------------------------


def plain_phrases(rows, least, first):
    f, total = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    f = {p: n for p, n in f.items() if n >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        inside = any(
            100 * n >= 100 * a and l2 == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (l2, q), n in f.items()
        )
        if not inside:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], total[lang]))
    return {(lang, i + 1, x[2].decode(), -x[1], *x[3:], -x[0]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:first])}


@pytest.mark.parametrize("entries, burst", [(collocations.TRIE_ENTRIES, collocations.CONTAINER_ENTRIES), (30, 3)])
def test_collocations_equal_brute_force(docs, corpus, entries, burst):
    found, totals = collocations.frequent_phrases(docs, least=3, entries=entries, burst=burst)
    got = collocations.first_of_each(collocations.scored(found, totals), first=40).collect()
    want = plain_phrases(corpus, 3, 40)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 60
    assert any(len(r.phrase.split(" ")) > 2 for r in got) and {r.lang for r in got} == {"en", "de", "und"}


def test_scores_beyond_64_bits_are_exact(spark):
    found = spark.createDataFrame([("en", "a", 1, 4 * 10**9), ("en", "b", 1, 3 * 10**9 + 1), ("en", "a b", 2, 2 * 10**9)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", 7 * 10**15)], "lang string, n long")
    assert collocations.scored(found, totals).first().score == 1000 * 2 * 10**9 * 7 * 10**15 // (4 * 10**9 * (3 * 10**9 + 1))


def test_trie_counts_bursts_and_gives_up_subtrees():
    rng, trie, want = random.Random(1), collocations.HatTrie(burst=4), collections.Counter()
    for _ in range(3000):
        path = tuple(rng.randrange(1, 7) for _ in range(rng.randrange(1, 5)))
        trie.add(path[0], [path[1:]], [2])
        want[path] += 2
    assert trie.entries == len(want) and type(trie.root[1]) is dict
    got = dict(x for first in trie.largest() for x in trie.take(first))
    assert got == dict(want) and trie.entries == 0 and not trie.root


@pytest.mark.parametrize("of, lot", [(1, 400_000), (7, 20)])
def test_runs_hold_each_phrase_once_in_its_partition(monkeypatch, of, lot):
    monkeypatch.setattr(collocations, "LOT", lot)
    rng, table, trie, want = random.Random(4), collocations.Words(np.full(1 << 16, 255, np.uint8)), collocations.HatTrie(burst=4), collections.Counter()
    words = ["a", "ab", "é", "z!", "\x1c", "a" * 40, "ß", "\ue000", "\U0001f600"]
    numbers = {word: int(table.of("en", [word.encode()])[0]) for word in words}
    for n in (1, 1 << 33):  # counts of four and of eight bytes
        for _ in range(200):
            phrase = rng.choices(words, k=rng.randrange(2, 6))
            path = tuple(map(numbers.get, phrase))
            trie.add(path[0], [path[1:]], [n])
            want[" ".join(phrase)] += n
    got, part_of = collections.Counter(), {}
    for frame in collocations._run(trie, table, trie.largest(), {"en": of}):
        for lang, part, phrases, counts in frame.itertuples(index=False):
            run = list(collocations._unpacked(phrases, counts))
            assert lang == "en" and 0 <= part < of
            assert [p.split(" ") for p, _ in run] == sorted(p.split(" ") for p, _ in run)
            for phrase, n in run:
                got[phrase] += n
                assert part_of.setdefault(tuple(phrase.split(" ")[:2]), part) == part
    assert got == want and trie.entries == 0
    assert len(set(part_of.values())) == min(of, 7)


def test_words_with_equal_keys_and_long_words_keep_their_numbers(monkeypatch):
    monkeypatch.setattr(bloom, "mixed", lambda x: x & np.uint64(3))  # nearly all words share a key
    monkeypatch.setattr(collocations, "SLICE", 40)
    table, texts = collocations.Words(), ["one two. three four", "a" * 50 + " one ,two", "é\x1ctwo\tthree! ", ""]
    ids = table.ids("en", texts).tolist()
    words = [w for t in texts for piece in [*re.split("[.,!]", t), ""] for w in [*piece.split(" "), None] for w in (w.split("\t") if w else [w])]
    spelled = [table.text[i] for i in ids if i]
    assert spelled == [w for w in words if w]
    assert len(table.text) == len(set(table.text)) and ids[2] == 0


def test_collocations_of_nothing(docs):
    assert collocations.report(docs.limit(0)).count() == 0
    assert collocations.report(docs.filter("doc_id IN (900, 901, 903)")).count() == 0


def test_bloom_filter_holds_all_it_was_built_from(spark):
    numbers = spark.range(0, 20_000, 1, 7).selectExpr("xxhash64(id) AS hash")
    filled = bloom.build(numbers, bloom.size_for(20_000))
    inside = np.array([r.hash for r in numbers.collect()], np.int64).view(np.uint64)
    assert bloom.may_hold(filled, inside).all()
    assert bloom.may_hold(filled, np.arange(10_000, dtype=np.uint64)).mean() < 0.02
    assert not bloom.build(numbers.limit(0), bloom.SMALLEST).any()
