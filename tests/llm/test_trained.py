"""Trained operators: held-out accuracy on planted signals, gradients, and odd rows."""

import math
import random

import numpy as np
import pytest

from pitlake.llm import language_model, quality, toxicity

SYLLABLES = ["an", "the", "tion", "er", "in", "ou", "st", "re", "ha", "nd"]
INSULTS = ["fiend", "wretch", "brutish", "brutal"]


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def corpus(n=400, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        toxic, good = i % 3 == 0, i % 2 == 0
        sentences = [prose(rng, rng.randrange(4, 12)) for _ in range(rng.randrange(2, 9))]
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += f" {rng.choice(INSULTS)} {prose(rng, 2)}"
        text = ". ".join(sentences)
        rows.append((i, text if good else "!! ".join(text.upper().split()), int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", 1.0) for i, t, _, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels


ODD_ROWS = [(5000, None), (5001, ""), (None, "text"), (5002, "..!?\n"), (5003, "word " * 60_000), (7, "again"), (7, "again")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, "doc_id long, text string").repartition(2)


def held_out_accuracy(report, labels, label):
    joined = report.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(joined) > 40
    return sum(r.predicted == r[label] for r in joined) / len(joined)


def test_toxicity_is_learned_and_located(tables):
    docs, labels = tables
    report = toxicity.report(docs, labels).cache()
    assert held_out_accuracy(report, labels, "toxic") >= 0.95
    texts = {r.doc_id: r.text for r in docs.collect()}
    placed = [texts[r.doc_id][s.start : s.end] for r in report.collect() for s in r.sentences]
    assert placed and sum(any(w in s.lower() for w in INSULTS) for s in placed) >= 0.9 * len(placed)


def test_quality_is_learned(tables):
    docs, labels = tables
    assert held_out_accuracy(quality.report(docs, labels), labels, "quality") >= 0.95


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_score_every_odd_row(tables, odd, operator):
    docs, labels = tables
    rows = operator.report(docs.select("doc_id", "text").unionAll(odd), labels).filter("doc_id is null or doc_id >= 5000 or doc_id = 7").collect()
    assert len(rows) == len(ODD_ROWS) + 1
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_without_labels(tables, operator):
    docs, labels = tables
    assert operator.report(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert operator.report(docs.limit(0), labels).count() == 0


def test_noisy_or_of_sentences():
    weights = toxicity._Words({b"bad": 3.0})
    p, spans = toxicity.score("One bad. Two! Bad three", -2.0, weights)
    sentence = lambda z: 1 / (1 + math.exp(-z))
    assert p == pytest.approx(1 - (1 - sentence(1)) ** 2 * (1 - sentence(-2)))
    assert [(a, b) for a, b, _ in spans] == [(0, 7), (13, 23)]
    assert toxicity.score("", -2.0, weights) == (0.0, [])


def test_quality_reads_the_whole_text_alike_in_runs(monkeypatch):
    net, rng = quality.fresh(5), random.Random(2)
    texts = ["", "é" * 63, "a" * 120, "a" * 121, prose(rng, 900), prose(rng, 40), prose(rng, 4000)]
    whole = [quality.score(net, t) for t in texts]
    assert quality.scores(net, texts) == pytest.approx(whole, abs=1e-6)
    monkeypatch.setattr(quality, "RUN", quality.BLOCK * 2)
    assert [quality.score(net, t) for t in texts] == pytest.approx(whole, abs=1e-6)


def numeric(loss, params, k, at, eps=1e-3):
    params[k].flat[at] += eps
    up = loss()
    params[k].flat[at] -= 2 * eps
    down = loss()
    params[k].flat[at] += eps
    return (up - down) / (2 * eps)


def test_quality_gradient():
    net, rng = quality.fresh(7), random.Random(3)
    docs = [quality.padded(prose(rng, n)) for n in (3, 60, 200)]
    labels = np.array([1, 0, 1], np.float32)
    texts = [bytes(d).rstrip(b"\0").decode() for d in docs]

    def loss():
        p = np.clip(np.array([quality.score(net, t) for t in texts]), 1e-9, 1 - 1e-9)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    grads = quality.gradient(net, docs, labels)
    for k, part in enumerate(net.parts()):
        at = int(np.argmax(np.abs(grads[k])))
        assert numeric(loss, net.parts(), k, at) == pytest.approx(float(grads[k].ravel()[at]), rel=0.15, abs=2e-4), (k, part.shape)


def test_language_model_gradient_and_normalisation():
    params, rng = language_model.fresh(), np.random.default_rng(1)
    around = rng.integers(0, language_model.SIZE, (len(language_model.OFFSETS), 12))
    target = rng.integers(0, language_model.SIZE, 12)
    loss = lambda: -language_model.predict(params, around, target).mean()
    grads = language_model.gradient(params, around, target)
    for k in range(len(params)):
        at = int(np.argmax(np.abs(grads[k])))
        assert numeric(loss, params, k, at, 1e-2) == pytest.approx(float(grads[k].ravel()[at]), rel=0.1, abs=1e-4)
    every = np.arange(language_model.SIZE)
    one = language_model.predict(params, np.repeat(around[:, :1], len(every), axis=1), every)
    assert np.exp(one).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_prefers_text_like_the_corpus(spark):
    rng = random.Random(8)
    pairs = [("red", "apple"), ("blue", "sky"), ("green", "leaf"), ("old", "stone")]
    line = lambda: " ".join(w for _ in range(40) for w in rng.choice(pairs))
    rows = [(i, line()) for i in range(600)]
    shuffled = " ".join(rng.choice(rng.choice(pairs)) for _ in range(80))
    rows += [(9000, line()), (9001, shuffled), (9002, None), (9003, ""), (9002, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lm int")
    got = {r.doc_id: r for r in language_model.report(docs).collect()}
    assert got[9000].score > got[9001].score
    assert (got[9002].n_tokens, got[9002].log_prob, got[9003].score) == (0, 0.0, 0.0)
    assert language_model.report(docs.limit(0)).count() == 0


def test_language_model_spells_words_without_an_entry(spark):
    """Every word has a probability of its own, and junk no longer passes for known words."""
    rng = random.Random(5)
    known = ["".join(rng.choice(SYLLABLES) for _ in range(3)) for _ in range(3000)]
    rows = [(i, " ".join(known[(i * 60 + k) % 3000] for k in range(60))) for i in range(400)]
    junk = lambda: "".join(rng.choice("qxzjvkwy0123456789") for _ in range(12))
    odd = [(9000, " ".join(junk() for _ in range(60))), (9001, "qxzjvk\u00e9"), (9002, "qxzjvk\u00e8")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    entries = language_model.vocabulary(docs)
    index = language_model.index_of(entries)
    bytes_of = {v: k for k, v in index.entries.items()}
    assert len(index.entries) < language_model.SIZE
    words = {w for _, text in rows + odd for w in language_model.words_of(text)}
    assert all(b"".join(bytes_of[i] for i in index[w]).decode() == f" {w}" for w in words)
    assert len({index[w] for w in words}) == len(words)
    got = {r.doc_id: r for r in language_model.report(docs).collect()}
    assert got[9000].n_tokens == 60
    assert got[9000].score < min(got[i].score for i, _ in rows)
    assert got[9001].log_prob != got[9002].log_prob


def test_language_model_trains_on_every_position(spark, monkeypatch):
    """Each piece of each text is a target once in each round."""
    rows = [(f"w{i} x y z " * (i % 7),) for i in range(50)] + [(None,), ("word " * 3_000,)]
    docs = spark.createDataFrame(rows, "text string").coalesce(1)
    entries = language_model.vocabulary(docs)
    index = language_model.index_of(entries)
    shared = spark.sparkContext.broadcast((entries, language_model.fresh()))
    layout = "chunk int, part int, weight double, vector array<float>"
    trained = docs.mapInPandas(language_model._trainer(shared), layout).filter("chunk = 0").agg({"weight": "sum"}).first()[0]
    assert trained == sum(len(index[w]) for (text,) in rows for w in language_model.words_of(text or ""))
    monkeypatch.setattr(language_model, "HELD", 4)
    assert [list(x) for x in language_model.positions(6)] == [[0, 1, 2, 3], [4, 5]]


def test_language_model_spells_many_words_like_one(monkeypatch):
    """Texts spelled together have the entries of their words, also when kept spellings are given up between calls."""
    rng = random.Random(11)
    entries = [b" the", b" th", b"he", b"ther", b"\xc3\xa9", b" a", b"xyz", b" " + b"long" * 20, b"lon"]
    index, plain = language_model.index_of(entries), language_model.index_of(entries)
    monkeypatch.setattr(language_model, "KEPT", 5)
    words = ["the", "then", "ther", "a", "é", "aé", "xyzxyz", "long" * 20, "long" * 21, "q" * 300, "\ud800x"]
    for _ in range(4):
        texts = ["", *("  ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(6)), " \n"]
        ids, sizes, counts = index.spell(texts)
        want = [[e for w in language_model.words_of(t) for e in plain[w]] for t in texts]
        assert ids.tolist() == [e for row in want for e in row]
        assert sizes.tolist() == list(map(len, want))
        assert counts.tolist() == [len(language_model.words_of(t)) for t in texts]
        words += ["".join(rng.choices("aethrxyzlon", k=rng.randrange(1, 9))) for _ in range(5)]
    assert index.spell([""])[0].size == 0


def test_language_model_scores_do_not_depend_on_neighbouring_texts():
    index, params = language_model.index_of([b" the", b"he"]), language_model.fresh()
    texts = ["the thread", "", "he the q the", "z" * 200]
    together = language_model.score_texts(texts, params, index)
    assert [n for n, _ in together] == [2, 0, 4, 1]
    for text, (_, log_prob) in zip(texts, together, strict=True):
        assert language_model.score_texts([text], params, index)[0][1] == pytest.approx(log_prob, abs=1e-4)


def test_language_model_spells_each_text_once(spark):
    """Training and scoring read entries from a table: the same scores as from texts, other columns kept."""
    rows = [(i, f"w{i % 5} x y z " * (i % 4) or None) for i in range(30)] + [(99, ""), (99, "")]
    docs = spark.createDataFrame(rows, "doc_id long, body string").coalesce(1)
    found = language_model.scored(docs, "body", "lm")
    assert found.columns == ["doc_id", "body", "lm"]
    assert found.inputFiles() and all("/pieces-" in f for f in found.inputFiles())
    got = sorted((r.doc_id, r.body or "", r.lm.n_tokens, r.lm.log_prob) for r in found.collect())
    entries = language_model.vocabulary(docs.select(docs.body.alias("text")))
    params = language_model.train(docs.select(docs.body.alias("text")), entries)
    want = language_model.score_texts([b for _, b, _, _ in got], params, language_model.index_of(entries))
    assert [n for _, _, n, _ in got] == [n for n, _ in want]
    assert [p for *_, p in got] == pytest.approx([p for _, p in want], abs=1e-3)
