from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest

from caremeld.llm import quality as Q

SMALL = Q.Network(sample=200, chunk=64, filters=8, units=6, epochs=6)


def texts_of(kind, n, seed):
    rng = random.Random(seed)
    plain = lambda: " ".join(rng.choice("alpha beta gamma delta ruin stone river".split()) for _ in range(rng.randint(5, 90)))
    return [plain() if kind else plain().upper().replace(" ", "!! ") for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    texts = texts_of(1, 60, 1) + texts_of(0, 40, 2)
    return Q.trained([Q.chunks_of(t, SMALL) for t in texts], np.array([1] * 60 + [0] * 40), SMALL)


def test_chunks_cover_every_byte():
    for n in (0, 1, 31, 32, 33, 64, 65, 96, 97, 1000):
        data = bytes(i % 251 for i in range(n)).decode("latin-1")
        raw = np.frombuffer(data.encode(), np.uint8)
        chunks = Q.chunks_of(data, SMALL)
        step = SMALL.chunk // 2
        joined = np.concatenate([chunks[0], *[c[step:] for c in chunks[1:]]])
        assert (joined[: len(raw)] == raw).all() and (joined[len(raw) :] == Q.PAD).all()


def test_gradients_are_slopes():
    model = Q.Model.new(replace(SMALL, filters=4, units=3))
    chunks = np.concatenate([Q.chunks_of(t, SMALL)[:2] for t in ("some words here " * 9, "other " * 30, "x")])
    owner, labels, weight = np.array([0, 0, 1, 1, 2]), np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        total = 0
        for i in range(3):
            units = model.units(chunks[owner == i])
            z = np.concatenate([units.max(axis=0), units.mean(axis=0)]) @ model.weights["last"][:, 0] + model.weights["last_bias"][0]
            total += weight[i] * (np.log1p(np.exp(-z)) if labels[i] else np.log1p(np.exp(z)))
        return total / 3

    gradients = model.gradients(chunks, owner, labels, weight)
    rng = np.random.default_rng(0)
    for name, g in gradients.items():
        flat = model.weights[name].astype(np.float64)
        model.weights[name] = flat
        for at in rng.permutation(flat.size)[:6]:
            index = np.unravel_index(at, flat.shape)
            old = flat[index]
            flat[index] = old + 1e-5
            up = loss()
            flat[index] = old - 1e-5
            down = loss()
            flat[index] = old
            assert (up - down) / 2e-5 == pytest.approx(g[index], abs=2e-3)


def test_held_out_accuracy(model):
    good = [model.score(t) for t in texts_of(1, 40, 7)]
    bad = [model.score(t) for t in texts_of(0, 40, 8)]
    assert np.mean(np.array(good) >= 0.5) > 0.95 and np.mean(np.array(bad) < 0.5) > 0.95


def test_whole_text_counts(model):
    good = " ".join(texts_of(1, 20, 3))
    junk = " ".join(texts_of(0, 20, 4))
    assert model.score(good + junk) != model.score(good)
    assert model.score("") == model.score("") and 0 <= model.score("") <= 1


def test_on_tables(spark, clashing, texts, nothing):
    kinds = texts_of(1, 30, 5) + texts_of(0, 30, 6)
    docs = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)] + [(None, 1), (3, None), (5, 1), (999, 0)], "doc_id long, label int")
    model = Q.fitted(docs, labels, network=SMALL)
    scored = {r.doc_id: r.s for r in docs.select("doc_id", Q.scores(docs.text, model).alias("s")).collect()}
    assert np.mean([(scored[i] >= 0.5) == (i < 30) for i in range(60)]) > 0.9
    again = Q.fitted(docs.repartition(5), labels.repartition(4), network=SMALL)
    assert all((again.weights[k] == model.weights[k]).all() for k in model.weights)
    rows = clashing.select("doc_id", "text", Q.scores(clashing.text, model).alias("s")).collect()
    assert len(rows) == len(texts) and all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if not r.text}) == 1
    nobody = Q.fitted(docs, labels.where("label = 1"), network=SMALL)
    assert nobody is None and {r.s for r in docs.select(Q.scores(docs.text, nobody).alias("s")).collect()} == {0.5}
    assert nothing.select(Q.scores(nothing.text, model).alias("s")).count() == 0


def plain_score(text, model):
    """Every filter at every place of every chunk, one product at a time."""
    n, w = model.network, {k: v.astype(float) for k, v in model.weights.items()}
    raw = list(text.encode())
    step = n.chunk // 2
    begins = range(0, max(1, -(-(len(raw) - step) // step)) * step, step)
    units = []
    for begin in begins:
        chunk = [raw[i] if i < len(raw) else Q.PAD for i in range(begin, begin + n.chunk)]
        pooled = []
        for f in range(n.filters):
            best = 0.0
            for at in range(0, n.chunk - n.width + 1, n.stride):
                total = w["filter_bias"][f]
                for k in range(n.width):
                    for e in range(n.embedding):
                        total += w["embed"][chunk[at + k]][e] * w["filter"][k * n.embedding + e][f]
                best = max(best, total)
            pooled.append(best)
        units.append([max(0.0, sum(p * w["dense"][f][u] for f, p in enumerate(pooled)) + w["dense_bias"][u]) for u in range(n.units)])
    features = [max(c) for c in zip(*units)] + [sum(c) / len(units) for c in zip(*units)]
    logit = sum(x * y for x, y in zip(features, w["last"][:, 0])) + w["last_bias"][0]
    return 1 / (1 + np.exp(-logit))


@pytest.mark.parametrize("text", ["", "a", "ruin stone " * 4, "é日本 \U0001f600 !! " * 12, "x" * 200, "mixed UP " * 30 + "tail"])
def test_score_against_plain_loops(text):
    network = Q.Network(chunk=32, width=4, stride=2, embedding=3, filters=5, units=4)
    model = Q.Model.new(network)
    rng = np.random.default_rng(1)
    model.weights = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in model.weights.items()}
    assert model.score(text) == pytest.approx(plain_score(text, model), abs=1e-5)


def test_whole_sampled_texts_train(spark, monkeypatch):
    """Every byte of the sampled rows reaches training, however long the text, and no other row does."""
    seen = []
    monkeypatch.setattr(Q, "trained", lambda texts, labels, network: seen.extend(zip(texts, labels.tolist())))
    long = "".join(chr(97 + i % 26) for i in range(50_000))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, None), (4, "unlabelled"), (2, "same id")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (9, 0), (None, 1)], "doc_id long, label int")
    Q.fitted(docs, labels, network=SMALL)
    step = SMALL.chunk // 2
    back = [(bytes(b for b in [*t[0], *[x for c in t[1:] for x in c[step:]]] if b != Q.PAD).decode(), label) for t, label in seen]
    assert back == [(long, 1), ("same id", 0), ("", 1)]
