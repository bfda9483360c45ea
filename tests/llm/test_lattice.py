from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest

from caremeld.llm import lattice as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces(PATH)


def all_ways(word, pieces, p):
    """The sum over every segmentation, written out."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in pieces.ids:
            total += p[pieces.ids[word[:k]]] * all_ways(word[k:], pieces, p)
    if word[0] not in pieces.singles:
        total += math.prod(p[pieces.bytes[b]] for b in word[0].encode()) * all_ways(word[1:], pieces, p)
    return total


def test_probabilities_are_one(pieces):
    assert pieces.start.sum() == pytest.approx(1)
    assert (pieces.start[pieces.used] > 0).all()


def test_marginals_sum_all_segmentations(pieces):
    lattice = L.Lattice(pieces, pieces.start)
    for word in ("▁the", "▁an", "▁\U0001f9ff", "▁straße", "▁࿰", "▁informations"):
        assert lattice.run([word])[0][0] == pytest.approx(math.log(all_ways(word, pieces, pieces.start)))


def test_expected_counts_are_the_slope_of_the_likelihood(pieces):
    p = pieces.start.copy()
    lattice = L.Lattice(pieces, p)
    words, weights = ["▁then", "▁éclat", "▁࿰xyz"][:1] + ["▁that"], np.array([2.0, 3.0])
    total, expected = lattice.run(words, weights)
    for piece in np.flatnonzero(expected)[:12]:
        moved = p.copy()
        moved[piece] *= 1.0001
        change = (L.Lattice(pieces, moved).run(words)[0] - total) @ weights / math.log(1.0001)
        assert change == pytest.approx(expected[piece], rel=1e-3, abs=1e-6)


def test_against_plain_counts(spark, documents, texts):
    model = L.Model(PATH, block=500)
    rows = L.scored(documents, model).collect()
    split = lambda t: (t or "").encode().translate(L.UPPER_TO_LOWER).split()
    train = Counter(w for i, t in texts if crc32(str("" if i is None else i).encode()) % 10 for w in [*split(t), None])
    n, v = sum(train.values()), len(train)
    expected = sorted(
        (
            str(i),
            crc32(str("" if i is None else i).encode()) % 10 == 0,
            len(split(t)) + 1,
            sum(train[w] > 0 for w in [*split(t), None]),
            round(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*split(t), None]), 6),
        )
        for i, t in texts
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == expected
    assert {r.train_tokens for r in rows} == {n}
    # the score of a text is that of its words and its end, whatever block they came in
    one_block = {(r.doc_id, r.n_tokens): r.score for r in L.scored(documents.coalesce(1), L.Model(PATH)).collect()}
    assert all(r.score == pytest.approx(one_block[r.doc_id, r.n_tokens]) and r.score < 0 for r in rows)


def test_learning_helps_and_edges(spark, documents, nothing, clashing, texts):
    learned = L.scored(documents, L.Model(PATH)).where("held_out").agg({"score": "sum"}).first()[0]
    plain = L.scored(documents, L.Model(PATH, rounds=0)).where("held_out").agg({"score": "sum"}).first()[0]
    assert learned > plain
    assert L.scored(nothing, L.Model(PATH)).count() == 0
    assert L.scored(clashing, L.Model(PATH)).count() == len(texts)
