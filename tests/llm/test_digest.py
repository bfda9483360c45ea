from __future__ import annotations

import hashlib
import random

import numpy as np

from caremeld.llm import digest as D


def slow_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(D.BUCKETS, np.int64)
    for at in range(len(data) - D.WINDOW + 1):
        for kind, (i, j, k) in enumerate(D.ARRANGEMENTS):
            packed = data[at + i] | data[at + j] << 8 | data[at + k] << 16
            hashed = ((packed + (kind << 24)) * 2654435761) % 2**32
            counts[((hashed ^ hashed >> 15) * 2246822519 % 2**32) >> 24] += 1
    return counts


def test_counts_and_slabs(monkeypatch):
    data = random.Random(1).randbytes(3000)
    expected = slow_counts(data)
    assert (D.bucket_counts(data) == expected).all()
    monkeypatch.setattr(D, "SLAB", 700)
    assert (D.bucket_counts(data) == expected).all()
    assert D.bucket_counts(b"abcd").sum() == 0


def test_likeness_is_bounded_and_tells_copies_apart():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeiounrtls") for _ in range(rng.randint(2, 8)))
    one, other = (" ".join(word() for _ in range(500)) for _ in range(2))
    assert D.likeness(D.digest(one), D.digest(one)) == 1
    assert D.likeness(D.digest(""), D.digest("")) == 1
    near = D.likeness(D.digest(one), D.digest(one.replace(" a", " b")))
    half = D.likeness(D.digest(one), D.digest(D.mixed_with(one, other)))
    far = D.likeness(D.digest(one), D.digest(other))
    assert 1 > near > half > far >= 0
    assert D.likeness(D.digest(one), D.digest("")) == 0


def test_against_plain_order(spark, texts, documents):
    unique = [(i, t) for i, t in texts if i is not None and i != 7]
    made = {r.doc_id: r for r in D.compare_with_next(spark.createDataFrame(unique, "doc_id long, text string").repartition(5)).collect()}
    ordered = sorted(unique, reverse=True)
    assert len(made) == len(unique)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert made[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert made[i].n_chars == len(text)
        assert made[i].fingerprint == D.digest(text) and made[i].edited_fingerprint == D.digest(edited)
        assert made[i].near_edited == D.likeness(D.digest(text), D.digest(edited))
        assert made[i].near_next == D.likeness(D.digest(text), D.digest(following))


def test_edges(spark, documents, texts, nothing, clashing):
    rows = D.compare_with_next(documents).collect()
    assert len(rows) == len(texts) and all(0 <= r.near_next <= 1 and r.edited_sha256 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (7, 8)}) == 1
    assert D.compare_with_next(nothing).count() == 0
    assert D.compare_with_next(clashing).count() == len(texts)
    (alone,) = D.compare_with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
