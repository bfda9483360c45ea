from __future__ import annotations

import random
import re

import numpy as np
import pytest

from caremeld.llm import decontaminate as D


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or "")]


def brute(texts, items, threshold=0.8):
    out = []
    for doc_id, text in texts:
        doc = words(text)
        for item_id, item in items:
            item = words(item)
            n = min(5, len(item))
            wanted = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if item else set()
            held = {tuple(doc[i : i + n]) for i in range(len(doc) - n + 1)}
            if wanted and len(wanted & held) / len(wanted) >= threshold:
                out.append((doc_id, item_id, round(len(wanted & held) / len(wanted), 9)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    return [(i, " ".join(word() for _ in range(rng.choice([5, 6, 12, 25, 60, 150])))) for i in range(30)] + [
        (90, None), (91, ""), (92, "one two"), (93, "same"), (94, "?!"), (30, "same text here"),
    ]


@pytest.fixture(scope="module")
def leaking(texts, items):
    """Items in one piece, with changed words at either side of the threshold, inside short and very long texts."""
    rng = random.Random(4)
    made = []
    for i, (_, item) in enumerate(items[:30]):
        parts = item.upper().split() if i % 2 else item.split()
        changed = parts[: -(len(parts) // 12)] if i % 3 == 1 and len(parts) > 12 else parts[: len(parts) // 2] if i % 3 == 2 else parts
        filler = [rng.choice("kilo lima mike nova oscar papa".split()) for _ in range(rng.choice([0, 40, 8_000]))]
        at = rng.randrange(len(filler) + 1)
        made.append((1000 + i, " ".join(filler[:at] + changed + filler[at:])))
    return [*texts, *made]


def test_finds_what_brute_force_finds(spark, leaking, items):
    docs = spark.createDataFrame(leaking, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = sorted([(r.doc_id, r.item_id, round(r.containment, 9)) for r in D.leaks(docs, table).collect()], key=str)
    assert found == brute(leaking, items)
    assert len({d for d, _, _ in found if d and d >= 1000}) >= 18
    in_passes = D.leaks(docs, table, search=D.Search(items=7))
    assert sorted([(r.doc_id, r.item_id, round(r.containment, 9)) for r in in_passes.collect()], key=str) == found


def test_stage_keeps_clean_rows_and_all_columns(spark, clashing, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    kept = D.without_leaks(clashing, table)
    assert kept.columns == clashing.columns
    bad = {d for d, _, _ in brute([(r.doc_id, r.text) for r in clashing.collect()], items)}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in clashing.collect() if r.doc_id not in bad)


def test_empty_tables(spark, nothing, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(documents, items).count() == 0
    assert D.leaks(nothing, items).count() == 0
    assert D.without_leaks(documents, items).count() == documents.count()


def test_windows_hold_every_occurrence():
    """Minima of blocks, doubled, are the minima of windows twice as long."""
    hashes = D.Hashes(8)
    values = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    small = hashes.minima(values, 16, slab=64)
    assert small.shape == (63, 8)
    direct = hashes.minima(values, 32)
    assert (np.minimum.reduceat(small, np.arange(0, 63, 2), axis=0) == direct).all()


def test_small_items_in_long_documents():
    """Thousands of items of 1 to 12 words, whole and with a changed end, against brute force."""
    rng = random.Random(12)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, " ".join(word("abcdefgh", 12) for _ in range(1 + i % 12))) for i in range(3_000)]
    search = D.Items(rows, D.Search())
    missed = []
    for start in range(0, len(rows), 50):
        parts = [word("ijkl", 3) for _ in range(2_000)]
        for i, item in rows[start : start + 50]:
            item = item.split()
            at = rng.choice([0, len(parts), rng.randrange(len(parts))])
            parts[at:at] = item[:-1] + ["other"] if i % 5 == 0 else item
        text = " ".join(parts)
        found = sorted(((0, i, round(share, 9)) for i, share in search.contained(text)), key=str)
        missed += set(brute([(0, text)], rows[start : start + 50])) ^ set(found)
    assert missed == []


def test_one_pass_at_a_time(spark, leaking, items, monkeypatch):
    """Every pass is written before the next one's items are collected."""
    docs = spark.createDataFrame(leaking, "doc_id long, text string").repartition(2)
    table = spark.createDataFrame(items, "item_id long, text string")
    steps = []

    def collected(frame, collect=type(table).collect):
        steps.extend(["collect"] if "item_id" in frame.columns else [])
        return collect(frame)

    def written(df, label, stored=D.stored):
        steps.append(label)
        return stored(df, label)

    whole = sorted(map(str, D.leaks(docs, table).collect()))
    monkeypatch.setattr(type(table), "collect", collected)
    monkeypatch.setattr(D, "stored", written)
    search = D.Search(items=12)
    found = D.leaks(docs, table, search=search)
    assert steps == ["collect", "leaks-of-a-pass"] * 3
    steps.clear()
    kept = D.without_leaks(docs, table, search)
    assert steps == ["marked-documents", *["collect", "marks-of-a-pass"] * 3]
    monkeypatch.undo()
    assert sorted(map(str, found.collect())) == whole
    assert sorted(map(str, kept.collect())) == sorted(map(str, D.without_leaks(docs, table).collect()))
