from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caremeld.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = P.Packing(PATH, capacity=40, group=50)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def checked(rows, texts, tokenizer, packing):
    """Every document is there once a row, cut as it must be, and every sequence is gapless and not too long."""
    sequences, found = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    wanted = defaultdict(list)
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.end]
        first = len(ids) % packing.capacity or packing.capacity
        starts = [0, *range(first, len(ids), packing.capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted[doc_id].append((n, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.capacity
    return len(sequences), -(-sum(length for p in sequences.values() for _, length in p) // packing.capacity)


@pytest.mark.parametrize("packing", [SMALL, P.Packing(PATH)])
def test_whole_and_gapless(documents, texts, tokenizer, packing):
    used, least = checked(P.packed(documents, packing).collect(), texts, tokenizer, packing)
    assert used <= least * 1.03 + 2


def test_edges(nothing, clashing, texts, tokenizer):
    assert P.packed(nothing, SMALL).collect() == []
    checked(P.packed(clashing.withColumnsRenamed({"source": "key", "found": "sequence_id"}), SMALL).collect(), texts, tokenizer, SMALL)


def test_many_copies_and_no_fit(spark, tokenizer):
    """Copies in the thousands fill sequences; documents that don't fit together end the rounds."""
    same = [(i, "one two three") for i in range(1000)]
    rows = P.packed(spark.createDataFrame(same, "doc_id long, text string"), SMALL).collect()
    assert checked(rows, same, tokenizer, SMALL)[0] == 100
    alone = [(i, "a b c d e f g h i j k l m n o p q r s t u v") for i in range(300)]
    rows = P.packed(spark.createDataFrame(alone, "doc_id long, text string"), SMALL).collect()
    assert checked(rows, alone, tokenizer, SMALL)[0] == 300


def least_bins(lengths, capacity):
    """The fewest bins, by trying every way."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for n in range(len(bins)):
            if bins[n] + lengths[i] <= capacity:
                place(i + 1, [*bins[:n], bins[n] + lengths[i], *bins[n + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_few_bins_against_all_ways():
    rng, more = random.Random(4), 0
    for _ in range(150):
        lengths = [rng.randint(1, 19) for _ in range(rng.randint(1, 9))]
        found = P.improved(P.best_fit(lengths, 20), lengths, 20)
        assert sorted(i for b in found for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 20 for b in found)
        more += len(found) - least_bins(sorted(lengths, reverse=True), 20)
    assert more <= 2


def test_search_finds_what_best_fit_misses():
    rng = random.Random(1)
    lengths = [rng.randint(400, 800) for _ in range(2000)]
    start = P.best_fit(lengths, 2048)
    assert len(P.improved(start, lengths, 2048)) < len(start) * 0.98


def test_exchange_against_all_exchanges():
    rng = random.Random(2)
    for _ in range(500):
        own = [rng.randint(1, 12) for _ in range(rng.randint(0, 4))]
        others = {rng.randint(1, 20) for _ in range(rng.randint(0, 4))}
        room = rng.randint(1, 15)
        ways = [[], *[[x] for x in own], *map(list, combinations(own, 2))]
        best = max((o - sum(w) for o in others for w in ways if 0 < o - sum(w) <= room), default=0)
        given, length = P.exchange(own, sum(1 << o for o in others), room)
        if not best:
            assert given is None
        else:
            assert length in others and length - sum(given) == best
            rest = list(own)
            for g in given:
                rest.remove(g)
            assert len(given) == min(len(w) for w in ways for o in others if o - sum(w) == best)


def test_every_exchange_raises_the_squared_fill():
    rng = random.Random(3)
    lengths = [rng.randint(300, 900) for _ in range(300)]
    bins = [[i] for i in range(len(lengths))]
    squares = lambda: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    before = squares()
    while P.one_pass(bins, lengths, 2048):
        assert squares() > before
        before = squares()
