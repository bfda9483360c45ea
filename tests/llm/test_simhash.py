from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from caremeld.llm import simhash as S
from caremeld.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, distance=2):
    """The smallest position that each value is linked with, by all pairs."""
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, v in enumerate(values):
        for j in range(i):
            if (v ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.fixture(scope="module")
def clustered():
    """Random values, chains, dense balls, and many that share most bits."""
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 150).tolist()
    for start in values[:10]:
        for _ in range(12):
            start ^= 1 << int(rng.integers(64)) | 1 << int(rng.integers(64))
            values.append(start)
    values += [values[20] ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(1, 64, 9)]
    values += [(7 << 40) | int(x) for x in rng.integers(0, 1 << 12, 150)]
    return list(dict.fromkeys(v & (1 << 64) - 1 for v in [*values, 0, 1, (1 << 64) - 1]))


def test_gray_rank(spark):
    ranks = np.arange(64, dtype=np.uint64)
    codes = ranks ^ ranks >> np.uint64(1)
    assert (S.gray_rank(codes) == ranks).all()
    values = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 50)
    rows = spark.createDataFrame([(int(v),) for v in values], "fp long").select("fp", S.gray_rank_column(S.F.col("fp")).alias("r"))
    by_column = [r.fp for r in rows.orderBy("r").collect()]
    assert by_column == values[np.argsort(S.gray_rank(values.view(np.uint64)))].tolist()


def test_tree_finds_all_within_the_distance(clustered):
    values = np.array(clustered, np.uint64)
    values = values[np.argsort(S.gray_rank(values))]
    for fan in (2, 16):
        query, found = S.Tree(values, values, fan).search(values, 2)
        expected = {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 2}
        assert set(zip(query.tolist(), found.tolist())) == expected


@pytest.mark.parametrize("block", [7, 100, 20_000])
def test_links_against_all_pairs(spark, clustered, block):
    signed = np.array(clustered, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(v,) for v in signed], "fp long")
    index = S.Index(block=block, batch=64)
    root = {r.node: r.root for r in connected_components(S.links(distinct, index)).collect()}
    groups = plain_groups(clustered)
    assert len({(root.get(v, v), g) for v, g in zip(signed, groups)}) == len({root.get(v, v) for v in signed}) == len(set(groups))


def test_components_of_long_and_wide_graphs(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (2, 1)], "a long, b long").repartition(5)
    root = {r.node: r.root for r in connected_components(edges).collect()}
    assert root == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert connected_components(edges.limit(0)).count() == 0


def test_against_plain(spark, documents, texts):
    rows = S.near_copies(documents).select("doc_id", S.hexadecimal(S.F.col("fp")).alias("fp"), "component_id").collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    groups = plain_groups(prints)
    smallest = {}
    for (i, _), g in zip(texts, groups):
        smallest[g] = min([x for x in (smallest.get(g), i) if x is not None], default=None)
    expected = [(i, f"{p:016x}", smallest[g]) for (i, _), p, g in zip(texts, prints, groups)]
    assert sorted(map(str, [tuple(r) for r in rows])) == sorted(map(str, expected))


def test_one_of_each(spark, clashing, nothing):
    kept = S.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    component = {r.doc_id: r.component_id for r in S.near_copies(clashing.where("doc_id is not null")).collect()}
    assert ids == sorted(set(component.values()))
    assert kept.where("doc_id is null").count() == 2
    assert S.one_of_each(nothing).count() == 0 and S.near_copies(nothing).count() == 0


def test_an_id_with_different_texts_keeps_one_in_each_component(spark):
    a, b = "the first text of some words that stands here", "quite another one which shares nothing with it at all"
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (3, b, "w"), (1, a, "a"), (None, a, "n")]
    for partitions in (1, 3, 6):
        frame = spark.createDataFrame(rows, "doc_id long, text string, kept_id string").repartition(partitions)
        assert set(map(tuple, S.one_of_each(frame).collect())) == {(1, a, "a"), (1, b, "y"), (None, a, "n")}
