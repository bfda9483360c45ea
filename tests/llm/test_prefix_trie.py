from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from caremeld.llm import prefix_trie as T

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string"


def said(role, text):
    role = role or ""
    return hashlib.sha256(f"{len(role)}:{role}{text or ''}".encode()).hexdigest()


def by_conversation(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append(((turn is not None, turn or 0, role or "", said(role, text)), (role or "", text or "")))
    return {c: [t for _, t in sorted(v)] for c, v in turns.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain(paths):
    """Every node by its whole prefix, from the root, one at a time."""
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        stack, saved, leaves = [node], 0, 0
        while stack:
            now = stack.pop()
            saved += (len(members[now]) - 1) * len(now[-1][1]) if now else 0
            leaves += not children[now]
            stack += children[now]
        return leaves, saved

    rows = set()
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(inside), len(node), parent, len(inside), len(children[node]), *below(node), hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def found(turns, members, block=T.BLOCK):
    rows = [tuple(r[c] for c in COLUMNS) for r in T.prefix_trie(turns, members, block).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def talk(seed, n=60):
    """Conversations that begin alike to different depths, some equal, some cut short."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        stem = rng.choice([[], ["a"], ["a", "b", "c"], ["a", "b", "c", "d", "e", "f", "g", "h", "i"]])
        path = stem + [rng.choice("xyz") * rng.randint(1, 3) for _ in range(rng.choice([0, 0, 1, 3, 6]))]
        rows += [(c * 7 - 50, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(path)]
    return rows


@pytest.mark.parametrize("block", [1, 2, 4, 7])
def test_against_whole_prefixes(spark, block):
    rows = talk(block)
    turns = T.described(spark.createDataFrame(rows, SCHEMA).repartition(5))
    members = spark.createDataFrame([(c,) for c in {r[0] for r in rows} | {10_001, 10_002}], "conv_id long")
    paths = by_conversation(rows) | {10_001: [], 10_002: []}
    assert found(turns, members, block) == plain(paths)


def test_shared_beginnings(spark):
    rng = random.Random(9)
    rows = [(c, i, rng.choice(["user", "assistant"]), rng.choice(["p", "q", "r"])) for c in [*range(0, 40), *range(95, 130), 305, -3, -107, -100] for i in range(rng.randint(1, 8))]
    turns, members = T.with_shared_beginnings(T.described(spark.createDataFrame(rows, SCHEMA)))
    assert found(turns, members) == plain(rebuilt(by_conversation(rows)))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "user", "b"), (1, 0, "a", "z"), (2, None, "", ""),
            (2, 0, "a", "z"), (3, 1, "us", "er"), (4, 1, "user", ""), (None, 0, "user", "nobody"), (5, 2, "user", "é\U0001f600")]
    clashing = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], f"{SCHEMA}, place long, said int, first string")
    turns = T.described(clashing)
    members = spark.createDataFrame([(c,) for c in range(1, 6)], "conv_id long")
    assert found(turns, members) == plain(by_conversation(rows))


def test_no_conversation(spark):
    turns, members = T.with_shared_beginnings(T.described(spark.createDataFrame([], SCHEMA)))
    assert T.prefix_trie(turns, members).collect() == []


def test_a_large_group_of_copies_and_a_long_conversation(spark, monkeypatch):
    """Thousands of equal conversations end in one node, whose ids are hashed from pieces; one has thousands of turns."""
    monkeypatch.setattr(T, "PIECE", 100)
    rows = [(c, i, "user", f"t{i}") for c in range(3000) for i in range(3)] + [(5000, i, "user", f"t{i}") for i in range(3000)]
    turns = T.described(spark.createDataFrame(rows, SCHEMA).repartition(8))
    members = spark.createDataFrame([(c,) for c in [*range(3000), 5000]], "conv_id long")
    got = {r[:2]: r for r in found(turns, members)}
    assert len(got) == 3001
    ends = ",".join(map(str, range(3000)))
    sizes = [len(f"t{i}") for i in range(3)]
    assert got[0, 3] == (0, 3, 0, 3001, 1, 1, 3000 * sizes[2], hashlib.sha256(ends.encode()).hexdigest())
    assert got[0, 0][-2] == 3000 * sum(sizes) and got[5000, 3000][2:6] == (5000, 1, 0, 1)


def test_siblings_alone_are_grouped(spark):
    """Only blocks that diverge reach the grouping by turn."""
    same = [(c, i, "user", f"t{i}") for c in range(20) for i in range(8)]
    other = [(c, i, "user", f"t{i}" if i < 5 else f"{c}-{i}") for c in (100, 101) for i in range(8)]
    tags = T.tagged(T.described(spark.createDataFrame(same + other, SCHEMA)), 4)
    boundaries = T.refined(T.chained(tags), tags)
    assert {r.k for r in boundaries.where("alone").collect()} == {0}
    assert boundaries.where("not alone").count() == 3 * 4
