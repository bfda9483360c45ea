from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from caremeld.llm import feast, queries
from caremeld.llm import whitening as W

SMALL = "/root/testdata/sf0.001"


def plain(rows, components=8):
    """The same by exact integers and numpy's dense eigenvalues."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in x])
    spread = centred.T @ centred / n
    values, vectors = np.linalg.eigh(spread)
    order = np.argsort(-values)[:components]
    values, vectors = values[order], vectors[:, order]
    white = centred @ vectors / np.sqrt(values)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return [i for i, _ in kept], n, deviation, white, values / np.trace(spread)


def agrees(result, rows, components=8):
    ids, n, deviation, white, explained = plain(rows, components)
    k = len(explained)
    got = result.collect()
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    sign = {}
    by_id = {(r.vec_id, r.component): r for r in got}
    for row, i in enumerate(ids):
        for c in range(k):
            r = by_id[i, c + 1]
            assert int(r.deviation) == deviation[row]
            assert r.explained == pytest.approx(explained[c], rel=1e-10)
            if abs(white[row, c]) > 1e-3:
                sign.setdefault(c, math.copysign(1, r.whitened * white[row, c]))
            assert r.whitened * sign.get(c, 1) == pytest.approx(white[row, c], abs=1e-6)


def test_query_against_plain(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    agrees(queries.QUERIES["op11_whitening"](spark, SMALL), rows)


def made(n, width, seed):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + d) for d in range(width)]) for i in range(n)]


def test_odd_rows(spark):
    rows = made(60, 5, 1)
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [1.0, 2.0, float("inf"), 0.0, 0.0]),
           (104, [float("-inf")] * 5)]
    other = [(200, [1.0, 2.0]), (201, []), (202, [1e30] * 5)]
    frame = spark.createDataFrame([*rows, *odd, *other], "vec_id long, embedding array<double>").repartition(7)
    agrees(W.whitened(frame), rows, 5)


def test_repeated_rows_and_missing_ids_count(spark):
    rows = made(20, 3, 2)
    frame = spark.createDataFrame([*rows, *rows, (None, [0.5, 0.5, 0.5])], "vec_id long, embedding array<float>")
    got = W.whitened(frame).collect()
    assert {r.n for r in got} == {41} and len(got) == 41 * 3 and sum(r.vec_id is None for r in got) == 3


def test_clashing_columns(spark):
    rows = [(i, v, "q", 1.0, 2) for i, v in made(30, 4, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, w string, deviation double, n int")
    agrees(W.whitened(frame), made(30, 4, 3), 4)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    got = W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.collect() == []
    assert got.schema.simpleString() == f"struct<{re.sub(' (?=[a-z])', ':', W.SCHEMA.replace(', ', ','))}>".replace("long", "bigint")


def test_exact_beyond_64_bits(spark):
    rows = [(i, [float(i * 2**28), float(-i)]) for i in range(50)]
    got = W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    deviation = plain(rows, 1)[2]
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviation)) and max(deviation) > 2**63


def spectra():
    rng = np.random.default_rng(5)
    turned = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "random", (lambda a: a.T @ a)(rng.standard_normal((80, 40)))
    yield "falling", (turned * 10.0 ** -np.arange(40)) @ turned.T
    yield "close", (turned * (1 + 1e-9 * np.arange(40))) @ turned.T
    yield "repeated", (turned * np.repeat([5, 4, 3, 2, 1], 8)) @ turned.T
    yield "low rank", (lambda a: a.T @ a)(rng.standard_normal((4, 40)))
    yield "identity", np.eye(12)
    yield "one", np.ones((6, 6))
    for n in (1, 2, 3, 8):
        yield f"{n} wide", (lambda a: a.T @ a)(rng.standard_normal((2 * n, n)))


@pytest.mark.parametrize("name, matrix", spectra())
def test_solver_against_dense(name, matrix):
    values, vectors = feast.largest(matrix, 8)
    dense = np.linalg.eigvalsh(matrix)[::-1]
    positive = dense[dense > len(matrix) * 1e-15 * dense[0]][:8]
    assert values == pytest.approx(positive, rel=0, abs=1e-13 * dense[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * dense[0]


@pytest.mark.parametrize("name, matrix", spectra())
def test_inertia_against_dense(name, matrix):
    inertia, dense = feast.Inertia(matrix), np.linalg.eigvalsh(matrix)
    for shift in np.linspace(-0.1, 1.1, 37) * dense[-1]:
        if np.abs(dense - shift).min() > 1e-12 * dense[-1]:
            assert inertia.above(shift) == (dense > shift).sum()


def test_a_missed_eigenvalue_is_noticed():
    matrix = np.diag([5.0, 4.0, 1.0])
    with pytest.raises(ArithmeticError):
        feast.pairs_inside(matrix, 3.5, 6.0, 3, feast.Contour())
