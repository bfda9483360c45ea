from __future__ import annotations

import random

import pytest


def sentences(rng: random.Random, n: int) -> str:
    words = [a + b for a in "ba ce di fo gu ha".split() for b in "lan mer nis por tuk vel".split()]
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))


#: Texts that every operator must take: nulls, empties, spaces, ties, repeated rows, odd characters, very long ones.
EDGES = [
    (0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "one two"), (5, "One TWO"), (6, "é 日本語 \U0001f600 ß x"),
    (7, "same text here"), (7, "same text here"), (8, "same text here"), (None, "no id at all"), (None, None),
    (9, "x" * 30_000), (10, " " * 5_000 + "y"), (11, "a b " * 20_000), (12, "\x00\x1f control <|endoftext|> in"),
]


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(3)
    made = [(100 + i, sentences(rng, rng.choice([3, 20, 60, 300]))) for i in range(60)]
    copies = [(200 + i, made[i][1]) for i in range(5)]
    near = [(300 + i, made[i + 10][1] + " extra") for i in range(5)]
    return [*EDGES, *made, *copies, *near]


@pytest.fixture(scope="session")
def documents(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, texts):
    """The same with columns whose names the operators would like to use themselves."""
    rows = [(i, t, "en", "s", 0, 1.0, "q", 3) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, found int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
