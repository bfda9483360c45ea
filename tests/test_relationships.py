"""Chains, several targets, dead ends and circles of relationships, against following them one by one."""

from __future__ import annotations

import random

import pytest

from caremeld.operators import concepts as C
from caremeld.operators import relationships as R

EDGES = "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string"
CONCEPTS = "CONCEPT_ID long, VOCABULARY_ID string, STANDARD_CONCEPT string, CONCEPT_CODE string"


def by_hand(concepts, edges):
    standard = {c[0]: c[2] == "S" for c in concepts}
    out = set()
    for start in (c for c, s in standard.items() if not s):
        seen, stack = set(), [start]
        while stack:
            at = stack.pop()
            for a, b, kind, invalid in edges:
                if a == at and b != a and kind == "Maps to" and not invalid and b in standard and b not in seen:
                    seen.add(b)
                    if standard[b]:
                        out.add((start, b))
                    else:
                        stack.append(b)
    return out


def found(spark, concepts, edges):
    vocabulary = spark.createDataFrame(concepts, CONCEPTS)
    rows = [tuple(r) for r in R.standard_targets(vocabulary, spark.createDataFrame(edges, EDGES)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_chains_circles_and_several_targets(spark):
    concepts = [(i, "SNOMED", "S" if i >= 100 else "", str(i)) for i in [*range(1, 20), *range(100, 110)]]
    link = lambda a, b, kind="Maps to", invalid="": (a, b, kind, invalid)
    edges = [
        link(1, 100), link(2, 3), link(3, 4), link(4, 101), link(5, 102), link(5, 103), link(5, 6), link(6, 104),
        link(7, 8), link(8, 7), link(9, 10), link(10, 9), link(10, 105), link(11, 11), link(12, 999), link(13, 106, "Is a"),
        link(14, 107, "Maps to", "D"), link(1, 100), link(15, 15), link(15, 108), link(100, 109), link(16, 100), link(17, 2), link(4, 101, "Maps to", None),
    ]
    got = found(spark, concepts, edges)
    assert got == by_hand(concepts, edges)
    assert {b for a, b in got if a == 5} == {102, 103, 104} and {b for a, b in got if a == 17} == {101}
    assert {b for a, b in got if a == 9} == {105} and not {a for a, _ in got} & {7, 8, 11, 12, 13, 14, 100}
    assert {b for a, b in got if a == 16} == {100}  # a standard concept is an end, whatever it maps to


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    concepts = [(i, "SNOMED", rng.choice(["", "", "S"]), str(i)) for i in range(40)]
    edges = [(rng.randrange(42), rng.randrange(42), "Maps to", "") for _ in range(60)]
    assert found(spark, concepts, edges) == by_hand(concepts, edges)


def test_lookup_keeps_or_repeats_rows(spark):
    concepts = [(1, "SNOMED", "", "a"), (2, "SNOMED", "S", "b"), (3, "SNOMED", "S", "c"), (4, "SNOMED", "", "b"), (5, "SNOMED", "", "d"), (6, "LOINC", "S", "e")]
    edges = [(1, 3, "Maps to", ""), (1, 2, "Maps to", ""), (4, 3, "Maps to", ""), (1, 6, "Maps to", "")]
    vocabulary = spark.createDataFrame(concepts, CONCEPTS)
    targets = R.standard_targets(vocabulary, spark.createDataFrame(edges, EDGES))
    one = {tuple(r) for r in R.mapped_lookup(vocabulary, "SNOMED", targets).collect()}
    assert one == {("a", 2), ("b", 2), ("c", 3)}
    facts = spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "code string")
    resolved = sorted(C.resolve_code(facts, R.mapped_lookup(vocabulary, "SNOMED", targets), "code", "concept").collect(), key=str)
    assert sorted(map(str, resolved)) == sorted(str(r) for r in resolved) and {(r.code, r.concept) for r in resolved} == {("a", 2), ("b", 2), ("d", 0), (None, 0)}
    every = C.resolve_code(facts, R.mapped_lookup(vocabulary, "SNOMED", targets, every_target=True), "code", "concept").collect()
    assert {(r.code, r.concept) for r in every} == {("a", 2), ("a", 3), ("a", 6), ("b", 2), ("d", 0), (None, 0)}


def test_nothing_to_map(spark):
    assert found(spark, [], []) == set() and found(spark, [(1, "SNOMED", "", "a")], []) == set()


def test_extract(spark, tmp_path):
    file = tmp_path / "CONCEPT_RELATIONSHIP.csv"
    file.write_text("concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\tinvalid_reason\n1\t2\tMaps to\t1970\t2099\t\nx\t2\tMaps to\t\t\tD\n")
    assert [tuple(r) for r in R.read_relationships(spark, str(file)).collect()] == [(1, 2, "Maps to", "")]
