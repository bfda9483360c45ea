import datetime as dt

import pytest

from caremeld.operators import checks
from caremeld.operators.checks import Check
from caremeld.plans import quality
from caremeld.plans.layers import CLINICAL
from caremeld.sources import seeds
from tests.conftest import AS_OF_YEAR, ordered, rows


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [(1, "a", 10, 20), (2, "a", 30, 20), (3, "b", None, 20), (None, None, 5, None)], "id long, kind string, lo long, hi long"
    )


@pytest.fixture(scope="module")
def parents(spark):
    return spark.createDataFrame([(1,), (2,)], "pid long")


def test_not_null(facts):
    assert rows(checks.not_null(facts, "lo"), "id") == [(3,)]
    assert checks.not_null(facts.filter("id is not null"), "id").isEmpty()


def test_unique_ignores_null(facts):
    assert rows(checks.unique(facts, "kind")) == [("a", 2)]
    assert checks.unique(facts, "id").isEmpty()


def test_accepted_values_pass_null(facts):
    assert rows(checks.accepted_values(facts, "kind", ["a"])) == [("b", 1)]
    assert checks.accepted_values(facts, "kind", ["a", "b"]).isEmpty()


def test_relationships(facts, parents):
    assert rows(checks.relationships(facts, "id", parents, "pid"), "id") == [(3,)]
    assert checks.relationships(facts.filter("id < 3"), "id", parents, "pid").isEmpty()


def test_expression_passes_unknown_outcomes(facts):
    assert rows(checks.expression_is_true(facts, "lo <= hi"), "id") == [(2,)]
    assert checks.expression_is_true(facts, "hi = 20").isEmpty()


def test_between_with_a_row_condition(facts):
    assert rows(checks.between(facts, "lo", 10, 20), "id") == ordered([(None,), (2,)])
    assert rows(checks.between(facts, "lo", 10, 20, "id is not null"), "id") == [(2,)]
    assert checks.between(facts, "lo", 5, 30).isEmpty()


def test_report_agrees_with_the_offending_rows(facts, parents):
    tables = {"facts": facts, "parents": parents}
    link = {"parent": "parents", "parent_column": "pid"}
    declared = [
        Check("facts", "lo", "not_null", "completeness", "warn", "kind = 'b'"),
        Check("facts", "id", "not_null"),
        Check("facts", "kind", "unique"),
        Check("facts", "kind", "accepted_values", arguments={"values": ["a"]}),
        Check("facts", "id", "relationships", arguments=link),
        Check("facts", "lo", "expression_is_true", arguments={"expression": "<= hi"}),
        Check("facts", "lo", "between", "plausibility", arguments={"low": 0, "high": 99}),
    ]
    extra = {"seeded": ("facts", "plausibility", facts.filter("id = 1"))}
    found = {r["check_name"]: r for r in checks.report(declared, tables, extra).collect()}
    assert len(found) == len(declared) + 1
    for check in declared:
        assert found[check.name]["violations"] == check.violations(tables).count()
    assert found["not_null_facts_lo"]["status"] == "WARN"
    assert found["unique_facts_kind"]["status"] == "ERROR"
    assert found["between_facts_lo"]["status"] == "PASS"
    assert found["seeded"]["violations"] == 1 and found["seeded"]["column_name"] is None


def test_orphan_rows_are_counted_not_orphan_keys(spark, parents):
    child = spark.createDataFrame([(9,)] * 5 + [(1,)], "id long")
    link = Check("child", "id", "relationships", arguments={"parent": "p", "parent_column": "pid"})
    assert checks.report([link], {"child": child, "p": parents}).first()["violations"] == 5


def test_unknown_kind(facts):
    with pytest.raises(ValueError):
        Check("facts", "id", "nonsense").violations({"facts": facts})


def test_declared_checks_by_kind():
    kinds = [c.kind for c in quality.declared_checks(AS_OF_YEAR)]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 33, "relationships": 16, "unique": 13, "accepted_values": 9, "expression_is_true": 4, "between": 3,
    }


def test_death_before_birth_fires_and_passes(models):
    found = quality.death_before_birth(models.table("death"), models.person)
    assert rows(found, "death_date", "birth_datetime") == [(dt.date(1980, 1, 1), dt.date(1990, 2, 3))]
    fine = models.table("death").filter("death_date > '1990-01-01'")
    assert quality.death_before_birth(fine, models.person).isEmpty()


def test_events_outside_their_period(models):
    names = ("condition_occurrence", "visit_occurrence", "drug_exposure", "procedure_occurrence")
    events = quality.dated_events(*[models.rows(t) for t in names])
    periods = models.rows("observation_period")
    assert quality.events_outside_period(events, periods).isEmpty()
    short = periods.selectExpr(
        "person_id", "observation_period_start_date", "observation_period_start_date as observation_period_end_date"
    )
    outside = quality.events_outside_period(events, short)
    assert {r["src"] for r in outside.collect()} == {"visit", "drug", "procedure"}


def test_coverage_gate_finds_each_kind_of_absence(spark):
    spec, scope = seeds.cdm_spec(spark), seeds.cdm_scope(spark)
    all_built = spark.createDataFrame([(t.upper(),) for t in CLINICAL], "table_name string")
    assert quality.cdm_coverage(spec, scope, all_built).isEmpty()

    absent = all_built.filter("table_name <> 'DEATH'")
    assert rows(quality.cdm_coverage(spec, scope, absent), "cdm_table_name", "violation") == [("death", "NOT_MATERIALIZED")]

    undecided = scope.filter("cdm_table_name <> 'cost'")
    assert rows(quality.cdm_coverage(spec, undecided, all_built), "cdm_table_name", "violation") == [("cost", "UNDECLARED")]

    declined = scope.filter("cdm_table_name <> 'observation_period'").unionByName(
        spark.createDataFrame([("observation_period", "out_of_scope", "declined")], scope.schema)
    )
    assert rows(quality.cdm_coverage(spec, declined, all_built), "cdm_table_name", "violation") == [
        ("observation_period", "MISSING_REQUIRED")
    ]


def test_dates_are_found_in_the_schema(models):
    clean = {"person_deid": models.table("person_deid"), "mutations_deid": models.table("mutations_deid")}
    assert quality.date_columns("analytics", clean).isEmpty()
    assert rows(quality.date_columns("omop", {"death": models.table("death")})) == [("omop", "death", "death_date", "date", 2)]


def test_seeds_pass_their_own_checks(spark):
    tables = {
        "concept_map": seeds.concept_map(spark),
        "cdm_v54_tables": seeds.cdm_spec(spark),
        "cdm_scope": seeds.cdm_scope(spark),
    }
    assert {r["status"] for r in checks.report(quality.seed_checks(), tables).collect()} == {"PASS"}
    assert tables["concept_map"].filter("source_code = 'mm'").count() == 1


def test_map_keys_with_nulls_and_bars_are_told_apart(spark):
    own = seeds.concept_map(spark)
    schema = own.schema
    odd = [("s", None, "f", "t", "o"), ("s", "f", None, "t", "o"), ("s|f", "v", "w", "t", "o"), ("s", "f|v", "w", "t", "o")]
    added = spark.createDataFrame([(*key, None, None, None, None, "REVIEW", None) for key in odd], schema)
    assert checks.unique(own.unionByName(added), *quality.MAP_KEY).isEmpty()
    twice = checks.unique(own.unionByName(added).unionByName(added.limit(1)), *quality.MAP_KEY)
    assert twice.count() == 1 and twice.first()["n_records"] == 2
