"""Every registered query against its SQL; ``--all-queries`` also compares all of them on hot keys."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from verification.compare import compare, oracle_connection
from verification.oracle import statement
from verification.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
SKEW_SENSITIVE = [
    "condition_occurrence", "measurement", "observation_period", "mutations_deid", "distinct_counts_per_patient",
    "surrogate_id_copies", "dq_relationships",
]


def pytest_generate_tests(metafunc):
    if "hot_name" in metafunc.fixturenames:
        metafunc.parametrize("hot_name", list(QUERIES) if metafunc.config.getoption("--all-queries") else SKEW_SENSITIVE)
    if "name" in metafunc.fixturenames:
        metafunc.parametrize("name", list(QUERIES))


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


def test_equals_its_sql(spark, oracle, name):
    assert compare(spark, oracle, SMALL, name) == ""


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The test tables with a third of the rows on one patient of each source, one code and one group of copies."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    line = f"'{SMALL}/lineitem.parquet'"
    changed = {
        "orders": "select * replace (cast(case o_orderkey % 3 when 0 then 3 when 1 then 4 else 5 end as bigint) "
        f"as o_custkey) from '{SMALL}/orders.parquet'",
        "lineitem": "select * replace (cast(case when l_orderkey % 3 = 0 then 77 else l_partkey end as bigint) as "
        f"l_partkey) from {line} union all select a.* from (select * from {line} order by all limit 1) a, range(3000)",
        "events": "select * replace (cast(case when event_id % 3 = 0 then 3 else user_id end as bigint) as user_id) "
        f"from '{SMALL}/events.parquet'",
    }
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        rows = changed.get(file[:-8], f"select * from '{SMALL}/{file}'")
        connection.execute(f"copy ({rows}) to '{folder}/{file}' (format parquet)")
    return folder


def test_equals_its_sql_on_hot_keys(spark, skewed, hot_name):
    assert compare(spark, oracle_connection(skewed), skewed, hot_name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_flagship(spark):
    roster = entry_points.entry(spark)
    assert roster.columns == [
        "person_id", "gender_concept_id", "year_of_birth", "distinct_conditions", "distinct_mutated_genes",
    ]
    assert roster.filter("distinct_conditions > 0").count() > 0 and roster.filter("distinct_mutated_genes > 0").count() > 0


def test_the_sql_side_states_its_rules_itself():
    """A wrong value on one side only turns the comparison red."""
    for module in ("oracle", "expected", "projection"):
        with open(f"verification/{module}.py") as file:
            assert "caremeld" not in file.read()


def test_the_data_triggers_the_rules(oracle):
    """Unknown patients, samples and variants, a shared id and the tumour codes all occur."""
    counted = {
        "orphan visits": "select * from stg_synthea_encounters where person_source_value not in (select person_source_value from person)",
        "orphan results": "select * from stg_synthea_observations where person_source_value not in (select person_source_value from person)",
        "orphan drugs": "select * from stg_synthea_medications where person_source_value not in (select person_source_value from person)",
        "samples without a person": "select * from sample_person where person_id is null",
        "variants without a sample": "select * from metabric_mutations where Tumor_Sample_Barcode not in (select sample_id from sample_person)",
        "shared ids": "select person_source_value from person group by 1 having count(*) > 1",
        "tumour codes": "select * from measurement where measurement_date is null and measurement_concept_id <> 0",
    }
    for name, sql in counted.items():
        assert oracle.execute(statement(sql)).fetchall(), name
