"""What the plans must and must not contain, and that hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from caremeld.operators.lookups import broadcast_if_small, measured_bytes
from caremeld.plans import clinical, deid
from caremeld.plans.layers import Layers, build
from caremeld.sources import seeds
from tests.conftest import AS_OF_YEAR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df):
    return df._jdf.queryExecution().analyzed().toString()


def run(df):
    """Runs a query without keeping its rows and returns the plan that adaptive execution ended with."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


FACTS = ["visit_occurrence", "condition_occurrence", "drug_exposure", "procedure_occurrence", "measurement", "observation"]


@pytest.mark.parametrize("fact", FACTS)
def test_facts_are_joined_by_equality_and_never_gathered(models, fact):
    text = plan(models.rows(fact))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SinglePartition" not in text


def test_a_small_lookup_is_broadcast_and_a_large_one_is_not(spark):
    lookup = spark.range(1000).select(F.col("id"), F.col("id").cast("string").alias("code"))
    assert 32_000 < measured_bytes(lookup) < 64_000
    facts = spark.range(10).selectExpr("cast(id as string) as code")
    assert "ResolvedHint (strategy=broadcast)" in logical(facts.join(broadcast_if_small(lookup), "code"))
    assert "ResolvedHint" not in logical(facts.join(broadcast_if_small(lookup, 32_000), "code"))
    assert measured_bytes(lookup.limit(0)) == 0


def test_facts_that_meet_small_lookups_are_not_shuffled(models):
    for fact in ("drug_exposure", "visit_occurrence", "procedure_occurrence"):
        assert "Exchange hashpartitioning" not in plan(models.rows(fact))


def test_roster_counts_before_it_joins(models):
    text = plan(models.table("unique_patients"))
    assert "NestedLoop" not in text and "Expand" not in text


def test_roster_reads_only_de_identified_tables(spark, raw, vocabulary, tmp_path):
    own = Layers(raw, vocabulary, seeds.concept_map(spark), AS_OF_YEAR)
    written = build(own, "roster_", str(tmp_path))
    again = own._model("unique_patients")
    folders = {file.rsplit("/", 2)[-2] for file in again.inputFiles()}
    assert folders == {"person_deid", "condition_occurrence_deid", "mutations_deid"}
    assert again.exceptAll(written["unique_patients"]).isEmpty()


def test_periods_are_built_from_the_written_facts(spark, raw, vocabulary, models, tmp_path):
    own = Layers(raw, vocabulary, seeds.concept_map(spark), AS_OF_YEAR)
    written = build(own, "period_", str(tmp_path))
    folders = {file.rsplit("/", 2)[-2] for file in own.rows("observation_period").inputFiles()}
    assert folders == set(clinical.DATED_FACTS)
    assert written["observation_period"].exceptAll(models.table("observation_period")).isEmpty()


@pytest.fixture
def landed(spark, raw, vocabulary, tmp_path):
    """The same raw tables as parquet, as landing leaves them."""
    stored = {}
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    return Layers(stored, vocabulary, seeds.concept_map(spark), AS_OF_YEAR)


def test_scans_read_only_what_a_model_needs(landed):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(landed.rows("observation_period")))
    observed = [r for r in read if "TYPE" in r]
    assert observed and all("VALUE" not in r and "DESCRIPTION" not in r for r in observed)
    numeric = plan(landed.staging("stg_synthea_observations"))
    assert "EqualTo(TYPE,numeric)" in numeric
    calls = [r for r in re.findall(r"ReadSchema: struct<([^>]*)>", plan(landed.table("mutations_deid"))) if "Hugo" in r]
    assert calls and all("Matched_Norm" not in r for r in calls)


def test_spans_reduce_before_the_only_shuffle_of_the_facts(landed):
    text = plan(landed.rows("observation_period"))
    assert text.index("Union") > text.index("partial_min")


@pytest.fixture
def sort_merge(spark):
    """No broadcasts, and thresholds low enough for small data to count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows=60_000):
    """Facts of 300 patients; one of them has a third."""
    return spark.range(0, rows, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 300)).alias("person_source_value"),
        F.col("id").cast("string").alias("CODE"),
        F.concat(F.lit("long description "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
    )


def test_a_patient_with_a_third_of_the_facts_is_split(spark, sort_merge):
    people = spark.range(300).select(
        F.col("id").alias("person_id"), F.concat(F.lit("P"), F.col("id")).alias("person_source_value")
    )
    joined = clinical.with_person(hot(spark), people)
    assert "skew=true" in run(joined.select("person_id", "CODE", "text"))
    assert joined.count() == 60_000


def test_a_sample_with_a_third_of_the_variants_is_split(spark, sort_merge):
    calls = hot(spark).select(
        F.col("person_source_value").alias("Tumor_Sample_Barcode"),
        *[F.col("text").alias(raw) for raw in deid.VARIANT_COLUMNS.values()],
    )
    crosswalk = spark.range(300).select(
        F.lit("metabric").alias("source"), F.concat(F.lit("P"), F.col("id")).alias("sample_id"), F.col("id").alias("person_id")
    )
    found = deid.mutations_deid(calls, calls.limit(0), crosswalk)
    assert "skew=true" in run(found)


def test_results_do_not_depend_on_the_join_strategy(models, raw, vocabulary, spark, sort_merge):
    again = Layers(raw, vocabulary, seeds.concept_map(spark), AS_OF_YEAR, broadcast_bytes=0)
    for fact in FACTS:
        ours, theirs = again.rows(fact), models.rows(fact)
        assert "BroadcastHashJoin" not in plan(ours)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
