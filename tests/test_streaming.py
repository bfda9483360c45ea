"""Files that arrive batch by batch give the report and the rows of one batch, however often a batch is replayed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from caremeld.operators.checks import Check, report
from caremeld.plans.quality import arrival_checks
from caremeld.plans.staging import VIEWS
from caremeld.streaming import validation as V

VIEW = "stg_synthea_encounters"
COLUMNS = ["Id", "PATIENT", "ENCOUNTERCLASS", "START", "STOP"]
PARTS = [
    [("E1", "S1", "wellness", "2010-01-01T00:00:00Z", "2010-01-02T00:00:00Z"), ("E2", "S1", "odd, \"class\"\nwith a break", "bad", "")],
    [("E1", "S1", "wellness", "2010-01-01T00:00:00Z", "2009-01-02T00:00:00Z"), ("E3", "GHOST", "odd, \"class\"\nwith a break", "2011-01-01", "")],
    [("E4", "GHOST", "strange", "2011-01-01", "2011-01-01"), ("", "S2", "inpatient", "", ""), ("E2", "S1", "inpatient", "2012-01-01", "")],
]


def arrive(folder, number, rows, columns=COLUMNS):
    os.makedirs(folder, exist_ok=True)
    quoted = lambda cell: '"' + cell.replace('"', '""') + '"'
    lines = [",".join(columns), *[",".join(map(quoted, row)) for row in rows]]
    with open(f"{folder}/.part-{number}", "w") as file:
        file.write("\n".join(lines) + "\n")
    os.rename(f"{folder}/.part-{number}", f"{folder}/part-{number}.csv")


@pytest.fixture
def feed(spark, tmp_path):
    parents = spark.createDataFrame([("S1",), ("S2",)], "person_source_value string")
    return V.Feed(VIEW, VIEWS[VIEW][1], arrival_checks()[VIEW], str(tmp_path / "feed"), {"stg_synthea_patients": parents})


def run(spark, feed, tmp_path, **options):
    stream = V.arriving(spark, str(tmp_path / "in"), COLUMNS, files_per_batch=1)
    query = V.watch(stream, feed, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


def in_one_batch(spark, feed, parts):
    whole = spark.createDataFrame([row for part in parts for row in part], ", ".join(f"{c} string" for c in COLUMNS))
    return set(report(feed.checks, {VIEW: feed.project(whole), **feed.parents}).collect()), sorted(map(tuple, whole.collect()))


def landed(spark, feed):
    return sorted(map(tuple, V.rows(spark, feed, COLUMNS).collect()))


def test_equals_one_batch(spark, feed, tmp_path):
    """Values and keys that only meet in different batches count as they do in one."""
    for n, part in enumerate(PARTS):
        arrive(tmp_path / "in", n, part)
    run(spark, feed, tmp_path)
    expected, rows = in_one_batch(spark, feed, PARTS)
    assert set(V.report(spark, feed).collect()) == expected and landed(spark, feed) == rows
    violations = {r.check_name.split(VIEW)[0] + r.column_name: r.violations for r in expected}
    assert violations["unique_visit_source_value"] == 2 and violations["accepted_values_encounter_class"] == 2
    assert violations["relationships_person_source_value"] == 2 and violations["expression_is_true_visit_end_date"] == 1
    assert {r.status for r in expected} == {"PASS", "ERROR"}


def test_reports_of_batches_know_earlier_keys(spark, feed, tmp_path):
    for n, part in enumerate(PARTS):
        arrive(tmp_path / "in", n, part)
        run(spark, feed, tmp_path)
    rows = V.batch_reports(spark, feed).where("check_name like 'unique%'").orderBy("batch").collect()
    assert [(r.batch, r.violations) for r in rows] == [(0, 0), (1, 1), (2, 1)]
    orphans = V.batch_reports(spark, feed).where("check_name like 'relationships%'").orderBy("batch").collect()
    assert [r.violations for r in orphans] == [0, 1, 1]


@pytest.mark.parametrize("broken", ["evidence", "reported"])
def test_a_replayed_batch_writes_nothing_twice(spark, feed, tmp_path, monkeypatch, broken):
    """The stream dies inside a batch, after its rows or its evidence are written, and starts again from its checkpoint."""
    for n, part in enumerate(PARTS):
        arrive(tmp_path / "in", n, part)
    whole, calls = getattr(V, broken), []

    def dies_once(*arguments):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return whole(*arguments)

    monkeypatch.setattr(V, broken, dies_once)
    with pytest.raises(Exception, match="lost"):
        run(spark, feed, tmp_path)
    assert os.path.exists(feed.place("rows", 1))
    run(spark, feed, tmp_path)
    expected, rows = in_one_batch(spark, feed, PARTS)
    assert landed(spark, feed) == rows and set(V.report(spark, feed).collect()) == expected
    assert V.batch_reports(spark, feed).groupBy("batch").count().count() == 3
    run(spark, feed, tmp_path)  # nothing new has arrived
    assert landed(spark, feed) == rows


def test_a_batch_taken_again_replaces_itself(spark, feed):
    batch = spark.createDataFrame(PARTS[0], ", ".join(f"{c} string" for c in COLUMNS))
    for _ in range(3):
        V.take(feed, batch, 0)
    assert len(landed(spark, feed)) == 2
    assert set(V.report(spark, feed).collect()) == in_one_batch(spark, feed, PARTS[:1])[0]


def test_a_broken_check_stops_the_stream_at_its_batch(spark, feed, tmp_path):
    good = [("E9", "S1", "inpatient", "2010-01-01", "2010-01-01")]
    for n, part in enumerate([good, PARTS[2], [("E8", "S1", "inpatient", "2010-01-01", "")]]):
        arrive(tmp_path / "in", n, part)
    for _ in range(2):  # a restart takes up at the same batch
        with pytest.raises(Exception, match="batch 1 of stg_synthea_encounters.*relationships"):
            run(spark, feed, tmp_path, stop=True)
        assert {r.batch for r in V.batch_reports(spark, feed).collect()} == {0, 1}


def test_warnings_do_not_stop(spark, tmp_path):
    warned = V.Feed(VIEW, VIEWS[VIEW][1], [Check(VIEW, "visit_start_date", "not_null", severity="warn")], str(tmp_path / "feed"))
    arrive(tmp_path / "in", 0, PARTS[0])
    run(spark, warned, tmp_path, stop=True)
    assert [(r.violations, r.status) for r in V.report(spark, warned).collect()] == [(1, "WARN")]


def test_another_header_fails(spark, feed, tmp_path):
    arrive(tmp_path / "in", 0, PARTS[0], ["Id", "PATIENT", "START", "ENCOUNTERCLASS", "STOP"])
    with pytest.raises(Exception, match="(?i)header"):
        run(spark, feed, tmp_path)


def test_nothing_has_arrived(spark, feed):
    assert {r.violations for r in V.report(spark, feed).collect()} == {0} and landed(spark, feed) == []


def test_every_kind_of_check_is_declared_for_arrivals():
    kinds = {c.kind for checks in arrival_checks().values() for c in checks}
    assert kinds == {"not_null", "unique", "accepted_values", "relationships", "expression_is_true", "between"}
    assert any(c.where for checks in arrival_checks().values() for c in checks)
    assert {c.severity for checks in arrival_checks().values() for c in checks} == {"error", "warn"}


def test_evidence_is_reduced_before_it_is_shuffled(spark, feed):
    staged = feed.project(spark.createDataFrame(PARTS[0], ", ".join(f"{c} string" for c in COLUMNS)))
    plan = V.evidence(feed.checks, staged)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_counts_add_up_on_hot_keys(spark, tmp_path, feed):
    """A third of the rows share one key, and come in every batch."""
    parts = [spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit(f"{n}-"), F.col("id"))).alias("Id"),
        F.when(F.col("id") % 3 == 0, "GHOST").otherwise("S1").alias("PATIENT"), F.lit("inpatient").alias("ENCOUNTERCLASS"),
        F.lit("2010-01-01").alias("START"), F.lit("").alias("STOP")) for n in range(3)]
    for n, part in enumerate(parts):
        V.take(feed, part, n)
    violations = {r.check_name: r.violations for r in V.report(spark, feed).collect()}
    assert violations[f"unique_{VIEW}_visit_source_value"] == 1
    assert violations[f"relationships_{VIEW}_person_source_value_stg_synthea_patients"] == 300
