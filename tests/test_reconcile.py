from caremeld.plans import reconcile
from caremeld.plans.layers import ANALYTICS, CLINICAL, GENOMIC
from tests.conftest import ordered, rows


def test_persons_go_to_the_first_source_that_has_their_id(models):
    assert rows(reconcile.persons_by_source(models.raw, models.person)) == ordered(
        [("metabric", 2), ("synthea", 7), ("tcga_brca", 4)]
    )
    unknown = models.person.selectExpr("concat(person_source_value, '?') as person_source_value")
    assert rows(reconcile.persons_by_source(models.raw, unknown)) == [("UNATTRIBUTED", 13)]


def test_person_lines_report_the_shared_id(models):
    lines = rows(reconcile.person_lines(models.raw, models.person), "item", "source_count", "modeled_count", "delta")
    assert lines == ordered([("synthea", 6, 7, -1), ("metabric", 3, 2, 1), ("tcga_brca", 4, 4, 0)])


def test_mapping_counts_of_an_empty_table_are_zero(models):
    empty = {t: models.rows(t).limit(0) for t in reconcile.MAPPED}
    section = reconcile.section(empty, reconcile.MAPPING_LINES)
    assert {r[:] for r in section.select("source_count", "modeled_count", "delta").collect()} == {(0, 0, 0)}


def test_whole_report_is_ordered_and_adds_up(models):
    tables = {t: models.table(t) for t in [*CLINICAL, *GENOMIC, *ANALYTICS]}
    report = reconcile.reconciliation(models.raw, tables).collect()
    order = ["person"] * 3 + ["mapping"] * 5
    assert [r["check_group"] for r in report][:8] == order and [r["check_group"] for r in report][-3:] == ["total"] * 3
    assert [r["item"] for r in report[3:8]] == sorted(r["item"] for r in report[3:8])
    by_item = {(r["check_group"], r["item"]): r for r in report}
    assert len(report) == 21
    assert by_item["mapping", "drug_exposure"][2:5] == (2, 1, 1)
    assert by_item["deid", "mutations"][2:5] == (6, 5, 1)
    assert all(r["delta"] == 0 for r in report if r["check_group"] == "deid" and r["item"] != "mutations")
    assert by_item["ohdsi", "observation_period coverage"][2:5] == (13, 4, 9)
    assert by_item["total", "ANALYTICS.UNIQUE_PATIENTS"][2:5] == (None, 13, None)
