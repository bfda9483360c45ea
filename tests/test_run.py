import json
import os

import pytest

from caremeld.plans.layers import ANALYTICS, CLINICAL, GENOMIC
from caremeld.run import run
from caremeld.sources import variants
from caremeld.sources.landing import SOURCES, Source
from tests.conftest import AS_OF_YEAR, rows


def test_from_files_to_reports(spark, raw, vocabulary, models, tmp_path):
    for name, df in raw.items():
        source, stem = name.split("__")
        place, separator = (f"synthea/csv/{stem}.csv", ",") if source == "synthea" else (f"{source}/study/{stem}.txt", "\t")
        df.write.csv(str(tmp_path / "files" / place), sep=separator, header=True, escape='"', emptyValue="")
    extract = vocabulary.selectExpr(
        "CONCEPT_ID concept_id", "'name' concept_name", "'domain' domain_id", "VOCABULARY_ID vocabulary_id",
        "'class' concept_class_id", "STANDARD_CONCEPT standard_concept", "CONCEPT_CODE concept_code",
    )
    extract.write.csv(str(tmp_path / "extract"), sep="\t", header=True, emptyValue="")

    outcome = run(spark, str(tmp_path / "files"), [str(tmp_path / "extract")], prefix="run_", location=str(tmp_path / "db"),
                  as_of_year=AS_OF_YEAR)
    assert outcome.landed.count() == 14  # two of them are expected files that are not there
    assert rows(outcome.landed.filter("n_rows is null"), "table_name", "note") == [
        ("metabric__data_cna", "missing: not landed"), ("tcga_brca__data_cna", "missing: not landed"),
    ]
    assert spark.table("run_reports.checks").count() == 83 and outcome.checks.inputFiles()
    for name in [*CLINICAL, *GENOMIC, *ANALYTICS]:
        assert rows(outcome.tables[name].select(models.table(name).columns)) == rows(models.table(name)), name
    status = {r["check_name"]: (r["status"], r["violations"]) for r in outcome.checks.collect()}
    assert len(status) == 83
    assert status["shared_patient_ids"] == ("ERROR", 1) and status["repeated_map_keys"] == ("PASS", 0)
    assert status["cdm_coverage"] == ("PASS", 0) and status["events_outside_period"] == ("PASS", 0)
    assert status["death_before_birth"] == ("ERROR", 1)
    assert status["not_null_measurement_value_as_number"][0] == "WARN"
    assert status["not_null_sample_person_person_id"] == ("ERROR", 1)
    assert status["unique_person_person_id"] == ("PASS", 0)
    assert outcome.reconciliation.count() == 21


def zone(raw, folder, leave_out=()):
    for name, df in raw.items():
        source, stem = name.split("__")
        if name not in leave_out:
            place, separator = (f"synthea/csv/{stem}.csv", ",") if source == "synthea" else (f"{source}/study/{stem}.txt", "\t")
            df.write.csv(f"{folder}/{place}", sep=separator, header=True, escape='"', emptyValue="")
    return str(folder)


def test_a_study_without_a_mutation_file(spark, raw, tmp_path):
    """API pages stand in for the file; without pages the study has no variants, and the report says so."""
    folder = zone(raw, tmp_path / "files", ("tcga_brca__data_mutations",))
    nothing = run(spark, folder, prefix="bare_", location=str(tmp_path / "bare"), as_of_year=AS_OF_YEAR)
    notes = {r["table_name"]: (r["n_rows"], r["note"]) for r in nothing.landed.collect()}
    assert notes["tcga_brca__data_mutations"][0] == 0 and "no API pages" in notes["tcga_brca__data_mutations"][1]
    assert nothing.tables["tcga_brca_mutations"].columns == variants.MAF_COLUMNS
    assert nothing.tables["mutations_deid"].filter("source = 'tcga_brca'").count() == 0

    sample = raw["tcga_brca__data_clinical_sample"].first()["SAMPLE_ID"]
    page = [{"gene": {"hugoGeneSymbol": "TP53"}, "sampleId": sample, "chr": "17"}, {"sampleId": "NOBODY"}]
    (tmp_path / "files/tcga_brca/data_mutations.json").mkdir()
    (tmp_path / "files/tcga_brca/data_mutations.json/0.json").write_text(json.dumps(page))
    paged = run(spark, folder, prefix="paged_", location=str(tmp_path / "paged"), as_of_year=AS_OF_YEAR)
    notes = {r["table_name"]: (r["n_rows"], r["note"]) for r in paged.landed.collect()}
    assert notes["tcga_brca__data_mutations"] == (2, "from API pages")
    assert rows(paged.tables["mutations_deid"].filter("source = 'tcga_brca'"), "hugo_symbol") == [("TP53",)]


def test_sources_are_parameters_and_missing_files_stop_the_run(spark, raw, tmp_path):
    folder = zone(raw, tmp_path / "files", ("synthea__conditions",))
    with pytest.raises(FileNotFoundError, match="synthea__conditions"):
        run(spark, folder, prefix="lost_", location=str(tmp_path / "db"), as_of_year=AS_OF_YEAR)
    with pytest.raises(Exception, match="nowhere"):
        run(spark, zone(raw, tmp_path / "whole"), ["/nowhere/CONCEPT.csv"], prefix="voc_", location=str(tmp_path / "v"))
    moved = zone(raw, tmp_path / "elsewhere")
    os.rename(f"{moved}/synthea", f"{moved}/generated")
    sources = [Source("synthea", "synthetic", "generated"), *SOURCES[1:]]
    outcome = run(spark, moved, prefix="moved_", location=str(tmp_path / "moved"), as_of_year=AS_OF_YEAR, sources=sources)
    assert outcome.tables["person"].count() == 13


def test_a_second_run_lands_what_changed(spark, raw, models, tmp_path):
    """Runs over kept rows give what a run over all files gives, with a study that has no variants."""
    folder, kept = zone(raw, tmp_path / "files", ("tcga_brca__data_mutations",)), str(tmp_path / "kept")
    again = lambda n: run(spark, folder, prefix=f"kept{n}_", location=str(tmp_path / f"db{n}"), as_of_year=AS_OF_YEAR, kept=kept)
    first, second = again(1), again(2)
    assert {r.note for r in first.landed.collect()} == {"NEW"} and second.landed.count() == 0
    for name in ("person", "visit_occurrence", "observation", "metabric_mutations"):
        assert rows(second.tables[name]) == rows(first.tables[name]) != [], name
    assert rows(second.tables["visit_occurrence"].drop("visit_occurrence_id")) == rows(
        models.table("visit_occurrence").select(second.tables["visit_occurrence"].columns).drop("visit_occurrence_id")
    )
    assert second.tables["tcga_brca_mutations"].count() == 0
