import datetime as dt

from caremeld.operators import concepts as C
from caremeld.plans import clinical, genomic
from caremeld.plans.layers import Layers
from caremeld.sources import landing, seeds
from tests.conftest import AS_OF_YEAR, ordered, rows


def day(text):
    return dt.date.fromisoformat(text)


def person_id(models):
    return {(r["person_source_value"], r["gender_source_value"]): r["person_id"] for r in models.person.collect()}


def test_person(models):
    columns = ["person_source_value", "gender_concept_id", "year_of_birth", "race_concept_id", "ethnicity_concept_id"]
    assert rows(models.person, *columns) == ordered([
        ("MB1", 8532, None, 0, 0),
        ("MB2", 8532, None, 0, 0),
        ("S1", 8532, 1950, 8527, 38003564),
        ("S2", 8507, None, 0, 38003563),
        ("S3", 0, None, 0, 0),
        ("S4", 0, None, 8516, 38003563),
        ("S5", 8532, 1990, 8515, 38003564),
        ("T1", 8532, None, 0, 0),
        ("T2", 8507, None, 0, 0),
        ("T3", 8532, None, 0, 0),
        ("T4", 0, None, 0, 0),
        ("TWIN", 8532, None, 0, 0),
        ("TWIN", 8507, 1934, 8527, 38003564),
    ])
    ids = models.person.orderBy("person_id").collect()
    assert [r["person_id"] for r in ids] == list(range(1, 14))
    assert [r["person_source_value"] for r in ids] == sorted(r["person_source_value"] for r in ids)


def test_visits_map_classes_drop_unknown_patients_and_show_shared_ids_twice(models):
    visits = models.table("visit_occurrence")
    assert rows(visits, "visit_occurrence_id", "visit_concept_id", "visit_source_value", "visit_start_date") == ordered([
        (1, 9202, "Wellness", day("2010-01-01")),
        (2, 0, "urgentcare", day("2011-01-01")),
        (3, 9203, "emergency", day("2015-01-01")),
        (4, 9203, "emergency", day("2015-01-01")),
        (5, 9201, "INPATIENT", None),
    ])
    twins = {v for (name, _), v in person_id(models).items() if name == "TWIN"}
    assert {r["person_id"] for r in visits.filter("visit_concept_id = 9203").collect()} == twins


def test_conditions(models):
    assert rows(models.rows("condition_occurrence"), "condition_source_value", "condition_concept_id", "condition_start_date",
                "snomed_code") == ordered([
        ("Breast", 4112853, None, None),
        ("Breast Invasive Ductal Carcinoma", 4237178, None, None),
        ("Breast Invasive Lobular Carcinoma", 4080865, None, None),
        ("Unlisted", 0, None, None),
        ("not standard", 0, None, "200"),
        ("standard", 1001, day("2009-12-31"), "100"),
        ("unknown", 0, day("2010-01-01"), "999"),
    ])
    numbered = models.table("condition_occurrence").orderBy("condition_occurrence_id").collect()
    assert [r["condition_start_date"] for r in numbered][:2] == [day("2009-12-31"), day("2010-01-01")]
    assert [r["condition_occurrence_id"] for r in numbered] == list(range(1, 8))


def test_drugs_and_procedures_need_a_standard_concept(models):
    assert rows(models.table("drug_exposure"), "drug_source_value", "drug_concept_id", "quantity", "drug_exposure_end_date") == ordered([
        ("not standard", 0, None, day("2014-01-01")),
        ("standard", 3001, 3.5, None),
    ])
    assert rows(models.table("procedure_occurrence"), "procedure_source_value", "procedure_concept_id", "procedure_date") == ordered([
        ("not standard", 0, None),
        ("standard", 1001, day("2010-06-01")),
    ])


def test_measurements(models):
    columns = ["measurement_source_value", "measurement_concept_id", "value_as_number", "value_as_concept_id",
               "value_source_value", "unit_source_value", "unit_concept_id"]
    assert rows(models.table("measurement"), *columns) == ordered([
        ("ER status", 5001, None, 9191, "Positive", None, None),
        ("HER2 status", 0, None, None, "NA", None, None),
        ("Histologic grade", 0, None, None, "NA", None, None),
        ("Histologic grade", 0, 2.0, 1242374, "2", None, None),
        ("PR status", 0, None, 9189, "Negative", None, None),
        ("Tumor size", 0, 26.2, None, None, "mm", 8588),
        ("no code", 0, None, None, None, "", None),
        ("not standard", 4001, 1.5, None, None, "mg", None),
    ])


def test_observations(models):
    columns = ["observation_source_value", "observation_concept_id", "value_as_number", "value_as_concept_id",
               "value_source_value", "unit_concept_id", "observation_date"]
    found = rows(models.table("observation"), *columns)
    assert ("AJCC stage", 4221515, None, 1635381, "STAGE IIA", None, None) in found
    assert ("AJCC stage", 4221515, None, None, "STAGE X", None, None) in found
    assert ("Age at diagnosis", 3022304, 45.25, None, None, None, None) in found
    assert ("Survival time", 40482950, 100.5, None, None, 9580, None) in found
    assert ("Tumor stage", 4219603, 2.0, 1635131, "2", None, None) in found
    assert ("Vital status", 3009506, None, 4230556, "Living", None, None) in found
    # MB1 has four, both people called TWIN have three each, and three of the other study have a stage.
    assert len(found) == 4 + 6 + 3
    ordered = models.table("observation").join(models.person, "person_id").orderBy("observation_id").collect()
    assert [r["person_source_value"] for r in ordered] == sorted(r["person_source_value"] for r in ordered)


def test_death(models):
    found = models.table("death").join(models.person, "person_id")
    assert rows(found, "person_source_value", "death_date", "death_type_concept_id") == ordered([
        ("S2", day("2001-01-01"), 32817),
        ("S5", day("1980-01-01"), 32817),
    ])


def test_periods_span_all_dated_events_and_skip_the_dateless(models):
    found = models.table("observation_period").join(models.person, "person_id")
    assert rows(found, "person_source_value", "observation_period_start_date", "observation_period_end_date") == ordered([
        ("S1", day("2009-12-31"), day("2020-01-01")),
        ("S2", day("2010-01-01"), day("2014-01-01")),
        ("TWIN", day("2015-01-01"), day("2015-01-01")),
        ("TWIN", day("2015-01-01"), day("2015-01-01")),
    ])


def test_crosswalk_keeps_samples_of_unknown_patients(models):
    crosswalk = models.table("sample_person")
    assert rows(crosswalk, "source", "sample_id", "patient_id") == ordered([
        ("metabric", "LOST-1", "LOST"),
        ("metabric", "MB1", "MB1"),
        ("metabric", "MB2", "MB2"),
        ("tcga_brca", "T1-01", "T1"),
        ("tcga_brca", "T2-01", "T2"),
    ])
    assert rows(crosswalk.filter("person_id is null"), "sample_id") == [("LOST-1",)]


def test_mutations_lose_barcodes_and_unlinked_calls(models):
    found = models.table("mutations_deid")
    assert not {c for c in found.columns if "barcode" in c.lower() or "sample" in c.lower()}
    assert rows(found, "source", "hugo_symbol") == ordered([
        ("metabric", "TP53"),
        ("metabric", "TP53"),
        ("tcga_brca", "GATA3"),
        ("tcga_brca", "PIK3CA"),
        ("tcga_brca", "TP53"),
    ])


def test_raw_mutations_pass_through(raw):
    assert genomic.raw_mutations(raw["metabric__data_mutations"]) is raw["metabric__data_mutations"]


def test_roster_counts_are_distinct_and_zero_without_facts(models):
    found = models.table("unique_patients").join(models.person.select("person_id", "person_source_value"), "person_id")
    counts = {r[0]: (r[1], r[2]) for r in rows(found, "person_source_value", "distinct_conditions", "distinct_mutated_genes")}
    assert counts["MB1"] == (1, 1) and counts["T1"] == (1, 2) and counts["S1"] == (2, 0) and counts["S3"] == (0, 0)
    assert found.count() == models.person.count()


def test_old_ages_are_one_group(spark, models):
    from caremeld.plans.deid import person_deid

    born = {89: AS_OF_YEAR - 89, 90: AS_OF_YEAR - 90, 120: AS_OF_YEAR - 120}
    people = spark.createDataFrame(
        [(i, 0, y, 0, 0) for i, y in enumerate([*born.values(), None])],
        "person_id long, gender_concept_id long, year_of_birth long, race_concept_id long, ethnicity_concept_id long",
    )
    floor = AS_OF_YEAR - 90
    assert [r["year_of_birth"] for r in person_deid(people, AS_OF_YEAR).orderBy("person_id").collect()] == [
        AS_OF_YEAR - 89, floor, floor, None,
    ]
    by_clock = person_deid(people).orderBy("person_id").collect()
    assert by_clock[2]["year_of_birth"] == dt.date.today().year - 90


def test_without_a_vocabulary_every_code_is_zero(spark, raw):
    bare = Layers(raw, landing.empty_vocabulary(spark), seeds.concept_map(spark), AS_OF_YEAR)
    assert {r[0] for r in rows(bare.rows("drug_exposure"), "drug_concept_id")} == {0}
    assert {r[0] for r in rows(bare.rows("measurement"), "measurement_concept_id")} == {0}


def test_only_signed_off_rows_resolve(spark, raw):
    concept_map = seeds.concept_map(spark)
    extra = [("metabric", "data_clinical_sample.CANCER_TYPE_DETAILED", "Unlisted", "condition_occurrence",
              "condition_concept_id", None, None, None, 77, status, None) for status in ("REVIEW", "NOT_MAPPED")]
    undecided = concept_map.unionByName(spark.createDataFrame(extra, concept_map.schema))
    assert rows(C.histology_values(undecided).filter("source_value = 'Unlisted'")) == []
    signed = concept_map.unionByName(spark.createDataFrame([(*extra[0][:9], "STANDARD", None)], concept_map.schema))
    assert rows(C.histology_values(signed).filter("source_value = 'Unlisted'"), "concept_id") == [(77,)]


def test_a_code_listed_twice_shows_twice(spark, vocabulary):
    facts = spark.createDataFrame([("100",), (None,)], "code string")
    doubled = vocabulary.unionByName(vocabulary.filter("CONCEPT_ID = 1001"))
    found = C.resolve_code(facts.withColumnRenamed("code", "c"), C.code_lookup(doubled, "SNOMED"), "c", "concept")
    assert rows(found, "c", "concept") == [(None, 0), ("100", 1001), ("100", 1001)]


def test_event_span_ignores_keys_without_dates(spark):
    stream = spark.createDataFrame([("a", None, None), ("b", day("2020-01-01"), None)], "k string, x date, y date")
    assert rows(clinical.event_span([stream], "k")) == [("b", day("2020-01-01"), None)]
