"""The nine clinical tables.

``*_rows`` functions give a table without its surrogate id; consumers that do not need the id (counts, spans, the
roster) read those and skip the sort that numbering takes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.functions.casts import year_of
from caremeld.operators import concepts as C
from caremeld.operators.surrogate import assign_surrogate_id
from caremeld.operators.unpivot import clinical_observations, tumour_measurements

EHR_TYPE = 32817  # Fixed value: record type "EHR".


def _null(kind: str):
    return F.lit(None).cast(kind)


def with_person(facts: DataFrame, person: DataFrame) -> DataFrame:
    """Facts of known patients, with ``person_id``; facts of unknown patients are dropped.

    Patients are matched on their source id alone, so an id that two sources share yields a row for each person.
    ``person`` may be the whole table or just the two key columns, marked for broadcast or not.
    """
    return facts.join(person_keys(person), "person_source_value")


def person_keys(person: DataFrame) -> DataFrame:
    keys = ["person_id", "person_source_value"]
    return person if person.columns == keys else person.select(keys)


def person_rows(
    synthea_patients: DataFrame, metabric_patient: DataFrame, tcga_patient: DataFrame, concept_map: DataFrame
) -> DataFrame:
    common = ["person_source_value", "gender_source_value"]
    everyone = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            synthea_patients.select(*common, "race_source_value", "ethnicity_source_value", "birth_date"),
            metabric_patient.select(*common),
            tcga_patient.select(*common),
        ],
    )
    for column, lookup, concept in [
        ("gender_source_value", C.gender_values(concept_map), "gender_concept_id"),
        ("race_source_value", C.field_values(concept_map, "patients.RACE"), "race_concept_id"),
        ("ethnicity_source_value", C.field_values(concept_map, "patients.ETHNICITY"), "ethnicity_concept_id"),
    ]:
        everyone = C.resolve_value(everyone, lookup, {column: "source_value"}, concept, default=0)
    return everyone.select(
        "gender_concept_id",
        year_of("birth_date").alias("year_of_birth"),
        F.col("birth_date").alias("birth_datetime"),
        "race_concept_id",
        "ethnicity_concept_id",
        "person_source_value",
        "gender_source_value",
    )


def person(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "person_id", ["person_source_value"])


def visit_rows(encounters: DataFrame, person: DataFrame) -> DataFrame:
    return with_person(encounters, person).select(
        "person_id",
        C.visit_concept("encounter_class").alias("visit_concept_id"),
        "visit_start_date",
        "visit_end_date",
        F.col("encounter_class").alias("visit_source_value"),
    )


def visit_occurrence(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "visit_occurrence_id", ["visit_start_date", "person_id"])


def condition_rows(
    conditions: DataFrame,
    metabric_sample: DataFrame,
    tcga_sample: DataFrame,
    person: DataFrame,
    snomed: DataFrame,
    concept_map: DataFrame,
) -> DataFrame:
    """Coded events of the synthetic patients and one undated diagnosis per sample of the two studies."""
    coded = C.resolve_code(conditions, snomed, "snomed_code", "condition_concept_id")
    columns = ["person_source_value", "cancer_type_detailed"]
    diagnoses = C.resolve_value(
        metabric_sample.select(F.lit("metabric").alias("source"), *columns).unionByName(
            tcga_sample.select(F.lit("tcga_brca").alias("source"), *columns)
        ),
        C.histology_values(concept_map),
        {"source": "source", "cancer_type_detailed": "source_value"},
        "condition_concept_id",
        default=0,
    ).select(
        "person_source_value",
        "condition_concept_id",
        _null("date").alias("condition_start_date"),
        F.col("cancer_type_detailed").alias("condition_source_value"),
        _null("string").alias("snomed_code"),
    )
    return with_person(coded.unionByName(diagnoses), person).select(
        "person_id", "condition_concept_id", "condition_start_date", "condition_source_value", "snomed_code"
    )


def condition_occurrence(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "condition_occurrence_id", ["condition_start_date", "person_id"])


def drug_rows(medications: DataFrame, person: DataFrame, rxnorm: DataFrame) -> DataFrame:
    known = with_person(medications, person)
    return C.resolve_code(known, rxnorm, "rxnorm_code", "drug_concept_id").select(
        "person_id",
        "drug_concept_id",
        "drug_exposure_start_date",
        "drug_exposure_end_date",
        F.col("dispenses").alias("quantity"),
        "drug_source_value",
        "rxnorm_code",
    )


def drug_exposure(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "drug_exposure_id", ["drug_exposure_start_date", "person_id"])


def procedure_rows(procedures: DataFrame, person: DataFrame, snomed: DataFrame) -> DataFrame:
    known = with_person(procedures, person)
    return C.resolve_code(known, snomed, "snomed_code", "procedure_concept_id").select(
        "person_id", "procedure_concept_id", "procedure_date", "procedure_source_value", "snomed_code"
    )


def procedure_occurrence(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "procedure_occurrence_id", ["procedure_date", "person_id"])


def tumour_results(metabric_sample: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Unpivoted tumour attributes with the concept of a coded answer and of the unit (NULL where there is none)."""
    answers = C.answer_values(concept_map, "measurement").filter(F.col("source") == "metabric")
    coded = C.resolve_value(
        tumour_measurements(metabric_sample),
        answers,
        {"source_field": "source_field", "value_txt": "source_value"},
        "value_as_concept_id",
    )
    return C.resolve_value(coded, C.unit_codes(concept_map), {"unit": "source_code"}, "unit_concept_id")


def measurement_rows(
    observations: DataFrame,
    metabric_sample: DataFrame,
    person: DataFrame,
    loinc: DataFrame,
    concept_map: DataFrame,
) -> DataFrame:
    """Numeric results of the synthetic patients and the tumour attributes of one study, numbered by LOINC code.

    The two branches share one join to the people and one to the codes, which need not be standard here.
    """
    dated = observations.select(
        "person_source_value",
        "loinc_code",
        "measurement_date",
        "value_as_number",
        _null("long").alias("value_as_concept_id"),
        _null("string").alias("value_source_value"),
        "unit_source_value",
        _null("long").alias("unit_concept_id"),
        "measurement_source_value",
    )
    tumour = tumour_results(metabric_sample, concept_map).select(
        "person_source_value",
        "loinc_code",
        _null("date").alias("measurement_date"),
        F.col("value_num").alias("value_as_number"),
        "value_as_concept_id",
        F.col("value_txt").alias("value_source_value"),
        F.col("unit").alias("unit_source_value"),
        "unit_concept_id",
        F.col("label").alias("measurement_source_value"),
    )
    known = with_person(dated.unionByName(tumour), person)
    return C.resolve_code(known, loinc, "loinc_code", "measurement_concept_id").select(
        "person_id",
        "measurement_concept_id",
        "measurement_date",
        "value_as_number",
        "value_as_concept_id",
        "value_source_value",
        "unit_source_value",
        "unit_concept_id",
        "measurement_source_value",
    )


def measurement(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "measurement_id", ["measurement_date", "person_id"])


def observation_rows(
    metabric_patient: DataFrame,
    metabric_sample: DataFrame,
    tcga_patient: DataFrame,
    person: DataFrame,
    concept_map: DataFrame,
) -> DataFrame:
    """Also carries ``person_source_value``, which the numbering orders by."""
    rows = clinical_observations(metabric_patient, metabric_sample, tcga_patient)
    by_field = {"source": "source", "source_field": "source_field"}
    rows = C.resolve_value(rows, C.observed_fields(concept_map), by_field, "observation_concept_id", default=0)
    rows = C.resolve_value(rows, C.observation_units(concept_map), by_field, "unit_concept_id")
    rows = C.resolve_value(
        rows,
        C.answer_values(concept_map, "observation"),
        {**by_field, "value_txt": "source_value"},
        "value_as_concept_id",
    )
    return with_person(rows, person).select(
        "person_id",
        "observation_concept_id",
        _null("date").alias("observation_date"),
        F.col("value_num").alias("value_as_number"),
        "value_as_concept_id",
        F.col("value_txt").alias("value_source_value"),
        "unit_concept_id",
        F.col("label").alias("observation_source_value"),
        "person_source_value",
    )


def observation(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(
        rows, "observation_id", ["person_source_value", "person_id"], drop=("person_source_value",)
    )


def death(synthea_patients: DataFrame, person: DataFrame) -> DataFrame:
    dead = synthea_patients.filter(F.col("death_date").isNotNull())
    return with_person(dead, person).select(
        "person_id", "death_date", F.lit(EHR_TYPE).cast("long").alias("death_type_concept_id")
    )


def event_span(streams: list[DataFrame], key: str) -> DataFrame:
    """First and last date per key over several (key, first, last) streams; keys without any date have no row.

    One aggregation over the union: every task reduces its rows to one per key before the only shuffle, so a key that
    holds most of the events costs no more than any other.
    """
    events = reduce(DataFrame.unionByName, [s.toDF(key, "_first", "_last") for s in streams])
    spans = events.groupBy(key).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    return spans.filter(F.col("_first").isNotNull()).select(
        key, F.col("_first").alias("first_date"), F.col("_last").alias("last_date")
    )


def observation_period_rows(
    encounters: DataFrame,
    conditions: DataFrame,
    observations: DataFrame,
    medications: DataFrame,
    procedures: DataFrame,
    person: DataFrame,
) -> DataFrame:
    """One period per person over all dated events (the undated study facts cannot contribute).

    Dates are reduced per source id before the people are joined, so no fact is joined at all.
    """
    key = "person_source_value"

    def stream(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
        # least and greatest skip NULLs, so a row with one of its two dates still counts.
        dates = [start, end or start]
        return df.select(key, F.least(*dates).alias("first"), F.greatest(*dates).alias("last"))

    spans = event_span(
        [
            stream(encounters, "visit_start_date", "visit_end_date"),
            stream(conditions, "condition_start_date"),
            stream(observations, "measurement_date"),
            stream(medications, "drug_exposure_start_date", "drug_exposure_end_date"),
            stream(procedures, "procedure_date"),
        ],
        key,
    )
    return with_person(spans, person).select(
        "person_id",
        F.col("first_date").alias("observation_period_start_date"),
        F.col("last_date").alias("observation_period_end_date"),
        F.lit(EHR_TYPE).cast("long").alias("period_type_concept_id"),
    )


# Facts with dates: table -> first and last date of a row.
DATED_FACTS = {
    "visit_occurrence": ("visit_start_date", "visit_end_date"),
    "condition_occurrence": ("condition_start_date", "condition_start_date"),
    "measurement": ("measurement_date", "measurement_date"),
    "drug_exposure": ("drug_exposure_start_date", "drug_exposure_end_date"),
    "procedure_occurrence": ("procedure_date", "procedure_date"),
}


def observation_period_of(facts: dict[str, DataFrame]) -> DataFrame:
    """The same periods from fact tables that carry the person, as they were written."""
    spans = event_span(
        [
            facts[table].select("person_id", F.least(*dates), F.greatest(*dates))
            for table, dates in DATED_FACTS.items()
        ],
        "person_id",
    )
    return spans.select(
        "person_id",
        F.col("first_date").alias("observation_period_start_date"),
        F.col("last_date").alias("observation_period_end_date"),
        F.lit(EHR_TYPE).cast("long").alias("period_type_concept_id"),
    )


def observation_period(rows: DataFrame) -> DataFrame:
    return assign_surrogate_id(rows, "observation_period_id", ["person_id"])
