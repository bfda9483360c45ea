"""Typed, renamed views over the raw all-string tables; the only place that knows the clinical raw column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.functions.casts import date_or_null, number_or_null


def synthea_patients(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Id").alias("person_source_value"),
        F.col("GENDER").alias("gender_source_value"),
        F.lower("RACE").alias("race_source_value"),
        F.lower("ETHNICITY").alias("ethnicity_source_value"),
        date_or_null("BIRTHDATE").alias("birth_date"),
        date_or_null("DEATHDATE").alias("death_date"),
    )


def synthea_conditions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("PATIENT").alias("person_source_value"),
        F.col("CODE").alias("snomed_code"),
        F.col("DESCRIPTION").alias("condition_source_value"),
        date_or_null("START").alias("condition_start_date"),
    )


def synthea_encounters(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Id").alias("visit_source_value"),
        F.col("PATIENT").alias("person_source_value"),
        F.col("ENCOUNTERCLASS").alias("encounter_class"),
        date_or_null("START").alias("visit_start_date"),
        date_or_null("STOP").alias("visit_end_date"),
    )


def synthea_medications(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("PATIENT").alias("person_source_value"),
        F.col("CODE").alias("rxnorm_code"),
        F.col("DESCRIPTION").alias("drug_source_value"),
        date_or_null("START").alias("drug_exposure_start_date"),
        date_or_null("STOP").alias("drug_exposure_end_date"),
        number_or_null("DISPENSES").alias("dispenses"),
        F.col("REASONCODE").alias("reason_snomed_code"),
    )


def synthea_observations(raw: DataFrame) -> DataFrame:
    """Numeric results only; questionnaire answers and other text results stay in RAW."""
    return raw.filter(F.col("TYPE") == "numeric").select(
        F.col("PATIENT").alias("person_source_value"),
        F.col("CODE").alias("loinc_code"),
        F.col("DESCRIPTION").alias("measurement_source_value"),
        number_or_null("VALUE").alias("value_as_number"),
        F.col("UNITS").alias("unit_source_value"),
        date_or_null("DATE").alias("measurement_date"),
    )


def synthea_procedures(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("PATIENT").alias("person_source_value"),
        F.col("CODE").alias("snomed_code"),
        F.col("DESCRIPTION").alias("procedure_source_value"),
        date_or_null("START").alias("procedure_date"),
        F.col("REASONCODE").alias("reason_snomed_code"),
    )


def metabric_patient(raw: DataFrame) -> DataFrame:
    """The study enrolled women only and has no sex column, so gender is a constant."""
    return raw.select(
        F.col("PATIENT_ID").alias("person_source_value"),
        F.lit("F").alias("gender_source_value"),
        number_or_null("AGE_AT_DIAGNOSIS").alias("age_at_diagnosis"),
        F.col("VITAL_STATUS").alias("vital_status"),
        F.col("OS_STATUS").alias("os_status"),
        number_or_null("OS_MONTHS").alias("os_months"),
    )


def metabric_sample(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("PATIENT_ID").alias("person_source_value"),
        F.col("SAMPLE_ID").alias("sample_id"),
        F.col("CANCER_TYPE_DETAILED").alias("cancer_type_detailed"),
        F.col("ER_STATUS").alias("er_status"),
        F.col("PR_STATUS").alias("pr_status"),
        F.col("HER2_STATUS").alias("her2_status"),
        F.col("TUMOR_STAGE").alias("tumor_stage"),
        F.col("GRADE").alias("grade"),
        number_or_null("TUMOR_SIZE").alias("tumor_size_mm"),
    )


def tcga_patient(raw: DataFrame) -> DataFrame:
    sex = F.upper("SEX")
    return raw.select(
        F.col("PATIENT_ID").alias("person_source_value"),
        F.when(sex.isin("FEMALE", "F"), "F").when(sex.isin("MALE", "M"), "M").alias("gender_source_value"),
        F.col("AJCC_PATHOLOGIC_TUMOR_STAGE").alias("ajcc_stage"),
    )


def tcga_sample(raw: DataFrame) -> DataFrame:
    """The study publishes no receptor columns; a typed NULL keeps the shape of the other study."""
    return raw.select(
        F.col("PATIENT_ID").alias("person_source_value"),
        F.col("SAMPLE_ID").alias("sample_id"),
        F.col("CANCER_TYPE_DETAILED").alias("cancer_type_detailed"),
        F.lit(None).cast("string").alias("er_status"),
    )


# Staging view -> (raw table, projection).
VIEWS = {
    "stg_synthea_patients": ("synthea__patients", synthea_patients),
    "stg_synthea_conditions": ("synthea__conditions", synthea_conditions),
    "stg_synthea_encounters": ("synthea__encounters", synthea_encounters),
    "stg_synthea_medications": ("synthea__medications", synthea_medications),
    "stg_synthea_observations": ("synthea__observations", synthea_observations),
    "stg_synthea_procedures": ("synthea__procedures", synthea_procedures),
    "stg_metabric_patient": ("metabric__data_clinical_patient", metabric_patient),
    "stg_metabric_sample": ("metabric__data_clinical_sample", metabric_sample),
    "stg_tcga_patient": ("tcga_brca__data_clinical_patient", tcga_patient),
    "stg_tcga_sample": ("tcga_brca__data_clinical_sample", tcga_sample),
}
