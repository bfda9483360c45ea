"""The de-identified layer: years instead of dates, no source identifiers, ages above 89 as one group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.functions.casts import year_of

# Fixed value: the highest age that may be told apart.
OLDEST_AGE = 89

# De-identified variant column -> raw column.
VARIANT_COLUMNS = {
    "hugo_symbol": "Hugo_Symbol",
    "entrez_gene_id": "Entrez_Gene_Id",
    "chromosome": "Chromosome",
    "start_position": "Start_Position",
    "variant_classification": "Variant_Classification",
    "variant_type": "Variant_Type",
    "protein_change": "HGVSp_Short",
}
LINK_COLUMNS = ["sample_id", "person_id"]


def this_year(as_of_year: int | None):
    year = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return year.cast("long")


def person_deid(person: DataFrame, as_of_year: int | None = None) -> DataFrame:
    now, born = this_year(as_of_year), F.col("year_of_birth")
    return person.select(
        "person_id",
        "gender_concept_id",
        F.when(now - born > OLDEST_AGE, now - (OLDEST_AGE + 1)).otherwise(born).alias("year_of_birth"),
        "race_concept_id",
        "ethnicity_concept_id",
    )


def condition_occurrence_deid(conditions: DataFrame) -> DataFrame:
    return conditions.select(
        "condition_occurrence_id",
        "person_id",
        "condition_concept_id",
        year_of("condition_start_date").alias("condition_start_year"),
    )


def measurement_deid(measurements: DataFrame) -> DataFrame:
    return measurements.select(
        "measurement_id",
        "person_id",
        "measurement_concept_id",
        year_of("measurement_date").alias("measurement_year"),
        "value_as_number",
        "value_as_concept_id",
        "value_source_value",
        "unit_concept_id",
        "measurement_source_value",
    )


def observation_deid(observations: DataFrame) -> DataFrame:
    return observations.select(
        "observation_id",
        "person_id",
        "observation_concept_id",
        year_of("observation_date").alias("observation_year"),
        "value_as_number",
        "value_as_concept_id",
        "value_source_value",
        "unit_concept_id",
        "observation_source_value",
    )


def visit_occurrence_deid(visits: DataFrame) -> DataFrame:
    return visits.select(
        "visit_occurrence_id",
        "person_id",
        "visit_concept_id",
        year_of("visit_start_date").alias("visit_start_year"),
        year_of("visit_end_date").alias("visit_end_year"),
    )


def drug_exposure_deid(drugs: DataFrame) -> DataFrame:
    return drugs.select(
        "drug_exposure_id",
        "person_id",
        "drug_concept_id",
        year_of("drug_exposure_start_date").alias("drug_exposure_start_year"),
        year_of("drug_exposure_end_date").alias("drug_exposure_end_year"),
        "quantity",
    )


def procedure_occurrence_deid(procedures: DataFrame) -> DataFrame:
    return procedures.select(
        "procedure_occurrence_id",
        "person_id",
        "procedure_concept_id",
        year_of("procedure_date").alias("procedure_year"),
    )


def observation_period_deid(periods: DataFrame) -> DataFrame:
    return periods.select(
        "observation_period_id",
        "person_id",
        year_of("observation_period_start_date").alias("observation_period_start_year"),
        year_of("observation_period_end_date").alias("observation_period_end_year"),
        "period_type_concept_id",
    )


def mutations_deid(metabric_mutations: DataFrame, tcga_mutations: DataFrame, sample_person: DataFrame) -> DataFrame:
    """Variants by person without barcodes. Samples are matched on their barcode alone.

    ``sample_person`` may be the whole crosswalk or its (sample_id, person_id) columns as ``linked_samples`` gives them.
    """

    def variants(raw: DataFrame, source: str) -> DataFrame:
        return raw.select(
            F.lit(source).alias("source"),
            F.col("Tumor_Sample_Barcode").alias("sample_id"),
            *[F.col(raw_name).alias(name) for name, raw_name in VARIANT_COLUMNS.items()],
        )

    calls = variants(metabric_mutations, "metabric").unionByName(variants(tcga_mutations, "tcga_brca"))
    linked = sample_person if sample_person.columns == LINK_COLUMNS else linked_samples(sample_person)
    return calls.join(linked, "sample_id").select("person_id", "source", *VARIANT_COLUMNS)


def linked_samples(sample_person: DataFrame) -> DataFrame:
    """Samples whose patient is known."""
    return sample_person.filter(F.col("person_id").isNotNull()).select(LINK_COLUMNS)


def distinct_counts(
    base: DataFrame, key: str, facts: list[tuple[DataFrame, str, str]], keep: list[str] | None = None
) -> DataFrame:
    """Base rows with, per (facts, column, name), the number of distinct values of their key; 0 without facts.

    Each fact table is counted per key before it meets the base, so the facts of one key never multiply each other. A
    distinct count is not changed by that product, and Spark spreads it over (key, value) first, so a key with most of
    the facts is shared between tasks.
    """
    joined = base.select(key, *(keep or []))
    for df, column, name in facts:
        counted = df.groupBy(key).agg(F.count_distinct(column).alias(name))
        joined = joined.join(counted, key, "left")
    counts = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for _, _, name in facts]
    return joined.select(key, *(keep or []), *counts)


def unique_patients(person_deid: DataFrame, conditions_deid: DataFrame, mutations_deid: DataFrame) -> DataFrame:
    """The roster, from de-identified tables only."""
    return distinct_counts(
        person_deid,
        "person_id",
        [
            (conditions_deid, "condition_concept_id", "distinct_conditions"),
            (mutations_deid, "hugo_symbol", "distinct_mutated_genes"),
        ],
        keep=["gender_concept_id", "year_of_birth"],
    )
