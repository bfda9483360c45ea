"""Source codes and words to standard concept ids.

Two routes: the published vocabulary, looked up by code, and the reviewed concept map, looked up by value. Every lookup
is a left join on plain equality with its constant conditions applied to the lookup beforehand, so a fact row is never
lost. No side is forced to broadcast: Spark picks that from the lookup's measured size and sort-merges (with adaptive
skew splitting on the fact side) beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.functions.casts import has_text

# Encounter class -> visit concept id; any other class is 0.
VISIT_CLASS = {"inpatient": 9201, "emergency": 9203, "ambulatory": 9202, "outpatient": 9202, "wellness": 9202}


def code_lookup(vocabulary: DataFrame, vocabulary_id: str, standard_only: bool = True) -> DataFrame:
    """(code, concept_id) of one vocabulary, all its codes or only those of standard concepts."""
    in_scope = F.col("VOCABULARY_ID") == vocabulary_id
    if standard_only:
        in_scope = in_scope & (F.col("STANDARD_CONCEPT") == "S")
    return vocabulary.filter(in_scope).select(
        F.col("CONCEPT_CODE").alias("code"), F.col("CONCEPT_ID").cast("long").alias("concept_id")
    )


def resolve_code(df: DataFrame, codes: DataFrame, code_column: str, concept_column: str) -> DataFrame:
    """Adds ``concept_column`` from a code lookup, 0 when it lacks the code."""
    return resolve_value(df, codes, {code_column: "code"}, concept_column, default=0)


def resolve_value(
    df: DataFrame, lookup: DataFrame, keys: dict[str, str], concept_column: str, default: int | None = None
) -> DataFrame:
    """Adds ``concept_column`` from a lookup with a ``concept_id``; ``keys`` maps df columns to lookup columns."""
    side = lookup.select(
        *[F.col(theirs).alias(ours) for ours, theirs in keys.items()],
        F.col("concept_id").cast("long").alias(concept_column),
    )
    joined = df.join(side, list(keys), "left")
    return joined if default is None else joined.na.fill(default, [concept_column])


def approved(concept_map: DataFrame) -> DataFrame:
    """Only signed-off rows may act; rows awaiting review, declined or kept elsewhere never resolve a value."""
    return concept_map.filter(F.col("review_status") == "STANDARD")


def gender_values(concept_map: DataFrame) -> DataFrame:
    """Gender words of all sources, each pair once (the sources repeat them)."""
    words = concept_map.filter((F.col("omop_field") == "gender_concept_id") & has_text("source_value"))
    return words.select("source_value", "concept_id").distinct()


def field_values(concept_map: DataFrame, source_field: str) -> DataFrame:
    """Value map of one source field, whatever its review status."""
    return concept_map.filter(F.col("source_field") == source_field).select("source_value", "concept_id")


def histology_values(concept_map: DataFrame) -> DataFrame:
    words = approved(concept_map).filter((F.col("omop_field") == "condition_concept_id") & has_text("source_value"))
    return words.select("source", "source_value", "concept_id")


def answer_values(concept_map: DataFrame, table: str) -> DataFrame:
    """Coded answers (value_as_concept_id) of one clinical table."""
    target = (F.col("omop_field") == "value_as_concept_id") & (F.col("omop_table") == table)
    words = approved(concept_map).filter(target & has_text("source_value"))
    return words.select("source", "source_field", "source_value", "concept_id")


def unit_codes(concept_map: DataFrame) -> DataFrame:
    """Unit concepts by unit code."""
    return approved(concept_map).filter(F.col("omop_field") == "unit_concept_id").select("source_code", "concept_id")


def observed_fields(concept_map: DataFrame) -> DataFrame:
    """What each source field observes."""
    rows = approved(concept_map).filter(F.col("omop_field") == "observation_concept_id")
    return rows.select("source", "source_field", "concept_id")


def observation_units(concept_map: DataFrame) -> DataFrame:
    target = (F.col("omop_field") == "unit_concept_id") & (F.col("omop_table") == "observation")
    return approved(concept_map).filter(target).select("source", "source_field", "concept_id")


def visit_concept(encounter_class: Column | str) -> Column:
    word = F.lower(encounter_class)
    concept = F
    for name, concept_id in VISIT_CLASS.items():
        concept = concept.when(word == name, F.lit(concept_id).cast("long"))
    return concept.otherwise(F.lit(0).cast("long"))
