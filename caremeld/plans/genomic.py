"""The genomic layer: raw variant tables as they are, and the sample-to-person crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_person(metabric_sample: DataFrame, tcga_sample: DataFrame, person: DataFrame) -> DataFrame:
    """Every sample once; ``person_id`` is NULL when the patient is unknown."""
    columns = ["sample_id", F.col("person_source_value").alias("patient_id")]
    samples = metabric_sample.select(F.lit("metabric").alias("source"), *columns).unionByName(
        tcga_sample.select(F.lit("tcga_brca").alias("source"), *columns)
    )
    people = person.select("person_id", F.col("person_source_value").alias("patient_id"))
    return samples.join(people, "patient_id", "left").select("source", "sample_id", "patient_id", "person_id")


def raw_mutations(raw: DataFrame) -> DataFrame:
    """Variant calls pass through untouched."""
    return raw
