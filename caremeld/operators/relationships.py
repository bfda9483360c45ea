"""From non-standard concepts to the standard ones they map to, through a table of relationships.

A relationship may lead to another non-standard concept, to several concepts, to none that is known, or back to where it came
from. Chains are followed to their ends: each round extends only the pairs that the round before has found, pairs that
were seen are not followed again, so a cycle ends. Rounds are written, one for each step of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremeld.session import new_path

MAPS_TO = "Maps to"


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    """(concept_id_1, concept_id_2, relationship_id, invalid_reason) of a tab-separated extract; ids that are no numbers are left out."""
    extract = spark.read.csv(path, sep="\t", header=True, quote="")
    ids = [F.col(c).try_cast("long").alias(c) for c in ("concept_id_1", "concept_id_2")]
    named = extract.select(*ids, *[F.coalesce(c, F.lit("")).alias(c) for c in ("relationship_id", "invalid_reason")])
    return named.where("concept_id_1 is not null and concept_id_2 is not null")


def _written(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession, "maps-to")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def standard_targets(vocabulary: DataFrame, relationships: DataFrame) -> DataFrame:
    """(concept_id, standard_concept_id): every standard concept that a non-standard one leads to, each pair once.

    Only valid "Maps to" rows between concepts of the vocabulary count. A chain ends at the first standard concept; a concept
    whose chains end nowhere or run in a circle has no row.
    """
    concepts = vocabulary.select(F.col("CONCEPT_ID").cast("long").alias("at"), (F.col("STANDARD_CONCEPT") == "S").alias("standard"))
    concepts = concepts.where(F.col("at").isNotNull()).groupBy("at").agg(F.max("standard").alias("standard"))
    valid = (F.col("relationship_id") == MAPS_TO) & (F.coalesce("invalid_reason", F.lit("")) == "")
    steps = relationships.where(valid & (F.col("concept_id_1") != F.col("concept_id_2")))
    steps = steps.select(F.col("concept_id_1").alias("from"), F.col("concept_id_2").alias("at")).distinct().join(concepts, "at")
    steps = _written(steps.withColumnsRenamed({"at": "to", "standard": "ends"}))
    begin = concepts.where("not standard").select(F.col("at").alias("concept_id"), "at")
    new = _written(begin.join(steps, F.col("at") == F.col("from")).select("concept_id", F.col("to").alias("at"), "ends").distinct())
    seen = [new]
    while not (open_ := new.where("not ends")).isEmpty():
        further = open_.join(steps.withColumnRenamed("ends", "there"), F.col("at") == F.col("from"))
        further = further.select("concept_id", F.col("to").alias("at"), F.col("there").alias("ends")).distinct()
        for known in seen:
            further = further.join(known.select("concept_id", "at"), ["concept_id", "at"], "left_anti")
        new = _written(further)
        seen = [_written(seen[0].unionByName(new))]
    return seen[0].where("ends").select("concept_id", F.col("at").alias("standard_concept_id"))


def mapped_lookup(vocabulary: DataFrame, vocabulary_id: str, targets: DataFrame, every_target: bool = False) -> DataFrame:
    """(code, concept_id) of one vocabulary: standard concepts by their own code, others by what they map to.

    A code of a standard concept never resolves to another one. A code with several targets resolves to the one with the
    smallest id, so that a fact stays one row; with ``every_target`` the lookup has them all, and facts repeat.
    """
    scope = vocabulary.where(F.col("VOCABULARY_ID") == vocabulary_id)
    own = scope.select(
        F.col("CONCEPT_CODE").alias("code"), F.col("CONCEPT_ID").cast("long").alias("concept_id"), (F.col("STANDARD_CONCEPT") == "S").alias("standard")
    )
    standard = own.where("standard").select("code", "concept_id")
    hops = own.where("not standard").join(targets, "concept_id").select("code", F.col("standard_concept_id").alias("concept_id"))
    hops = hops.join(standard.select("code"), "code", "left_anti")
    hops = hops.distinct() if every_target else hops.groupBy("code").agg(F.min("concept_id").alias("concept_id"))
    return standard.unionByName(hops)
