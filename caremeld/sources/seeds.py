"""Reviewed reference tables: the concept map, the published table list and the scope decisions."""

from __future__ import annotations

import csv
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CONCEPT_MAP_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_field", T.StringType()),
        T.StructField("source_value", T.StringType()),
        T.StructField("omop_table", T.StringType()),
        T.StructField("omop_field", T.StringType()),
        T.StructField("target_domain", T.StringType()),
        T.StructField("target_vocabulary", T.StringType()),
        T.StructField("source_code", T.StringType()),
        T.StructField("concept_id", T.LongType()),
        T.StructField("review_status", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)
SPEC_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("cdm_table_name", "cdm_schema", "is_required")]
)
FIELD_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("cdm_table_name", "cdm_field_name", "is_required", "cdm_datatype")]
)
SCOPE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("cdm_table_name", "status", "reason")])

REVIEW_STATUSES = ["STANDARD", "RESOLVE_AT_ETL", "REVIEW", "NOT_MAPPED", "PARALLEL_LAYER"]
SOURCES = ["synthea", "metabric", "tcga_brca"]


def packaged(name: str, schema: T.StructType) -> list[tuple]:
    """The rows of one of the reviewed tables beside this module, under the same rules as ``load_seed``."""
    text = files("caremeld.sources").joinpath("data", f"{name}.csv").read_text(encoding="utf-8")
    header, *rows = csv.reader(text.splitlines())
    if header != schema.names:
        raise ValueError(f"{name}.csv has the columns {header}, not {schema.names}")
    number = [field.dataType == T.LongType() for field in schema]
    return [tuple(int(c) if n and c else c or None for c, n in zip(row, number, strict=True)) for row in rows]


def _frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    arrow_types = {"string": pa.string(), "bigint": pa.int64()}
    columns = {
        field.name: pa.array([row[i] for row in rows], arrow_types[field.dataType.simpleString()])
        for i, field in enumerate(schema)
    }
    return spark.createDataFrame(pa.table(columns))


def concept_map(spark: SparkSession) -> DataFrame:
    return _frame(spark, packaged("concept_map", CONCEPT_MAP_SCHEMA), CONCEPT_MAP_SCHEMA)


def cdm_spec(spark: SparkSession) -> DataFrame:
    return _frame(spark, packaged("cdm_v54_tables", SPEC_SCHEMA), SPEC_SCHEMA)


def cdm_fields(spark: SparkSession) -> DataFrame:
    """The published fields of the tables that are built, with their types."""
    return _frame(spark, packaged("cdm_v54_fields", FIELD_SCHEMA), FIELD_SCHEMA)


def cdm_scope(spark: SparkSession) -> DataFrame:
    return _frame(spark, packaged("cdm_scope", SCOPE_SCHEMA), SCOPE_SCHEMA)


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header read under a declared schema; empty cells are NULL.

    Names in the header are checked against the schema, so a reordered file fails instead of shifting columns.
    """
    return spark.read.schema(schema).csv(path, header=True, escape='"', enforceSchema=False, mode="FAILFAST")
