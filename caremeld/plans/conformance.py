"""Whether the tables have the fields that the published model asks for: name, type, length, and values where required.

Schemas are metadata and are compared as rows with the specification's rows; what only the data can show (text that is too long,
NULLs in required fields) is one aggregation for each table over the fields concerned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What holds values of a published type without loss.
TYPES = {
    "integer": ("tinyint", "smallint", "int", "bigint"),
    "float": ("float", "double", "decimal", "int", "bigint"),
    "date": ("date",),
    "datetime": ("timestamp", "timestamp_ntz"),
    "varchar": ("string", "varchar", "char"),
}
FINDINGS = "table_name string, field_name string, violation string, expected string, actual string, n_values long"


def schema_rows(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, field_name, data_type) of every field, as the tables have it; no row is read."""
    rows = [(name.lower(), f.name.lower(), f.dataType.simpleString()) for name, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, "table_name string, field_name string, data_type string")


def structural(schemas: DataFrame, spec: DataFrame) -> DataFrame:
    """ABSENT_REQUIRED, ABSENT_OPTIONAL, MISTYPED and EXTRA fields of the tables that both sides know."""
    wanted = spec.select(
        F.lower("cdm_table_name").alias("table_name"), F.lower("cdm_field_name").alias("field_name"),
        (F.upper("is_required") == "TRUE").alias("required"), F.lower("cdm_datatype").alias("expected"),
    )
    known = schemas.select("table_name").distinct()
    published = wanted.select("table_name").distinct()
    both = wanted.join(known, "table_name", "left_semi").join(schemas.join(published, "table_name", "left_semi"), ["table_name", "field_name"], "full")
    base = F.regexp_replace("data_type", r"\(.*", "")
    kinds = F.create_map(*[x for kind, names in TYPES.items() for x in (F.lit(kind), F.array(*map(F.lit, names)))])
    fits = F.array_contains(kinds[F.regexp_replace("expected", r"\(.*", "")], base)
    violation = (
        F.when(F.col("data_type").isNull() & F.col("required"), "ABSENT_REQUIRED")
        .when(F.col("data_type").isNull(), "ABSENT_OPTIONAL")
        .when(F.col("expected").isNull(), "EXTRA")
        .when(~F.coalesce(fits, F.lit(False)), "MISTYPED")
    )
    found = both.withColumn("violation", violation).where("violation is not null")
    return found.select("table_name", "field_name", "violation", "expected", F.col("data_type").alias("actual"), F.lit(None).cast("long").alias("n_values"))


def in_values(tables: dict[str, DataFrame], spec_rows: list[tuple[str, str, bool, str]]) -> DataFrame | None:
    """TOO_LONG text and NULL_REQUIRED values with how many there are; one pass for each table that has such fields."""
    parts = []
    for name, df in tables.items():
        types, counts = {f.name.lower(): f.dataType for f in df.schema}, []
        for table, field, required, kind in spec_rows:
            if table != name.lower() or field not in types:
                continue
            length = kind.removeprefix("varchar(").rstrip(")")
            if length.isdigit() and isinstance(types[field], T.StringType):
                counts.append((field, "TOO_LONG", kind, F.count_if(F.length(field) > int(length))))
            if required:
                counts.append((field, "NULL_REQUIRED", "not null", F.count_if(F.col(field).isNull())))
        if counts:
            counted = df.agg(*[count.alias(f"c{i}") for i, (*_, count) in enumerate(counts)])
            rows = [
                F.struct(
                    F.lit(name.lower()).alias("table_name"), F.lit(field).alias("field_name"), F.lit(violation).alias("violation"),
                    F.lit(kind).alias("expected"), F.lit(types[field].simpleString()).alias("actual"), F.col(f"c{i}").alias("n_values"),
                )
                for i, (field, violation, kind, _) in enumerate(counts)
            ]
            parts.append(counted.select(F.inline(F.array(*rows))).where("n_values > 0"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def field_conformance(spark: SparkSession, tables: dict[str, DataFrame], spec: DataFrame) -> DataFrame:
    """Every finding, in ``FINDINGS``. The specification, a row for each published field, is read to the driver."""
    rows = [(r.cdm_table_name.lower(), r.cdm_field_name.lower(), r.is_required.upper() == "TRUE", r.cdm_datatype.lower()) for r in spec.collect()]
    found = structural(schema_rows(spark, tables), spec)
    values = in_values(tables, rows)
    return found.unionByName(values) if values is not None else found


def unmet(findings: DataFrame) -> DataFrame:
    """The findings that break conformance: all but optional fields that are absent."""
    return findings.where("violation <> 'ABSENT_OPTIONAL'")
