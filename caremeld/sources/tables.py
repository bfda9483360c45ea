"""Catalog tables: create or replace, and inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" location '{location}/{database}.db'" if location else ""
    spark.sql(f"create database if not exists {database}{place}")


def save_table(
    df: DataFrame, database: str, table: str, location: str | None = None, partition_by: list[str] | None = None
) -> DataFrame:
    """Creates or replaces a table and returns it as written."""
    spark = df.sparkSession
    create_database(spark, database, location)
    df.write.mode("overwrite").saveAsTable(f"{database}.{table}", format="parquet", partitionBy=partition_by)
    return spark.table(f"{database}.{table}")


def write_overwrite(
    df: DataFrame, database: str, table: str, location: str | None = None, partition_by: list[str] | None = None
) -> int:
    """Creates or replaces a table and returns its number of rows, which the written footers hold."""
    return save_table(df, database, table, location, partition_by).count()


def inventory(tables: dict[tuple[str, str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, table_type, n_rows) for tables given by (layer, name, type)."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n_rows")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.lit(kind).alias("table_type"), "n_rows"
            )
            for (layer, name, kind), df in tables.items()
        ],
    )


def catalog_tables(spark: SparkSession, databases: dict[str, str]) -> dict[tuple[str, str, str], DataFrame]:
    """Tables that the catalog lists for each layer's database, in the form ``inventory`` takes."""
    return {
        (layer, t.name, "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "BASE TABLE"): spark.table(
            f"{database}.{t.name}"
        )
        for layer, database in databases.items()
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
