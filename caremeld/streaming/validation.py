"""Landing and checking raw files batch by batch, as they arrive.

Every micro-batch is written as rows, then checked from what was written. What a check needs to know of a batch is small and adds
up: the failing rows of a condition are a number, values outside a list are those values, keys that must be unique or must
have a parent are the keys with their counts. This evidence is written for each batch; a report over all of it equals the
report of the same checks over all rows, whatever the batches were.

A batch writes below a folder of its own number and overwrites it, so a batch that is replayed after a failure writes nothing
twice. ``Rejected`` ends a stream at the batch that breaks an error-level check, after its report is written; a
restart takes up at the same batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caremeld.operators.checks import Check
from caremeld.sources.landing import is_missing

EVIDENCE = "check_name string, value string, n long"
REPORT = "check_name string, table_name string, column_name string, category string, severity string, violations long, status string"
#: Kinds whose evidence is keys or values; all others are conditions on a row.
BY_VALUE = ("unique", "relationships", "accepted_values")


class Rejected(Exception):
    """A batch broke an error-level check."""


@dataclass(frozen=True)
class Feed:
    """One raw table that arrives as files, its projection to a staging view, and the checks on that view.

    ``parents`` are the tables that relationship checks look up, as they are when a report is made.
    """

    view: str
    project: Callable[[DataFrame], DataFrame]
    checks: list[Check]
    location: str
    parents: Mapping[str, DataFrame] = field(default_factory=dict)

    def place(self, kind: str, batch: int | None = None) -> str:
        return f"{self.location}/{kind}" + ("" if batch is None else f"/batch={batch}")

    def read(self, spark: SparkSession, kind: str, schema: str | T.StructType) -> DataFrame:
        """All batches of rows, evidence or reports, with the number of their ``batch``; none before the first."""
        whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        whole = T.StructType([*whole.fields, T.StructField("batch", T.LongType())])
        try:
            return spark.read.schema(whole).parquet(self.place(kind))
        except AnalysisException as error:
            if is_missing(error):
                return spark.createDataFrame([], whole)
            raise


def arriving(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True, files_per_batch: int = 1000) -> DataFrame:
    """Flat files as they appear in a folder, all columns text, read as ``landing.read_flat`` reads them.

    The header of every file must name ``columns`` in order, else the batch fails.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).csv(
        path,
        sep="\t" if path.rstrip("/").endswith(".txt") else ",",
        header=True,
        comment="#",
        quote='"',
        escape='"',
        multiLine=multi_line,
        enforceSchema=False,
        mode="PERMISSIVE" if multi_line else "FAILFAST",
    )
    return stream.na.fill("")


def evidence(checks: list[Check], staged: DataFrame) -> DataFrame:
    """(check_name, value, n): what a report over several batches needs to know of one.

    Conditions on a row are counted in one pass; keys and values are reduced to one row each before they are shuffled.
    """
    conditions = [c for c in checks if c.kind not in BY_VALUE]
    parts = []
    if conditions:
        counted = staged.agg(*[F.count_if(c.failing_row()).alias(c.name) for c in conditions])
        rows = [F.struct(F.lit(c.name).alias("check_name"), F.lit(None).cast("string").alias("value"), F.col(c.name).alias("n")) for c in conditions]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for check in checks:
        if check.kind in BY_VALUE:
            rows = staged.filter(check.failing_row()) if check.kind == "accepted_values" else check.rows({check.table: staged})
            value = F.col(check.column).cast("string")
            known = rows.filter(F.col(check.column).isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
            parts.append(known.select(F.lit(check.name).alias("check_name"), "value", "n"))
    return reduce(DataFrame.unionByName, parts)


def reported(checks: list[Check], found: DataFrame, parents: Mapping[str, DataFrame], only: DataFrame | None = None) -> DataFrame:
    """The report of ``checks`` over the evidence of some batches, in the columns of ``operators.checks.report``.

    With ``only``, the evidence of one of these batches, keys that other batches hold as well count, but keys that it
    has not are not judged.
    """
    judged = found if only is None else only
    counts = []
    for check in checks:
        own = judged.filter(F.col("check_name") == check.name)
        if check.kind == "unique":
            whole = found.filter(F.col("check_name") == check.name)
            if only is not None:
                whole = whole.join(own.select("value").distinct(), "value", "left_semi")
            bad = whole.groupBy("value").agg(F.sum("n").alias("n")).filter("n > 1").agg(F.count("*").alias("violations"))
        elif check.kind == "accepted_values":
            bad = own.agg(F.count_distinct("value").alias("violations"))
        elif check.kind == "relationships":
            parent = parents[check.arguments["parent"]].select(F.col(check.arguments["parent_column"]).cast("string").alias("value"))
            keys = own.groupBy("value").agg(F.sum("n").alias("n"))
            bad = keys.join(parent.distinct(), "value", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        else:
            bad = own.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        about = (check.name, check.table, check.column, check.category, check.severity)
        names = ("check_name", "table_name", "column_name", "category", "severity")
        counts.append(bad.select(*[F.lit(v).alias(n) for n, v in zip(names, about)], F.col("violations").cast("long")))
    clean = F.col("violations") == 0
    status = F.when(clean, "PASS").when(F.col("severity") == "warn", "WARN").otherwise("ERROR")
    return reduce(DataFrame.unionByName, counts).withColumn("status", status)


def take(feed: Feed, batch: DataFrame, number: int, stop: bool = False) -> None:
    """Lands one micro-batch, writes its evidence and its report, and rejects it if ``stop`` and a check is broken."""
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(feed.place("rows", number))
    landed = spark.read.schema(batch.schema).parquet(feed.place("rows", number))
    evidence(feed.checks, feed.project(landed)).write.mode("overwrite").parquet(feed.place("evidence", number))
    so_far = feed.read(spark, "evidence", EVIDENCE).filter(F.col("batch") <= number)
    own = so_far.filter(F.col("batch") == number)
    reported(feed.checks, so_far, feed.parents, own).write.mode("overwrite").parquet(feed.place("reports", number))
    if stop:
        broken = spark.read.schema(REPORT).parquet(feed.place("reports", number)).filter("status = 'ERROR'").collect()
        if broken:
            raise Rejected(f"batch {number} of {feed.view}: " + ", ".join(f"{r.check_name} ({r.violations})" for r in broken))


def watch(stream: DataFrame, feed: Feed, checkpoint: str, stop: bool = False, every: str | None = None) -> StreamingQuery:
    """Starts landing and checking a stream; without ``every`` it takes what is there and ends."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: take(feed, batch, number, stop))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def rows(spark: SparkSession, feed: Feed, columns: list[str]) -> DataFrame:
    """The raw rows of all batches."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return feed.read(spark, "rows", schema).select(*columns)


def report(spark: SparkSession, feed: Feed) -> DataFrame:
    """The report over all batches so far."""
    return reported(feed.checks, feed.read(spark, "evidence", EVIDENCE), feed.parents)


def batch_reports(spark: SparkSession, feed: Feed) -> DataFrame:
    """The report of every batch, with its number."""
    return feed.read(spark, "reports", REPORT)
