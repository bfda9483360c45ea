"""How checks fare from run to run: an append-only history of reports, and what changed.

A run's report is written below a folder of its own number, so recording it again replaces it and nothing else. Runs are
numbered upwards by the caller.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremeld.sources.landing import is_missing

REPORT = "check_name string, table_name string, column_name string, category string, severity string, violations long, status string"


def record(report: DataFrame, location: str, run: int) -> None:
    """Keeps the report of a run (the columns of ``operators.checks.report``)."""
    names = [f.split()[0] for f in REPORT.split(", ")]
    report.select(*names).coalesce(1).write.mode("overwrite").parquet(f"{location}/run={run}")


def history(spark: SparkSession, location: str) -> DataFrame:
    """All reports with their ``run``; none before the first."""
    try:
        return spark.read.schema(f"{REPORT}, run long").parquet(location)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], f"{REPORT}, run long")
        raise


def check_trend(reports: DataFrame) -> DataFrame:
    """A row for every check and run: its violations, those of the run before, and since when it has been failing.

    (check_name, run, status, violations, previous, change, failing_since, runs_failing, event). A check fails if it does not
    PASS. ``event`` is ``broke`` or ``fixed`` where that changed since its last run, ``worse`` or ``better`` where it fails
    with more or fewer violations, ``first failure`` where it fails the first time it is seen; else NULL.
    """
    of_check = Window.partitionBy("check_name").orderBy("run")
    failing = F.col("status") != "PASS"
    seen = reports.select("check_name", "run", "status", "violations", failing.alias("failing"))
    seen = seen.withColumns(
        {
            "previous": F.lag("violations").over(of_check),
            "was_failing": F.lag("failing").over(of_check),
            # the passes so far number the stretches of failures between them
            "stretch": F.count_if(~F.col("failing")).over(of_check.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    of_stretch = Window.partitionBy("check_name", "stretch", "failing").orderBy("run")
    change = F.col("violations") - F.col("previous")
    event = (
        F.when(F.col("failing") & F.col("was_failing").isNull(), "first failure")
        .when(F.col("failing") & ~F.col("was_failing"), "broke")
        .when(~F.col("failing") & F.col("was_failing"), "fixed")
        .when(F.col("failing") & (change > 0), "worse")
        .when(F.col("failing") & (change < 0), "better")
    )
    return seen.select(
        "check_name",
        "run",
        "status",
        "violations",
        "previous",
        change.alias("change"),
        F.when(F.col("failing"), F.first("run").over(of_stretch)).alias("failing_since"),
        F.when(F.col("failing"), F.row_number().over(of_stretch)).otherwise(0).cast("long").alias("runs_failing"),
        event.alias("event"),
    )


def pass_rates(reports: DataFrame, drift: float = 0.05) -> DataFrame:
    """A row for every run and category: checks, passes, their share, its change since the category's last run, and whether
    it fell by more than ``drift`` below the best run so far."""
    rates = reports.groupBy("run", "category").agg(F.count("*").alias("n_checks"), F.count_if(F.col("status") == "PASS").alias("n_passed"))
    rates = rates.withColumn("pass_rate", F.col("n_passed") / F.col("n_checks"))
    order = Window.partitionBy("category").orderBy("run")
    best = F.max("pass_rate").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rates.select(
        "run", "category", "n_checks", "n_passed", "pass_rate",
        (F.col("pass_rate") - F.lag("pass_rate").over(order)).alias("change"), (best - F.col("pass_rate") > drift).alias("drifted"),
    )
