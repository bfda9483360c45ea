"""Dense 1..N ids in a stated order, without gathering the rows in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.session import new_path, stored_bytes

RANGE_BYTES = 64 << 20
#: Below this size a range is not worth a task of its own.
SMALL_RANGE_BYTES = 2 << 20
#: Of the rows that are written to be numbered: they are read twice and then of no more use.
COMPRESSION = "zstd"
#: ``monotonically_increasing_id``: the partition above, the place in it below.
PLACE_BITS = 33


def assign_surrogate_id(
    df: DataFrame,
    id_column: str,
    order: list[str],
    num_partitions: int | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Number the rows 1..N by ``order`` (NULLs last); the remaining columns break ties.

    The rows are written once to the shared folder, each with a mark of its own that breaks the last ties, then range-partitioned
    by the *whole* order, as many ranges as the written bytes ask for, sorted, and written with their places: a date that most
    rows share is split by the later columns and a large group of equal rows by their marks. The number of rows of each
    range, one small row a range, gives the id its first row has. Ids depend on written rows only: losing an executor, or
    reading the result twice, can't change one.

    ``drop`` names columns that only serve the order.
    """
    spark = df.sparkSession
    columns = [*order, *[c for c in df.columns if c not in order], "_mark"]
    path = new_path(spark, id_column)
    marked = df.withColumn("_mark", F.monotonically_increasing_id())
    marked.write.option("compression", COMPRESSION).parquet(path)
    written = spark.read.schema(marked.schema).parquet(path)
    kept = [F.col(c) for c in df.columns if c not in drop]
    n_ranges = num_partitions or _ranges(spark, stored_bytes(spark, path))
    keys = [F.col(c).asc_nulls_last() for c in columns]
    if n_ranges == 1:  # one task for what fits one: its places are the numbers
        alone = written.repartition(1).sortWithinPartitions(*keys)
        return alone.select((F.monotonically_increasing_id() + 1).alias(id_column), *kept)
    placed = _placed(written, keys, kept, n_ranges, id_column)
    sizes = _sizes(placed)
    starts = list(accumulate((n for _, n in sizes), initial=0))
    before = spark.createDataFrame([(part, start) for (part, _), start in zip(sizes, starts)], "_part int, _start long")
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.join(before, "_part").select((F.col("_start") + place + 1).alias(id_column), *kept)


def _ranges(spark, size: int) -> int:
    """Enough ranges for their size, and for small data as many as there are cores."""
    return max(-(-size // RANGE_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // SMALL_RANGE_BYTES)), 1)


def _placed(written: DataFrame, keys: list, kept: list, n_ranges: int, label: str) -> DataFrame:
    """The rows in ranges of the order, with their range (``_part``) and their place in it (``_at``), as written."""
    spark = written.sparkSession
    ranged = written.repartitionByRange(n_ranges, *keys).sortWithinPartitions(*keys)
    placed = ranged.select(F.monotonically_increasing_id().alias("_at"), *kept)
    placed = placed.select(F.shiftright("_at", PLACE_BITS).cast("int").alias("_part"), "*")
    path = new_path(spark, f"{label}-placed")
    placed.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _sizes(placed: DataFrame) -> list[tuple[int, int]]:
    """(range, rows) in order."""
    return sorted(tuple(r) for r in placed.groupBy("_part").agg(F.count("*")).collect())
