"""Landing what is new: a ledger of the files that were landed, and a load of only those that changed since.

The ledger is append-only; a file's last line says how it was landed: its size, its time, a checksum of its content and its
columns. A file whose size and time are those of its last line is not opened at all. Of the others the content decides: one that
was only touched is not landed again. Rows are kept in a folder for each file, so a changed file replaces its own
rows and no others. Rows are written before the ledger, so a load that is cut short is taken up by the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremeld.session import delete
from caremeld.sources.landing import SOURCES, Source, discover_files, is_missing, read_landed

LEDGER = "run long, table_name string, path string, length long, modified timestamp, checksum string, columns array<string>, status string"
#: The ledger's statuses; SAME files have no line.
NEW, CHANGED, TOUCHED, REMOVED = "NEW", "CHANGED", "TOUCHED", "REMOVED"
#: A Mersenne prime, so that products of two residues fit a decimal; the bases of the two polynomials.
PRIME, BASES = (1 << 61) - 1, (1_000_003, 998_244_353)


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, checksum) of text files of any size, each read once in as many tasks as it has splits.

    The checksum is that of the lines in order: a polynomial in two bases over their hashes. Splits give a pair of factor and
    value, pairs are joined in the order of the splits, and how a file was split does not show.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, factors, values, n = None, [1, 1], [0, 0], 0

        def done() -> pa.RecordBatch:
            fields = {"path": place[0], "start": place[1], "n": n}
            fields |= {f"{kind}{i}": str(of[i]) for kind, of in (("a", factors), ("h", values)) for i in (0, 1)}
            return pa.RecordBatch.from_pylist([fields], schema)

        for batch in batches:
            for *now, hashed in zip(*(c.to_pylist() for c in batch.columns)):
                if now != place:
                    if place:
                        yield done()
                    place, factors, values, n = now, [1, 1], [0, 0], 0
                n += 1
                for i, base in enumerate(BASES):
                    factors[i] = factors[i] * base % PRIME
                    values[i] = (values[i] * base + hashed) % PRIME
        if place:
            yield done()

    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("n", pa.int64()), *[(f"{k}{i}", pa.string()) for k in "ah" for i in (0, 1)]])
    text = spark.read.option("lineSep", "\n").text(paths)
    hashed = text.select("_metadata.file_path", "_metadata.file_block_start", F.xxhash64("value"))
    parts = hashed.mapInArrow(lines, "path string, start long, n long, a0 string, a1 string, h0 string, h1 string")
    whole = "decimal(38,0)"
    part = F.struct("start", "n", *[F.col(c).cast(whole).alias(c) for c in ("a0", "a1", "h0", "h1")])
    # a factor's and a value's products stay below 2^122
    value = lambda i: F.aggregate(
        F.sort_array(F.collect_list(part)),
        F.lit(0).cast(whole),
        lambda h, p: ((h * p[f"a{i}"] % PRIME + p[f"h{i}"]) % PRIME).cast(whole),
    )
    found = parts.groupBy("path").agg(F.sum("n").alias("n"), value(0).alias("x"), value(1).alias("y"))
    return found.select("path", F.concat_ws("-", *[F.col(c).cast("string") for c in ("n", "x", "y")]).alias("checksum"))


def files_below(spark: SparkSession, tables: DataFrame) -> DataFrame:
    """(table_name, path, length, modified, multi_line, named) of every file of the discovered ``tables``, ``named`` being the
    table's own path; files are listed and not opened."""
    listed = sorted(tables.select("table_name", "path", "multi_line").collect())
    parts = []
    for table, path, multi_line in listed:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        parts.append(
            found.select(
                F.lit(table).alias("table_name"), "path", "length", F.col("modificationTime").alias("modified"),
                F.lit(multi_line).alias("multi_line"), F.lit(path).alias("named"),
            )
        )
    none = spark.createDataFrame([], "table_name string, path string, length long, modified timestamp, multi_line boolean, named string")
    return reduce(DataFrame.unionByName, parts, none)


def read_ledger(spark: SparkSession, location: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{location}/ledger")
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], LEDGER)
        raise


def last_lines(ledger: DataFrame) -> DataFrame:
    """What the ledger says of each file it holds and that was not removed."""
    latest = Window.partitionBy("path").orderBy(F.desc("run"))
    return ledger.withColumn("_n", F.row_number().over(latest)).where((F.col("_n") == 1) & (F.col("status") != REMOVED)).drop("_n")


def unlike_ledger(now: DataFrame, ledger: DataFrame, trust_times: bool = True) -> DataFrame:
    """The files whose size or time is not that of the ledger (``status`` NEW, CHANGED or REMOVED, the content not yet compared).

    Without ``trust_times`` all files are named, to be compared by content.
    """
    before = last_lines(ledger).select(
        F.col("table_name").alias("old_table"), "path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"),
        F.col("checksum").alias("old_checksum"), F.col("columns").alias("old_columns"),
    )
    both = now.join(before, "path", "full")
    same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified")) & F.lit(trust_times)
    status = F.when(F.col("old_length").isNull(), NEW).when(F.col("length").isNull(), REMOVED).when(~same, CHANGED)
    return both.withColumn("status", status).where(F.col("status").isNotNull()).withColumn("table_name", F.coalesce("table_name", "old_table"))


def rows_of(location: str, table: str, path: str | None = None) -> str:
    """The folder of a table's rows, or that of the rows of one of its files."""
    return f"{location}/rows/{table}" + (f"/_file={hashlib.sha256(path.encode()).hexdigest()[:32]}" if path else "")


def table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """The rows of a landed table, in the columns its files have."""
    columns = last_lines(read_ledger(spark, location)).where(F.col("table_name") == name).select("columns").first().columns
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).parquet(rows_of(location, name)).select(*[f"`{c}`" for c in columns])


def land_changes(
    spark: SparkSession,
    base: str,
    location: str,
    sources: list[Source] = SOURCES,
    trust_times: bool = True,
    drop_removed: bool = False,
    threads: int = 4,
) -> DataFrame:
    """Lands the files below ``base`` that are new or changed since the last call; returns the ledger lines of this run.

    Rows go below ``location``. ``CHANGED`` files replace their rows, ``TOUCHED`` ones had another time but the same content and
    are not landed, ``REMOVED`` ones are reported, and lose their rows only with ``drop_removed``. Files that are the same
    have no line. A file whose columns are not those of the other files of its table stops the load before any row is
    written. One short row for each file that is not the same reaches the driver.
    """
    ledger = read_ledger(spark, location)
    run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
    found = unlike_ledger(files_below(spark, discover_files(spark, base, sources)), ledger, trust_times).collect()
    found.sort(key=lambda f: (f.table_name, f.path))
    here = [f for f in found if f.status != REMOVED]
    sums = {plain(r.path): r.checksum for r in checksums(spark, [f.path for f in here]).collect()} if here else {}
    checksum = {f.path: sums.get(plain(f.path), "empty") for f in here}
    fresh = [f for f in here if f.old_checksum != checksum[f.path]]
    reads = {f.path: read_landed(spark, f.path, f.multi_line, f.named) for f in fresh}
    kept = last_lines(ledger).join(spark.createDataFrame([(f.path,) for f in found], "path string"), "path", "left_anti")
    expected = {r.table_name: r.columns for r in kept.groupBy("table_name").agg(F.first("columns").alias("columns")).collect()}
    for f in fresh:
        columns = expected.setdefault(f.table_name, reads[f.path].columns)
        if reads[f.path].columns != columns:
            raise ValueError(f"{f.path} has the columns {reads[f.path].columns}, other files of {f.table_name} have {columns}")

    def land(path: str, name: str) -> None:
        reads[path].write.mode("overwrite").parquet(rows_of(location, name, path))

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda f: land(f.path, f.table_name), fresh))
    lines = []
    for f in found:
        if f.status == REMOVED:
            lines.append((run, f.table_name, f.path, f.old_length, f.old_modified, f.old_checksum, f.old_columns, REMOVED))
        else:
            read = reads.get(f.path)
            status = f.status if read else TOUCHED
            columns = read.columns if read else f.old_columns
            lines.append((run, f.table_name, f.path, f.length, f.modified, checksum[f.path], columns, status))
    if not lines:
        return spark.createDataFrame([], LEDGER)
    spark.createDataFrame(lines, LEDGER).coalesce(1).write.mode("append").parquet(f"{location}/ledger")
    if drop_removed:
        for f in found:
            if f.status == REMOVED:
                delete(spark, rows_of(location, f.table_name, f.path))
    return read_ledger(spark, location).where(F.col("run") == run)


def plain(path: str) -> str:
    """Listing and reading differ in the slashes of local paths."""
    return path.replace("file:///", "file:/", 1)


def landed_tables(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """Every table that has a file, by name."""
    names = last_lines(read_ledger(spark, location)).select("table_name").distinct().collect()
    return {r.table_name: table(spark, location, r.table_name) for r in sorted(names)}
