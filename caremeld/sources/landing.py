"""Flat files to all-string raw tables, one table per file, and vocabulary extracts to the concept list."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremeld.sources.tables import create_database
from caremeld.sources.variants import MAF_COLUMNS, read_mutation_pages


@dataclass(frozen=True)
class Source:
    """A source of files below one folder: ``synthetic`` keeps CSVs in ``csv/``, ``study`` has ``data_*.txt`` files.

    ``multi_line`` says that cells may hold line breaks inside quotes. Such a file is read by one task (files in parallel);
    without it files are split, and a row with too few or too many cells stops the run instead of shifting columns.
    """

    name: str
    kind: str
    folder: str
    multi_line: bool = True


# The sources and the study files that are expected of each study.
SOURCES = [
    Source("synthea", "synthetic", "synthea"),
    Source("metabric", "study", "metabric"),
    Source("tcga_brca", "study", "tcga_brca"),
]
STUDY_FILES = {
    "clinical": ["data_clinical_patient", "data_clinical_sample"],
    "genomic": ["data_mutations", "data_cna"],
}
CONCEPT_COLUMNS = [
    "concept_id",
    "concept_name",
    "domain_id",
    "vocabulary_id",
    "concept_class_id",
    "standard_concept",
    "concept_code",
]
# A study that ships no mutation file may have landed the same records as API pages.
PAGED_FILE = "data_mutations"
FILE_SCHEMA = "source string, table_name string, role string, path string, multi_line boolean, replaced array<string>"
LANDED_SCHEMA = "table_name string, n_rows long, path string, note string"


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_flat(spark: SparkSession, path: str, multi_line: bool = True, named: str | None = None) -> DataFrame:
    """A comma-separated ``.csv`` or tab-separated ``.txt`` file, or a folder of its parts, every column a string.

    Lines that start with ``#`` are skipped. Empty cells are empty strings and never NULL, and words such as ``NA`` stay
    words. Every part must have the same header, else reading fails. Cells may hold line breaks inside quotes unless
    ``multi_line`` is off; then large files are split between tasks and rows of another length fail. For one part of a
    folder, ``named`` is the folder, whose name says how cells are separated.
    """
    separator = "\t" if (named or path).rstrip("/").endswith(".txt") else ","
    read = spark.read.csv(
        path,
        sep=separator,
        header=True,
        comment="#",
        quote='"',
        escape='"',
        multiLine=multi_line,
        enforceSchema=False,
        mode="PERMISSIVE" if multi_line else "FAILFAST",
    )
    return read.na.fill("")


def discover_files(spark: SparkSession, base: str, sources: list[Source] = SOURCES) -> DataFrame:
    """One row per raw table to land: (source, table_name, role, path, multi_line, replaced).

    A table is a file or a folder of part files with the file's name; API pages (``data_mutations.json``, a file or a
    folder of pages) stand in for a study's mutation file. A clinical file is found by two patterns and listed once; where
    several files claim one table name, the last in load order wins (pages first, then clinical files, then by path) and
    ``replaced`` names the others.
    """
    found = []
    for source in sources:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        synthetic = source.kind == "synthetic"
        pattern = (
            r"^(.*/csv/([^/]+)\.csv)(/[^/]+)?$"
            if synthetic
            else rf"^(.*/(data_[^/]*)\.txt|.*/({PAGED_FILE})\.jsonl?)(/[^/]+)?$"
        )
        folder = f"{base}/{source.folder}" + ("/csv" if synthetic else "")
        try:
            paths = files.load(folder).select("path")
        except AnalysisException as error:
            if is_missing(error):
                continue
            raise
        stem = F.regexp_extract("path", pattern, 2)
        stem = stem if synthetic else F.concat(stem, F.regexp_extract("path", pattern, 3))
        clinical = F.lit(synthetic) | stem.startswith("data_clinical_")
        found.append(
            paths.filter(stem != "").select(
                F.lit(source.name).alias("source"),
                F.concat_ws("__", F.lit(source.name), stem).alias("table_name"),
                F.when(clinical, "clinical").otherwise("genomic").alias("role"),
                F.regexp_extract("path", pattern, 1).alias("path"),
                F.lit(source.multi_line).alias("multi_line"),
            )
        )
    if not found:
        return spark.createDataFrame([], FILE_SCHEMA)
    order = F.struct(~F.col("path").rlike(r"\.jsonl?$"), F.col("role") == "genomic", "path", "role", "multi_line")
    tables = (
        reduce(DataFrame.unionByName, found)
        .groupBy("source", "table_name")
        .agg(F.max(order).alias("last"), F.collect_set("path").alias("paths"))
    )
    others = F.array_sort(F.array_except("paths", F.array("last.path")))
    return tables.select("source", "table_name", "last.role", "last.path", "last.multi_line", others.alias("replaced"))


def manifest(spark: SparkSession, files: DataFrame, sources: list[Source] = SOURCES) -> DataFrame:
    """The study files that are expected, each with whether it was found."""
    studies = [s.name for s in sources if s.kind == "study"]
    expected = spark.createDataFrame(
        [(s, role, stem, f"{s}__{stem}") for s in studies for role, stems in STUDY_FILES.items() for stem in stems],
        "source string, role string, file_stem string, table_name string",
    )
    present = files.select("table_name", F.lit(True).alias("found"))
    return expected.join(present, "table_name", "left").select(
        "source", "role", "file_stem", "table_name", F.coalesce("found", F.lit(False)).alias("found")
    )


def read_landed(spark: SparkSession, path: str, multi_line: bool, named: str | None = None) -> DataFrame:
    """A flat file, or API pages: ``.json`` holds a page per file, ``.jsonl`` a page per line. ``named`` as in ``read_flat``."""
    table = named or path
    if table.endswith((".json", ".jsonl")):
        return read_mutation_pages(spark, path, page_per_file=table.endswith(".json"))
    return read_flat(spark, path, multi_line, table)


def land_all(
    spark: SparkSession,
    files: DataFrame,
    database: str,
    location: str | None = None,
    threads: int = 4,
    sources: list[Source] = SOURCES,
) -> DataFrame:
    """Lands every discovered file as ``<database>.<source>__<stem>``; returns (table_name, n_rows, path, note).

    The note says what came from API pages, which same-named files were not landed, and which expected study files are
    missing. A missing mutation file becomes an empty table of its declared columns. Tables that an earlier run left in
    the database and this one doesn't land are not listed. Only the list of files is collected, one short row per table.
    """
    create_database(spark, database, location)
    listed = sorted(files.collect(), key=lambda f: f.table_name)

    def land(file: Row) -> None:
        read = read_landed(spark, file.path, file.multi_line)
        read.write.mode("overwrite").saveAsTable(f"{database}.{file.table_name}", format="parquet")

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(land, listed))
    notes = {}
    for file in listed:
        said = ["from API pages"] if file.path.endswith((".json", ".jsonl")) else []
        said += [f"not landed, same name: {', '.join(file.replaced)}"] if file.replaced else []
        notes[file.table_name] = (file.path, "; ".join(said))
    absent = []
    for file in manifest(spark, files, sources).filter("not found").collect():
        if file.file_stem == PAGED_FILE:
            empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in MAF_COLUMNS]))
            empty.write.mode("overwrite").saveAsTable(f"{database}.{file.table_name}", format="parquet")
            notes[file.table_name] = (None, "missing: no file and no API pages; landed as an empty table")
        else:
            absent.append((file.table_name, None, None, "missing: not landed"))
    counted = [
        spark.table(f"{database}.{table}")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(table).alias("table_name"), "n_rows", F.lit(path).cast("string").alias("path"), F.lit(note).alias("note"))
        for table, (path, note) in sorted(notes.items())
    ]
    return reduce(DataFrame.unionByName, [*counted, spark.createDataFrame(sorted(absent), LANDED_SCHEMA)])


def without_variants(spark: SparkSession, sources: list[Source] = SOURCES) -> dict[str, DataFrame]:
    """The mutation table of every study as it is when neither a file nor API pages were found."""
    empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in MAF_COLUMNS]))
    return {f"{s.name}__{PAGED_FILE}": empty for s in sources if s.kind == "study"}


def empty_vocabulary(spark: SparkSession) -> DataFrame:
    columns = [T.StructField(c.upper(), T.StringType()) for c in CONCEPT_COLUMNS]
    columns[0] = T.StructField("CONCEPT_ID", T.LongType())
    return spark.createDataFrame([], T.StructType(columns))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The concept list of one extract: seven of its tab-separated columns, quotes taken literally.

    Ids become numbers here, once, so that no join or union meets a text id. A path that does not exist is an error.
    """
    extract = spark.read.csv(path, sep="\t", header=True, quote="")
    named = extract.select(*[F.col(c).alias(c.upper()) for c in CONCEPT_COLUMNS]).na.fill("")
    return named.withColumn("CONCEPT_ID", F.col("CONCEPT_ID").try_cast("long"))


def merge_vocabularies(extracts: list[DataFrame]) -> DataFrame:
    """Several extracts as one list with each concept id once; the earlier extract wins.

    Kept as an aggregation, so that every task reduces its own rows before the shuffle. Rows without a numeric id are
    left out: a code can only resolve to 0 through them (``unusable_concepts`` counts them).
    """
    columns = [c.upper() for c in CONCEPT_COLUMNS]
    ranked = [e.select(F.lit(rank).alias("_rank"), *columns) for rank, e in enumerate(extracts)]
    rest = F.min(F.struct("_rank", *columns[1:])).alias("_first")
    numbered = reduce(DataFrame.unionByName, ranked).filter(F.col("CONCEPT_ID").isNotNull())
    first = numbered.groupBy("CONCEPT_ID").agg(rest)
    return first.select("CONCEPT_ID", *[F.col(f"_first.{c}").alias(c) for c in columns[1:]])


def unusable_concepts(extracts: list[DataFrame]) -> DataFrame:
    """(extract, n_rows): rows without a numeric id in each extract, in order."""
    return reduce(
        DataFrame.unionByName,
        [e.agg(F.count_if(F.col("CONCEPT_ID").isNull()).alias("n_rows")).select(F.lit(i).alias("extract"), "n_rows") for i, e in enumerate(extracts)],
    )


def write_vocabulary(vocabulary: DataFrame, path: str) -> DataFrame:
    """Stores the list in one folder per vocabulary, so that resolving one vocabulary's codes reads only its folder."""
    vocabulary.write.mode("overwrite").partitionBy("VOCABULARY_ID").parquet(path)
    return vocabulary.sparkSession.read.schema(vocabulary.schema).parquet(path).select(*vocabulary.columns)
