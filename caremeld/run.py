"""From flat files to checked and reconciled layers: ``spark-submit caremeld/run.py <folder> [options]``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremeld.operators.relationships import read_relationships
from caremeld.plans import quality
from caremeld.plans.layers import Layers, build
from caremeld.plans.reconcile import reconciliation
from caremeld.plans.staging import VIEWS
from caremeld.session import intermediates
from caremeld.sources import incremental, landing, seeds
from caremeld.sources.tables import save_table


@dataclass(frozen=True)
class Outcome:
    """What a run leaves behind: the tables by name and the three reports."""

    tables: dict[str, DataFrame]
    landed: DataFrame  # with a line for every vocabulary whose rows could not all be used
    checks: DataFrame
    reconciliation: DataFrame


def run(
    spark: SparkSession,
    base: str,
    vocabularies: list[str] | None = None,
    concept_map: DataFrame | None = None,
    prefix: str = "",
    location: str | None = None,
    as_of_year: int | None = None,
    sources: list[landing.Source] = landing.SOURCES,
    kept: str | None = None,
    relationships: str | None = None,
) -> Outcome:
    """Lands the files below ``base``, builds every layer from the landed tables, and checks the result.

    ``vocabularies`` are concept extracts, merged in order; without any, codes resolve to 0. ``concept_map`` replaces the
    packaged map with a reviewed one (see ``seeds.load_seed``), ``sources`` the packaged list of sources. Tables go to the
    databases ``<prefix>raw``, ``vocab``, ``omop``, ``genomic`` and ``analytics``, below ``location`` where it is given; the
    three reports are tables of ``<prefix>reports``, evaluated once. A study without a mutation file is built from its API pages, or
    without variants; any other missing file that a model needs stops the run.

    With ``kept``, a folder that outlives the run, only files that are new or changed since the last run are landed there (see
    ``sources.incremental``); the report names each of them, and files that were removed lose their rows. With ``relationships``, a
    relationship extract, codes of non-standard concepts resolve to the standard ones they map to.
    """
    year = as_of_year or dt.date.today().year
    reports = f"{prefix}reports"
    if kept:
        changes = incremental.land_changes(spark, base, kept, sources, drop_removed=True)
        landed = changes.select("table_name", F.lit(None).cast("long").alias("n_rows"), "path", F.col("status").alias("note"))
    else:
        files = landing.discover_files(spark, base, sources)
        landed = landing.land_all(spark, files, f"{prefix}raw", location, sources=sources)

    extracts = [landing.read_vocabulary(spark, path) for path in vocabularies or []]
    merged = landing.merge_vocabularies(extracts) if extracts else landing.empty_vocabulary(spark)
    if extracts:
        unusable = landing.unusable_concepts(extracts).filter("n_rows > 0")
        paths = F.array(*[F.lit(path) for path in vocabularies])
        landed = landed.unionByName(
            unusable.select(
                F.lit("concept").alias("table_name"),
                "n_rows",
                paths[F.col("extract")].alias("path"),
                F.lit("vocabulary rows left out: no numeric id").alias("note"),
            )
        )
    landed = save_table(landed, reports, "landed", location)
    if kept:
        raw = landing.without_variants(spark, sources) | incremental.landed_tables(spark, kept)
    else:
        loaded = [r.table_name for r in landed.filter("table_name <> 'concept' and n_rows is not null").collect()]
        raw = {name: spark.table(f"{prefix}raw.{name}") for name in loaded}
    needed = sorted({table for table, _ in VIEWS.values()} - set(raw))
    if needed:
        raise FileNotFoundError(f"no file was found for {', '.join(needed)} below {base}")
    vocabulary = save_table(merged, f"{prefix}vocab", "concept", location, ["VOCABULARY_ID"])

    omop = f"{prefix}omop"
    seed_tables = {
        "concept_map": concept_map or seeds.concept_map(spark),
        "cdm_v54_tables": seeds.cdm_spec(spark),
        "cdm_scope": seeds.cdm_scope(spark),
    }
    stored = {name: save_table(df, omop, name, location) for name, df in seed_tables.items()}

    with intermediates(spark):
        links = read_relationships(spark, relationships) if relationships else None
        tables = build(Layers(raw, vocabulary, stored["concept_map"], year, relationships=links), prefix, location)
    checks = quality.validate(
        tables,
        stored["concept_map"],
        stored["cdm_v54_tables"],
        stored["cdm_scope"],
        quality.materialised_tables(spark, omop),
        year,
    )
    compared = reconciliation(raw, tables)
    return Outcome(
        tables, landed, save_table(checks, reports, "checks", location), save_table(compared, reports, "reconciliation", location)
    )


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Harmonise clinical files into checked, de-identified tables.")
    parser.add_argument("base", help="folder that holds one folder per source")
    parser.add_argument("--vocabulary", action="append", help="concept extract; may be given more than once")
    parser.add_argument("--concept-map", help="reviewed map as CSV, in place of the packaged one")
    parser.add_argument("--location", help="folder for the tables; the catalog's default without it")
    parser.add_argument("--prefix", default="", help="put before every database name")
    parser.add_argument("--relationships", help="concept relationship extract: follow non-standard codes to standard ones")
    parser.add_argument("--kept", help="folder of an earlier run's raw rows: land only files that changed since")
    parser.add_argument("--as-of-year", type=int, help="year that caps ages; the current one without it")
    parser.add_argument(
        "--source",
        action="append",
        help="name:kind:folder, kind synthetic or study, with :split where no cell holds a line break; may be given more "
        "than once, in place of the packaged list",
    )
    options = parser.parse_args(arguments)
    given = [s.split(":") for s in options.source or []]
    sources = [landing.Source(name, kind, folder, rest != ["split"]) for name, kind, folder, *rest in given]
    spark = SparkSession.builder.appName("caremeld").getOrCreate()
    reviewed = options.concept_map and seeds.load_seed(spark, options.concept_map, seeds.CONCEPT_MAP_SCHEMA)
    outcome = run(
        spark,
        options.base,
        options.vocabulary,
        reviewed or None,
        options.prefix,
        options.location,
        options.as_of_year,
        sources or landing.SOURCES,
        options.kept,
        options.relationships,
    )
    # One row per landed table, check or report line: these follow the number of files, not their size.
    for report in (outcome.landed, outcome.checks, outcome.reconciliation):
        for row in report.collect():
            print(*row, sep="\t")
    return 1 if outcome.checks.filter("status = 'ERROR'").count() else 0


if __name__ == "__main__":
    sys.exit(main())
