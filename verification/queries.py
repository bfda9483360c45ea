"""One entry per operator: a Spark result over the whole test tables and, where SQL can say it, the same in DuckDB."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremeld.functions.casts import date_or_null, number_or_null
from caremeld.operators import checks
from caremeld.operators import concepts as C
from caremeld.operators.surrogate import assign_surrogate_id
from caremeld.operators.unpivot import clinical_observations, tumour_measurements
from caremeld.plans import anonymity, clinical, conformance, deid, limited, quality, reconcile, trend
from caremeld.plans.layers import ANALYTICS, CLINICAL, GENOMIC, PROJECTED, Layers, build
from caremeld.plans.staging import VIEWS
from caremeld import session
from caremeld.session import new_path
from caremeld.sources import incremental, landing, seeds, tables, variants
from caremeld.streaming import validation
from verification.oracle import AS_OF_YEAR, anonymity_sql, arrivals_sql, conformance_sql, date, lines_sql, number, report_sql, statement, trend_sql, whole
from verification.projection import RAW_SQL, TEST_TABLES, RawTables, oracle_raw, raw_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which both engines print alike."""
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if f.dataType == T.DateType() else f.name for f in df.schema]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: dates_as_text(make(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return make

    return register


def layers(spark: SparkSession, sf_dir: str, lines: str | None = None) -> Layers:
    raw = RawTables(spark, sf_dir, lines)
    return Layers(raw, raw.vocabulary(), seeds.concept_map(spark), AS_OF_YEAR)


def written(models: Layers, names: list[str]) -> dict[str, DataFrame]:
    """Some models as tables in a database of their own."""
    base = new_path(models.vocabulary.sparkSession, "tables")
    database = "part_" + base.rsplit("-", 1)[-1][:12]
    return {name: tables.save_table(models.table(name), database, name, base) for name in names}


def built(spark: SparkSession, sf_dir: str) -> tuple[Layers, dict[str, DataFrame], dict[str, str]]:
    """All layers, written below a folder of their own; also layer -> database."""
    models = layers(spark, sf_dir, new_path(spark, "lines"))
    location = new_path(spark, "layers")
    prefix = f"run_{os.path.basename(location).rsplit('-', 1)[-1][:12]}_"
    return models, build(models, prefix, location), {layer: f"{prefix}{layer}" for layer in ("omop", "genomic", "analytics")}


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- Landing -------------------------------------------------------------------------------------------------------


def write_flat(df: DataFrame, path: str) -> None:
    """A raw table as a flat file the way its source ships it: CSV, or tab-separated text."""
    separator = "\t" if path.endswith(".txt") else ","
    df.write.csv(
        path,
        sep=separator,
        header=True,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def flat_path(base: str, name: str) -> str:
    source, stem = name.split("__")
    return f"{base}/synthea/csv/{stem}.csv" if source == "synthea" else f"{base}/{source}/study/{stem}.txt"


def landing_zone(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> str:
    base = new_path(spark, "landing")
    for name in names or [n for n in RAW_SQL if not n.startswith("vocab__")]:
        write_flat(raw_table(spark, sf_dir, name), flat_path(base, name))
    return base


@query(
    "land_csv",
    "select cast(doc_id as varchar) as doc_id, coalesce(text, '') as text, coalesce(lang, '') as lang, "
    "coalesce(source, '') as source, coalesce(cast(n_chars as varchar), '') as n_chars from documents",
)
def land_csv(spark, sf_dir):
    """All documents as a CSV: most of their texts hold line breaks, many commas and quotes."""
    path = new_path(spark, "documents") + ".csv"
    write_flat(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return landing.read_flat(spark, path)


@query("land_tsv_commented", whole("metabric__data_clinical_sample"))
def land_tsv_commented(spark, sf_dir):
    """Each part file starts with comment lines, as the published study files do."""
    path = new_path(spark, "commented") + ".txt"
    sample = raw_table(spark, sf_dir, "metabric__data_clinical_sample")
    line = F.concat_ws("\t", *sample.columns)
    body = sample.select(line.alias("value"), F.spark_partition_id().alias("_file"))
    head = body.select("_file").distinct().select(
        F.explode(F.array(F.lit("#Patient\tSample"), F.lit("#STRING\tSTRING"), F.lit("\t".join(sample.columns)))).alias(
            "value"
        ),
        "_file",
    )
    top = head.withColumn("_rank", F.lit(0)).unionByName(body.withColumn("_rank", F.lit(1)))
    order = F.when(F.col("value").startswith("#"), 0).when(F.col("_rank") == 0, 1).otherwise(2)
    files = top.repartition("_file").sortWithinPartitions("_file", order)
    files.select("value").write.text(path)
    return landing.read_flat(spark, path)


FILES_SQL = "\nunion all ".join(
    f"select '{n.split('__')[0]}' as source, '{n}' as table_name, "
    f"'{'genomic' if n.endswith('mutations') else 'clinical'}' as role, count(*) as n_rows from ({oracle_raw(n)})"
    for n in RAW_SQL
    if not n.startswith("vocab__")
)


def rows_found(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(table_name, n_rows) of listed files; there is one short row for each."""
    counted = [
        landing.read_flat(spark, f.path, f.multi_line).agg(F.count("*").alias("n_rows")).select(F.lit(f.table_name).alias("table_name"), "n_rows")
        for f in files.collect()
    ]
    return union(counted)


@query("discover_files", FILES_SQL)
def discover_files(spark, sf_dir):
    """The files found, each with the rows that reading it gives."""
    files = landing.discover_files(spark, landing_zone(spark, sf_dir))
    return files.select("source", "table_name", "role").join(rows_found(spark, files), "table_name")


@query(
    "manifest",
    "select s as source, role, stem as file_stem, s || '__' || stem as table_name, n is not null as found, n as n_rows from "
    "(values ('metabric'), ('tcga_brca')) a(s), (values ('clinical', 'data_clinical_patient'), "
    "('clinical', 'data_clinical_sample'), ('genomic', 'data_mutations'), ('genomic', 'data_cna')) b(role, stem) "
    f"left join (select table_name as t, n_rows as n from ({FILES_SQL})) f on f.t = s || '__' || stem",
)
def manifest(spark, sf_dir):
    """The expected study files, with the rows of those that are there."""
    files = landing.discover_files(spark, landing_zone(spark, sf_dir))
    return landing.manifest(spark, files).join(rows_found(spark, files), "table_name", "left")


@query(
    "land_all",
    "\nunion all ".join(
        [f"select '{n}' as table_name, count(*) as n_rows, '' as note from ({oracle_raw(n)})" for n in RAW_SQL if not n.startswith("vocab__")]
        + [f"select '{s}__data_cna', null, 'missing: not landed'" for s in ("metabric", "tcga_brca")]
    ),
)
def land_all(spark, sf_dir):
    base = landing_zone(spark, sf_dir)
    database = "raw_" + base.rsplit("-", 1)[-1][:12]
    return landing.land_all(spark, landing.discover_files(spark, base), database, base).drop("path")


@query("write_overwrite", whole("synthea__encounters"))
def write_overwrite(spark, sf_dir):
    """Written twice: the second write replaces the first."""
    base = new_path(spark, "tables")
    database = "raw_" + base.rsplit("-", 1)[-1][:12]
    for name in ("synthea__patients", "synthea__encounters"):
        tables.write_overwrite(raw_table(spark, sf_dir, name), database, "encounters", base)
    return spark.table(f"{database}.encounters")


CONCEPT_SQL = """select try_cast(CONCEPT_ID as bigint) as CONCEPT_ID, CONCEPT_NAME, DOMAIN_ID, VOCABULARY_ID,
    CONCEPT_CLASS_ID, STANDARD_CONCEPT, CONCEPT_CODE from vocab__concept"""


def vocabulary_file(spark: SparkSession, concepts: DataFrame) -> str:
    """A published extract: tab-separated, lower-case header, more columns than are used."""
    path = new_path(spark, "extract")
    extract = concepts.toDF(*[c.lower() for c in concepts.columns]).withColumn("valid_start_date", F.lit("19700101"))
    extract.write.csv(path, sep="\t", header=True, quote="", emptyValue="")
    return path


@query("land_vocabulary", statement(CONCEPT_SQL))
def land_vocabulary(spark, sf_dir):
    path = vocabulary_file(spark, raw_table(spark, sf_dir, "vocab__concept"))
    return landing.write_vocabulary(landing.read_vocabulary(spark, path), new_path(spark, "vocabulary"))


@query("merge_vocabulary_bundles", statement(CONCEPT_SQL))
def merge_vocabulary_bundles(spark, sf_dir):
    """Three bundles: each holds the one vocabulary it was requested for, and all of them hold SNOMED again."""
    concepts = raw_table(spark, sf_dir, "vocab__concept")
    bundles = [concepts.filter(F.col("VOCABULARY_ID").isin("SNOMED", v)) for v in ("SNOMED", "LOINC", "RxNorm")]
    return landing.merge_vocabularies([landing.read_vocabulary(spark, vocabulary_file(spark, b)) for b in bundles])


MAF_SQL = (
    "select "
    + ", ".join(
        f"coalesce({c}, '') as {c}"
        if c in ("Hugo_Symbol", "Entrez_Gene_Id", "Chromosome", "Start_Position", "Variant_Classification",
                 "Variant_Type", "HGVSp_Short", "Tumor_Sample_Barcode")
        else f"'' as {c}"
        for c in variants.MAF_COLUMNS
    )
    + " from tcga_brca__data_mutations"
)


@query("api_pages_to_maf", statement(MAF_SQL))
def api_pages_to_maf(spark, sf_dir):
    """A study that has only API pages: 10,000 records each as the API nests them, numbers as JSON numbers, absent fields
    left out, a page per line. They are found and landed in place of the mutation file."""
    calls = raw_table(spark, sf_dir, "tcga_brca__data_mutations")
    numeric = ("Entrez_Gene_Id", "Start_Position")
    fields = [
        (F.col(c).cast("long") if c in numeric else F.col(c)).alias(f)
        for c, f in variants.RECORD_FIELDS.items()
        if c in calls.columns
    ]
    base = new_path(spark, "pages")
    record = F.to_json(F.struct(F.struct(F.col("Hugo_Symbol").alias("hugoGeneSymbol")).alias("gene"), *fields))
    numbered = calls.select(record.alias("record"), F.monotonically_increasing_id().alias("_row"))
    pages = numbered.groupBy(F.floor(F.col("_row") / 10_000)).agg(F.concat_ws(",", F.collect_list("record")).alias("all"))
    pages.select(F.concat(F.lit("["), "all", F.lit("]")).alias("value")).write.text(f"{base}/tcga_brca/data_mutations.jsonl")
    database = "raw_" + base.rsplit("-", 1)[-1][:12]
    landing.land_all(spark, landing.discover_files(spark, base), database, base)
    return spark.table(f"{database}.tcga_brca__data_mutations")


SEED_SQL = """select p_type as source_value, nullif(p_brand, 'Brand#11') as target_vocabulary, p_partkey as concept_id
    from part"""


@query("load_seed", SEED_SQL)
def load_seed(spark, sf_dir):
    """A reviewed file with one forced number column, written from the parts."""
    path = new_path(spark, "seed")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    rows = part.select(
        F.col("p_type").alias("source_value"),
        F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("target_vocabulary"),
        F.col("p_partkey").alias("concept_id"),
    )
    rows.write.csv(path, header=True, escape='"')
    return seeds.load_seed(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]))


@query(
    "mutations_raw",
    statement("select 'metabric' as source, * from metabric_mutations union all by name "
              "select 'tcga_brca' as source, * from tcga_brca_mutations"),
)
def mutations_raw(spark, sf_dir):
    models = layers(spark, sf_dir)
    return union(
        [models.table(f"{s}_mutations").select(F.lit(s).alias("source"), "*") for s in ("metabric", "tcga_brca")]
    )


@query(
    "raw_passthrough",
    statement("select 'metabric' as source, * from metabric_mutations union all by name "
              "select 'tcga_brca' as source, * from tcga_brca_mutations"),
)
def raw_passthrough(spark, sf_dir):
    """The raw tables of both studies as written to the genomic layer."""
    kept = written(layers(spark, sf_dir), ["metabric_mutations", "tcga_brca_mutations"])
    return union([df.select(F.lit(name.removesuffix("_mutations")).alias("source"), "*") for name, df in kept.items()])


@query("materialise_layer", whole("death", ("death_date",)))
def materialise_layer(spark, sf_dir):
    """A staging view and a clinical table over it, read back by name."""
    models = layers(spark, sf_dir)
    base = new_path(spark, "omop")
    run = base.rsplit("-", 1)[-1][:12]
    models.staging("stg_synthea_patients").createOrReplaceTempView(f"stg_synthea_patients_{run}")
    dead = clinical.death(spark.table(f"stg_synthea_patients_{run}"), models.person)
    tables.write_overwrite(dead, f"omop_{run}", "death", base)
    return spark.table(f"omop_{run}.death")


# ---- Staging -------------------------------------------------------------------------------------------------------

STAGING_DATES = {
    "stg_synthea_patients": ("birth_date", "death_date"),
    "stg_synthea_conditions": ("condition_start_date",),
    "stg_synthea_encounters": ("visit_start_date", "visit_end_date"),
    "stg_synthea_medications": ("drug_exposure_start_date", "drug_exposure_end_date"),
    "stg_synthea_observations": ("measurement_date",),
    "stg_synthea_procedures": ("procedure_date",),
}
for _view, (_raw, _project) in VIEWS.items():

    @query(_view, whole(_view, STAGING_DATES.get(_view, ())))
    def _staging(spark, sf_dir, raw=_raw, project=_project):
        return project(raw_table(spark, sf_dir, raw))


EDGE_TEXT = """
    select l_orderkey, l_linenumber, case (l_orderkey + l_linenumber) % 14
        when 0 then '' when 1 then 'NA' when 2 then cast(l_quantity as string) || 'd'
        when 3 then ' ' || cast(l_quantity as string) || ' ' when 4 then '+' || cast(l_quantity as string)
        when 5 then cast(l_partkey as string) || 'e1' when 6 then '.' || cast(l_partkey as string)
        when 7 then cast(cast(l_shipdate as date) as string)
        when 8 then cast(cast(l_shipdate as date) as string) || 'T08:30:00Z'
        when 9 then cast(cast(l_shipdate as date) as string) || ' 08:30:00'
        when 10 then substr(cast(cast(l_shipdate as date) as string), 1, 4)
        when 11 then substr(cast(cast(l_shipdate as date) as string), 1, 4) || '-13-01'
        when 12 then replace(cast(cast(l_shipdate as date) as string), '-', '/')
        else '-' || cast(l_extendedprice as string) end as raw_text
    from {lineitem}
"""


@query(
    "scalar_try_casts",
    f"select *, cast({date('raw_text')} as varchar) as as_date, {number('raw_text')} as as_number "
    f"from ({EDGE_TEXT.format(lineitem='lineitem')})",
)
def scalar_try_casts(spark, sf_dir):
    text = spark.sql(EDGE_TEXT, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return text.select("*", date_or_null("raw_text").alias("as_date"), number_or_null("raw_text").alias("as_number"))


# ---- Concept resolution --------------------------------------------------------------------------------------------

CODED = [
    ("condition", "stg_synthea_conditions", "SNOMED", "snomed_code", "conditions_coded", "condition_concept_id"),
    ("procedure", "stg_synthea_procedures", "SNOMED", "snomed_code", "procedures_coded", "procedure_concept_id"),
    ("drug", "stg_synthea_medications", "RxNorm", "rxnorm_code", "drugs_coded", "drug_concept_id"),
]


@query(
    "code_resolve_standard",
    statement(
        "\nunion all ".join(
            f"select '{d}' as domain, person_source_value, {code} as source_code, {concept} as concept_id from {part}"
            for d, _, _, code, part, concept in CODED
        )
    ),
)
def code_resolve_standard(spark, sf_dir):
    """Three domains in two vocabularies; codes that are absent or not standard are 0."""
    models = layers(spark, sf_dir)
    return union(
        [
            C.resolve_code(models.staging(view), models.codes(vocabulary_id), code, "concept_id").select(
                F.lit(domain).alias("domain"), "person_source_value", F.col(code).alias("source_code"), "concept_id"
            )
            for domain, view, vocabulary_id, code, _, _ in CODED
        ]
    )


@query("code_resolve_any", whole("results_coded", ("measurement_date",)))
def code_resolve_any(spark, sf_dir):
    models = layers(spark, sf_dir)
    loinc = models.codes("LOINC", standard_only=False)
    return C.resolve_code(models.staging("stg_synthea_observations"), loinc, "loinc_code", "measurement_concept_id")


def people(models: Layers) -> DataFrame:
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            models.staging("stg_synthea_patients").drop("death_date").withColumn("source", F.lit("synthea")),
            models.staging("stg_metabric_patient").select(
                "person_source_value", "gender_source_value", F.lit("metabric").alias("source")
            ),
            models.staging("stg_tcga_patient").select(
                "person_source_value", "gender_source_value", F.lit("tcga_brca").alias("source")
            ),
        ],
    )


@query("union_all_shapes", whole("people", ("birth_date",)))
def union_all_shapes(spark, sf_dir):
    """Three sources with different columns in one shape, by name."""
    return people(layers(spark, sf_dir))


def _person_value(word: str, field: str | None) -> None:
    column, concept = f"{word}_source_value", f"{word}_concept_id"

    @query(f"value_map_{word}", statement(f"select source, person_source_value, {column}, {concept} from people_mapped"))
    def resolve(spark, sf_dir):
        models = layers(spark, sf_dir)
        lookup = C.field_values(models.concept_map, field) if field else C.gender_values(models.concept_map)
        resolved = C.resolve_value(people(models), lookup, {column: "source_value"}, concept, default=0)
        return resolved.select("source", "person_source_value", column, concept)


_person_value("gender", None)
_person_value("race", "patients.RACE")
_person_value("ethnicity", "patients.ETHNICITY")


@query(
    "distinct_value_map",
    statement("select distinct source, gender_source_value, gender_concept_id from people_mapped"),
)
def distinct_value_map(spark, sf_dir):
    """The gender map in use: each word of each source once, with the concept it leads to."""
    models = layers(spark, sf_dir)
    words = people(models).select("source", "gender_source_value").distinct()
    return C.resolve_value(
        words, C.gender_values(models.concept_map), {"gender_source_value": "source_value"}, "gender_concept_id", default=0
    )


@query("value_map_histology", whole("diagnoses_coded"))
def value_map_histology(spark, sf_dir):
    models = layers(spark, sf_dir)
    columns = ["person_source_value", "sample_id", "cancer_type_detailed"]
    samples = union(
        [
            models.staging(view).select(F.lit(source).alias("source"), *columns)
            for source, view in (("metabric", "stg_metabric_sample"), ("tcga_brca", "stg_tcga_sample"))
        ]
    )
    return C.resolve_value(
        samples,
        C.histology_values(models.concept_map),
        {"source": "source", "cancer_type_detailed": "source_value"},
        "condition_concept_id",
        default=0,
    )


TUMOUR = "select person_source_value, source_field, {} from tumour_coded"


@query("value_map_measurement", statement(TUMOUR.format("value_txt, value_as_concept_id")))
def value_map_measurement(spark, sf_dir):
    models = layers(spark, sf_dir)
    results = clinical.tumour_results(models.staging("stg_metabric_sample"), models.concept_map)
    return results.select("person_source_value", "source_field", "value_txt", "value_as_concept_id")


@query("unit_map_measurement", statement(TUMOUR.format("value_num, unit, unit_concept_id")))
def unit_map_measurement(spark, sf_dir):
    models = layers(spark, sf_dir)
    results = clinical.tumour_results(models.staging("stg_metabric_sample"), models.concept_map)
    return results.select("person_source_value", "source_field", "value_num", "unit", "unit_concept_id")


def observed(models: Layers) -> DataFrame:
    return clinical_observations(
        models.staging("stg_metabric_patient"), models.staging("stg_metabric_sample"), models.staging("stg_tcga_patient")
    )


OBSERVED = "select source, source_field, person_source_value, {} from observed_coded"
BY_FIELD = {"source": "source", "source_field": "source_field"}


@query("concept_map_observation", statement(OBSERVED.format("observation_concept_id")))
def concept_map_observation(spark, sf_dir):
    models = layers(spark, sf_dir)
    rows = C.resolve_value(
        observed(models), C.observed_fields(models.concept_map), BY_FIELD, "observation_concept_id", default=0
    )
    return rows.select("source", "source_field", "person_source_value", "observation_concept_id")


@query("unit_map_observation", statement(OBSERVED.format("value_num, unit_concept_id")))
def unit_map_observation(spark, sf_dir):
    models = layers(spark, sf_dir)
    rows = C.resolve_value(observed(models), C.observation_units(models.concept_map), BY_FIELD, "unit_concept_id")
    return rows.select("source", "source_field", "person_source_value", "value_num", "unit_concept_id")


@query("value_map_observation", statement(OBSERVED.format("value_txt, value_as_concept_id")))
def value_map_observation(spark, sf_dir):
    models = layers(spark, sf_dir)
    answers = C.answer_values(models.concept_map, "observation")
    rows = C.resolve_value(observed(models), answers, {**BY_FIELD, "value_txt": "source_value"}, "value_as_concept_id")
    return rows.select("source", "source_field", "person_source_value", "value_txt", "value_as_concept_id")


@query(
    "visit_class_map", statement("select visit_source_value, encounter_class, visit_concept_id from visit_classes")
)
def visit_class_map(spark, sf_dir):
    visits = layers(spark, sf_dir).staging("stg_synthea_encounters")
    return visits.select(
        "visit_source_value", "encounter_class", C.visit_concept("encounter_class").alias("visit_concept_id")
    )


SOURCE_WORDS = """select source, source_field, value_txt from observed where value_txt is not null
    union all select 'metabric', source_field, value_txt from tumour_attributes where value_txt is not null
    union all select source, 'data_clinical_sample.CANCER_TYPE_DETAILED', cancer_type_detailed from diagnoses_coded
    union all select 'metabric', 'data_clinical_patient.OS_STATUS', regexp_replace(os_status, '^[01]:', '')
        from stg_metabric_patient"""


@query(
    "review_gate",
    statement(
        f"""select w.source, w.source_field, m.omop_table, m.review_status, count(*) as n_rows,
            count(*) filter (where m.review_status = 'STANDARD' and m.concept_id is not null) as n_resolved
        from ({SOURCE_WORDS}) w left join concept_map m
            on m.source = w.source and m.source_field = w.source_field and m.source_value = w.value_txt
        group by all"""
    ),
)
def review_gate(spark, sf_dir):
    """Source words by the review status of their map row; only signed-off rows resolve.

    Words are counted before they meet the map, so a word that most rows carry is joined once.
    """
    models = layers(spark, sf_dir)
    shape = ["source", "source_field", "value_txt"]
    outcome = F.regexp_replace("os_status", "^[01]:", "")
    histology = F.lit("data_clinical_sample.CANCER_TYPE_DETAILED").alias("source_field")
    words = union(
        [
            observed(models).select(*shape),
            tumour_measurements(models.staging("stg_metabric_sample")).select(*shape),
            models.staging("stg_metabric_patient").select(
                F.lit("metabric").alias("source"),
                F.lit("data_clinical_patient.OS_STATUS").alias("source_field"),
                outcome.alias("value_txt"),
            ),
            *[
                models.staging(view).select(
                    F.lit(source).alias("source"), histology, F.col("cancer_type_detailed").alias("value_txt")
                )
                for source, view in (("metabric", "stg_metabric_sample"), ("tcga_brca", "stg_tcga_sample"))
            ],
        ]
    ).filter(F.col("value_txt").isNotNull())
    counted = words.groupBy(*shape).agg(F.count("*").alias("n"))
    rows = models.concept_map.withColumnRenamed("source_value", "value_txt")
    acts = (F.col("review_status") == "STANDARD") & F.col("concept_id").isNotNull()
    return (
        counted.join(rows, shape, "left")
        .groupBy("source", "source_field", "omop_table", "review_status")
        .agg(F.sum("n").alias("n_rows"), F.sum(F.when(acts, F.col("n")).otherwise(0)).alias("n_resolved"))
    )


# ---- Clinical, genomic and de-identified models --------------------------------------------------------------------

MODEL_DATES = {
    "person": ("birth_datetime",),
    "visit_occurrence": ("visit_start_date", "visit_end_date"),
    "condition_occurrence": ("condition_start_date",),
    "drug_exposure": ("drug_exposure_start_date", "drug_exposure_end_date"),
    "procedure_occurrence": ("procedure_date",),
    "measurement": ("measurement_date",),
    "observation": ("observation_date",),
    "observation_period": ("observation_period_start_date", "observation_period_end_date"),
    "death": ("death_date",),
}
for _model in [*CLINICAL, "sample_person", *ANALYTICS]:

    @query(_model, whole(_model, MODEL_DATES.get(_model, ())))
    def _table(spark, sf_dir, name=_model):
        return layers(spark, sf_dir).table(name)


@query("unpivot_measurements", whole("tumour_attributes"))
def unpivot_measurements(spark, sf_dir):
    return tumour_measurements(layers(spark, sf_dir).staging("stg_metabric_sample")).drop("source")


@query("unpivot_observations", whole("observed"))
def unpivot_observations(spark, sf_dir):
    return observed(layers(spark, sf_dir))


@query(
    "surrogate_id",
    "select row_number() over (order by l_shipdate, l_orderkey, l_linenumber) as line_id, l_orderkey, l_linenumber "
    "from lineitem",
)
def surrogate_id(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")
    return assign_surrogate_id(lines, "line_id", ["l_shipdate"], drop=("l_shipdate",))


@query(
    "surrogate_id_copies",
    "select row_number() over (order by l_returnflag, l_linestatus) as line_id, l_returnflag, l_linestatus from lineitem",
)
def surrogate_id_copies(spark, sf_dir):
    """Six groups of equal rows: the numbering still spreads each of them over many tasks."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_linestatus")
    return assign_surrogate_id(lines, "line_id", ["l_returnflag", "l_linestatus"])


# ---- Aggregations and reports --------------------------------------------------------------------------------------


DATED = {
    "stg_synthea_encounters": ("visit_start_date", "visit_end_date"),
    "stg_synthea_conditions": ("condition_start_date",),
    "stg_synthea_observations": ("measurement_date",),
    "stg_synthea_medications": ("drug_exposure_start_date", "drug_exposure_end_date"),
    "stg_synthea_procedures": ("procedure_date",),
}


@query(
    "event_span",
    statement(
        "select person_source_value, cast(min(d) as varchar) as first_date, cast(max(d) as varchar) as last_date from ("
        + " union all ".join(f"select person_source_value, {d} as d from {t}" for t, dates in DATED.items() for d in dates)
        + ") where d is not null group by 1"
    ),
)
def event_span(spark, sf_dir):
    """All five event tables, per patient id, known or not."""
    models, key = layers(spark, sf_dir), "person_source_value"
    both = {view: (dates[0], dates[-1]) for view, dates in DATED.items()}
    streams = [models.staging(view).select(key, F.least(*d), F.greatest(*d)) for view, d in both.items()]
    return clinical.event_span(streams, key)


@query(
    "distinct_counts_per_patient",
    statement(
        "select p.person_source_value, count(distinct m.rxnorm_code) as distinct_drugs, "
        "count(distinct r.snomed_code) as distinct_procedures from stg_synthea_patients p "
        "left join stg_synthea_medications m using (person_source_value) "
        "left join stg_synthea_procedures r on r.person_source_value = p.person_source_value group by 1"
    ),
)
def distinct_counts_per_patient(spark, sf_dir):
    models = layers(spark, sf_dir)
    return deid.distinct_counts(
        models.staging("stg_synthea_patients"),
        "person_source_value",
        [
            (models.staging("stg_synthea_medications"), "rxnorm_code", "distinct_drugs"),
            (models.staging("stg_synthea_procedures"), "snomed_code", "distinct_procedures"),
        ],
    )


RAW_PATIENTS_SQL = """select 'synthea' as source, count(distinct Id) as n from synthea__patients
    union all select 'metabric', count(distinct PATIENT_ID) from metabric__data_clinical_patient
    union all select 'tcga_brca', count(distinct PATIENT_ID) from tcga_brca__data_clinical_patient"""


@query("raw_distinct_patients", statement(RAW_PATIENTS_SQL))
def raw_distinct_patients(spark, sf_dir):
    return reconcile.raw_patients(RawTables(spark, sf_dir))


MAPPED_CONCEPTS = {
    "condition_occurrence": "condition_concept_id",
    "observation": "observation_concept_id",
    "drug_exposure": "drug_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "measurement": "measurement_concept_id",
}


@query(
    "conditional_counts",
    statement(
        "\nunion all ".join(
            f"select '{t}{suffix}' as name, count(*) as n from {t} where {condition}"
            for t, concept in MAPPED_CONCEPTS.items()
            for suffix, condition in (("", "true"), (" mapped", f"{concept} <> 0"), (" unmapped", f"{concept} = 0"))
        )
    ),
)
def conditional_counts(spark, sf_dir):
    """Every mapped table as it was written."""
    return reconcile.row_counts(written(layers(spark, sf_dir), list(MAPPED_CONCEPTS)))


@query(
    "scalar_count_delta",
    f"select item, source_count, modeled_count, delta from ({statement(lines_sql('deid', 'ohdsi'))}) where source_count is not null",
)
def scalar_count_delta(spark, sf_dir):
    """Every line that is the difference of two counts, over the layers as written."""
    counted = reconcile.section(built(spark, sf_dir)[1], [*reconcile.DEID_LINES, *reconcile.PERIOD_LINES])
    return counted.select("item", "source_count", "modeled_count", "delta")


@query(
    "ordered_report",
    "\nunion all ".join(
        f"select '{n}' as item, count(*) as n from ({oracle_raw(n)})" for n in RAW_SQL if not n.startswith("vocab__")
    ),
)
def ordered_report(spark, sf_dir):
    """Raw row counts, genomic files last, then by name; the column they are sorted by is not shown."""
    counts = reconcile.row_counts(RawTables(spark, sf_dir))
    sort = F.when(F.col("name").endswith("mutations"), 2).otherwise(1)
    return counts.select(sort.alias("sort"), F.col("name").alias("item"), "n").orderBy("sort", "item").drop("sort")


# ---- Data quality --------------------------------------------------------------------------------------------------


@query("dq_not_null", whole("person where year_of_birth is null", ("birth_datetime",)))
def dq_not_null(spark, sf_dir):
    return checks.not_null(layers(spark, sf_dir).person, "year_of_birth")


@query(
    "dq_unique",
    statement("select person_source_value, count(*) as n_records from stg_synthea_encounters group by 1 having n_records > 1"),
)
def dq_unique(spark, sf_dir):
    return checks.unique(layers(spark, sf_dir).staging("stg_synthea_encounters"), "person_source_value")


@query(
    "dq_accepted_values",
    statement(
        "select encounter_class, count(*) as n_records from stg_synthea_encounters "
        "where encounter_class not in ('inpatient', 'emergency', 'ambulatory', 'outpatient', 'wellness') group by 1"
    ),
)
def dq_accepted_values(spark, sf_dir):
    visits = layers(spark, sf_dir).staging("stg_synthea_encounters")
    return checks.accepted_values(visits, "encounter_class", list(C.VISIT_CLASS))


@query(
    "dq_relationships",
    statement(
        "select visit_source_value, person_source_value from stg_synthea_encounters "
        "where person_source_value not in (select person_source_value from stg_synthea_patients)"
    ),
)
def dq_relationships(spark, sf_dir):
    """Visits of unknown patients."""
    models = layers(spark, sf_dir)
    orphans = checks.relationships(
        models.staging("stg_synthea_encounters"),
        "person_source_value",
        models.staging("stg_synthea_patients"),
        "person_source_value",
    )
    return orphans.select("visit_source_value", "person_source_value")


@query(
    "dq_expression_is_true",
    whole("drug_rows where drug_concept_id = 0", ("drug_exposure_start_date", "drug_exposure_end_date")),
)
def dq_expression_is_true(spark, sf_dir):
    return checks.expression_is_true(layers(spark, sf_dir).rows("drug_exposure"), "drug_concept_id != 0")


@query("dq_between", whole("person where year_of_birth < 1930 or year_of_birth > 2010", ("birth_datetime",)))
def dq_between(spark, sf_dir):
    known = "year_of_birth is not null"
    return checks.between(layers(spark, sf_dir).person, "year_of_birth", 1930, 2010, known)


@query(
    "dq_where_and_severity",
    statement(
        "select 'not_null_measurement_value_as_number' as check_name, 'warn' as severity, count(*) as violations, "
        "'WARN' as status from measurement_rows where value_as_concept_id is null and value_as_number is null"
    ),
)
def dq_where_and_severity(spark, sf_dir):
    """A check on part of the rows that reports without failing."""
    warned = [c for c in quality.clinical_checks(AS_OF_YEAR) if c.severity == "warn"]
    outcome = checks.report(warned, {"measurement": layers(spark, sf_dir).rows("measurement")})
    return outcome.select("check_name", "severity", "violations", "status")


@query(
    "dq_death_after_birth",
    statement(
        "select person_id, cast(death_date as varchar) as death_date, cast(birth_datetime as varchar) as birth_datetime "
        "from death join person using (person_id) where death_date < birth_datetime"
    ),
)
def dq_death_after_birth(spark, sf_dir):
    models = layers(spark, sf_dir)
    return quality.death_before_birth(models.table("death"), models.person)


@query(
    "dq_events_inside_period",
    whole("events_outside", ("event_date", "observation_period_start_date", "observation_period_end_date")),
)
def dq_events_inside_period(spark, sf_dir):
    """Against periods cut to a year, because a period derived from the same events cannot exclude one."""
    models = layers(spark, sf_dir)
    start = F.col("observation_period_start_date")
    short = models.rows("observation_period").withColumn("observation_period_end_date", F.date_add(start, 365))
    facts = [models.rows(t) for t in ("condition_occurrence", "visit_occurrence", "drug_exposure", "procedure_occurrence")]
    return quality.events_outside_period(quality.dated_events(*facts), short)


@query(
    "dq_cdm_coverage",
    statement(
        "select t as cdm_table_name, 'NOT_MATERIALIZED' as violation, 'declared built but absent' as detail from ("
        + "\nunion all ".join(f"select '{t}' as t, count(*) filter (where person_id = 1) as n from {t}" for t in CLINICAL)
        + ") where n = 0"
    ),
)
def dq_cdm_coverage(spark, sf_dir):
    """The gate over a database that holds the tables of the first person only; a table without a row is not there."""
    models = layers(spark, sf_dir)
    base = new_path(spark, "partial")
    database = "omop_" + base.rsplit("-", 1)[-1][:12]
    tables.create_database(spark, database, base)
    for name in CLINICAL:
        own = models.table(name).filter("person_id = 1")
        if not own.isEmpty():
            tables.write_overwrite(own, database, name, base)
    present = quality.materialised_tables(spark, database)
    return quality.cdm_coverage(seeds.cdm_spec(spark), seeds.cdm_scope(spark), present)


DATE_COLUMNS_SQL = statement(
    "\nunion all ".join(
        f"select 'omop' as layer, '{t}' as table_name, '{c}' as column_name, 'date' as data_type, count({c}) as n_values "
        f"from {t}"
        for t, columns in MODEL_DATES.items()
        for c in columns
    )
)


@query("dq_no_date_columns", DATE_COLUMNS_SQL)
def dq_no_date_columns(spark, sf_dir):
    """Lists the dates the clinical layer holds and, as it must, none for the de-identified layer."""
    models = layers(spark, sf_dir)
    facts = {t: models.rows(t) for t in CLINICAL if t != "person"} | {"person": models.person}
    no_id = {t: df.withColumn(PROJECTED_ID[t], F.lit(None).cast("long")) for t, df in facts.items() if t in PROJECTED_ID}
    published = {f"{t}_deid": PROJECTED[f"{t}_deid"][1](df) for t, df in no_id.items()}
    published |= {"person_deid": models.table("person_deid"), "mutations_deid": models.table("mutations_deid")}
    return quality.date_columns("omop", facts).unionByName(quality.date_columns("analytics", published))


PROJECTED_ID = {source: f"{source}_id" for source, _ in PROJECTED.values()}


@query(
    "dq_table_inventory",
    statement(
        "\nunion all ".join(
            [f"select 'staging' as layer, '{v}' as table_name, 'VIEW' as table_type, count(*) as n_rows from {v}"
             for v in VIEWS]
            + [f"select '{layer}', '{t}', 'BASE TABLE', count(*) from {t}"
               for layer, names in (("omop", CLINICAL), ("genomic", GENOMIC), ("analytics", ANALYTICS)) for t in names]
        )
    ),
)
def dq_table_inventory(spark, sf_dir):
    models, _, databases = built(spark, sf_dir)
    views = {("staging", v, "VIEW"): models.staging(v) for v in VIEWS}
    return tables.inventory({**views, **tables.catalog_tables(spark, databases)})


@query("dq_report", report_sql())
def dq_report(spark, sf_dir):
    """Every declared check and the checks across tables, on the tables as written."""
    models, kept, databases = built(spark, sf_dir)
    return quality.validate(
        kept,
        models.concept_map,
        seeds.cdm_spec(spark),
        seeds.cdm_scope(spark),
        quality.materialised_tables(spark, databases["omop"]),
        AS_OF_YEAR,
    )


# ---- Non-standard codes --------------------------------------------------------------------------------------------

#: Every concept that a non-standard one reaches; a union without repeats ends in circles.
REACH = """with recursive concepts as (
        select CONCEPT_ID::bigint as id, STANDARD_CONCEPT = 'S' as standard, VOCABULARY_ID as vocabulary_id, CONCEPT_CODE as code from ({concepts})),
    steps as (select concept_id_1 as a, concept_id_2 as b from ({links}) join concepts on concept_id_2 = id
              where relationship_id = 'Maps to' and invalid_reason = ''),
    reach(start, here, standard) as (
        select id, id, false from concepts where not standard
        union select start, b, c.standard from reach join steps on here = a join concepts c on c.id = b where not reach.standard),
    targets as (select start as concept_id, here as standard_concept_id from reach where standard)""".format(
    concepts=oracle_raw("vocab__concept"), links=oracle_raw("vocab__concept_relationship")
)


def linked_layers(spark, sf_dir) -> Layers:
    raw = RawTables(spark, sf_dir)
    links = raw["vocab__concept_relationship"]
    return Layers(raw, raw.vocabulary(), seeds.concept_map(spark), AS_OF_YEAR, relationships=links)


@query("maps_to_targets", REACH + " select * from targets")
def maps_to_targets(spark, sf_dir):
    """Chains of up to four steps, several targets, circles, and relationships that are invalid or of another kind."""
    return linked_layers(spark, sf_dir).targets


@query(
    "maps_to_procedures",
    REACH + f""", own as (select code, min(id) as id from concepts where vocabulary_id = 'SNOMED' and standard group by code),
    hops as (select code, min(standard_concept_id) as id from concepts join targets on id = concept_id
             where vocabulary_id = 'SNOMED' group by code)
    select r.CODE as snomed_code, coalesce(o.id, h.id, 0) as procedure_concept_id, count(*) as n
    from ({oracle_raw("synthea__procedures")}) r join ({oracle_raw("synthea__patients")}) s on r.PATIENT = s.Id
    left join own o on o.code = r.CODE left join hops h on h.code = r.CODE group by 1, 2""",
)
def maps_to_procedures(spark, sf_dir):
    """All procedures by code and concept, codes of non-standard concepts followed to their standard ones."""
    rows = linked_layers(spark, sf_dir).rows("procedure_occurrence")
    return rows.groupBy("snomed_code", "procedure_concept_id").agg(F.count("*").alias("n"))


# ---- Limited data set ----------------------------------------------------------------------------------------------

KEY = "a key for tests"


def shifts_sql() -> str:
    """HMAC-SHA-256 of the person ids in SQL, and the days it stands for."""
    inner, outer = (f"unhex('{k.hex()}')" for k in limited.padded(KEY.encode()))
    hashed = f"sha256({outer} || unhex(sha256({inner} || encode(person_id::varchar))))"
    return (
        f"select person_id, (case when n < {limited.DAYS} then n - {limited.DAYS} else n - {limited.DAYS} + 1 end)::int as shift_days from ("
        f"select person_id, ('0x' || substr({hashed}, 1, 15))::bigint % {2 * limited.DAYS} as n from person)"
    )


def shifts(models: Layers) -> DataFrame:
    """The days by which people's dates move, from written rows, as the holder of the key would keep them."""
    path = new_path(models.vocabulary.sparkSession, "shifts")
    limited.person_shifts(models.person, KEY).write.parquet(path)
    return models.vocabulary.sparkSession.read.parquet(path)


LIMITED = [t for t in CLINICAL if t != "person"]


@query("limited_person_shifts", statement(shifts_sql()))
def limited_person_shifts(spark, sf_dir):
    return shifts(layers(spark, sf_dir))


@query(
    "limited_dates",
    statement(
        f"select t.* from (select 1 from person limit 0) p right join (with shifts as ({shifts_sql()}) "
        + "\nunion all ".join(
            f"select '{t}' as table_name, '{c}' as column_name, person_id, "
            f"cast(cast({c} + shift_days as date) as varchar) as shifted, count(*) as n from {t} join shifts using (person_id) where {c} is not null group by all"
            for t, columns in MODEL_DATES.items()
            for c in columns
        )
        + ") t on true"
    ),
)
def limited_dates(spark, sf_dir):
    """Every date of every clinical table after the shift, by table, column and person."""
    models = layers(spark, sf_dir)
    tables_ = {t: models.rows(t) for t in LIMITED} | {"person": models.person}
    counts = []
    for name, df in limited.limited_tables(tables_, shifts(models)).items():
        for column in limited.date_columns(df):
            dated = df.filter(F.col(column).isNotNull()).groupBy("person_id", F.col(column).cast("string").alias("shifted"))
            counts.append(dated.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "person_id", "shifted", "n"))
    return union(counts)


@query(
    "limited_intervals",
    statement(
        "select person_id, count(*) as n, sum(date_diff('day', visit_start_date, visit_end_date))::bigint as days_inside, "
        "date_diff('day', min(visit_start_date), max(visit_end_date)) as days_between from visit_rows group by person_id"
    ),
)
def limited_intervals(spark, sf_dir):
    """Intervals of every person, measured on shifted visits; the SQL measures them on the visits themselves."""
    models = layers(spark, sf_dir)
    visits = limited.shifted(models.rows("visit_occurrence"), shifts(models))
    return visits.groupBy("person_id").agg(
        F.count("*").alias("n"),
        F.sum(F.date_diff("visit_end_date", "visit_start_date")).alias("days_inside"),
        F.date_diff(F.max("visit_end_date"), F.min("visit_start_date")).cast("long").alias("days_between"),
    )


# ---- Trend of the checks -------------------------------------------------------------------------------------------

RUNS = 3


def recorded(spark, sf_dir) -> DataFrame:
    """Reports of three runs over the visits of every third order, with the limits of a class list that grows."""
    view = "stg_synthea_encounters"
    visits, patients = (layers(spark, sf_dir).staging(v) for v in (view, "stg_synthea_patients"))
    declared = quality.arrival_checks()[view]
    folder = new_path(spark, "history")
    for run in range(1, RUNS + 1):
        own = visits.filter(F.substring("visit_source_value", 2, 20).cast("long") % RUNS == run - 1)
        # from the second run on all classes are known
        known = [replace(c, arguments={"values": [*c.arguments["values"], "urgentcare", "Wellness"]}) if c.kind == "accepted_values" and run > 1 else c for c in declared]
        trend.record(checks.report(known, {view: own, "stg_synthea_patients": patients}), folder, run)
    trend.record(checks.report(known, {view: own, "stg_synthea_patients": patients}), folder, RUNS)
    return trend.history(spark, folder)


@query("trend_checks", trend_sql("checks"))
def trend_checks(spark, sf_dir):
    """What changed from run to run; the last run is recorded twice and counts once."""
    return trend.check_trend(recorded(spark, sf_dir))


@query("trend_pass_rates", trend_sql("rates"))
def trend_pass_rates(spark, sf_dir):
    return trend.pass_rates(recorded(spark, sf_dir))


# ---- Re-identification risk ----------------------------------------------------------------------------------------

K = 5


@query("k_anonymity_steps", anonymity_sql(K, "report"))
def k_anonymity_steps(spark, sf_dir):
    """Every step of the generalisation hierarchy over the de-identified people, and the one that is chosen."""
    steps = anonymity.step_report(layers(spark, sf_dir).table("person_deid"), K)
    return steps.withColumn("levels", F.concat_ws("", "levels"))


@query("k_anonymity_small_classes", anonymity_sql(K, "small"))
def k_anonymity_small_classes(spark, sf_dir):
    return anonymity.small_classes(layers(spark, sf_dir).table("person_deid"), K)


@query("k_anonymity_published", anonymity_sql(K, "published"))
def k_anonymity_published(spark, sf_dir):
    """The people at the chosen step."""
    return anonymity.anonymous(layers(spark, sf_dir).table("person_deid"), K)[0]


# ---- Incremental load ----------------------------------------------------------------------------------------------

CONDITIONS = "synthea__conditions"


def put_part(spark, rows: DataFrame, folder: str, number: int) -> None:
    """One part file of a table, in place of the one with this number."""
    written = new_path(spark, "part")
    write_flat(rows.repartition(1), written)  # the one task that writes a file does not work its rows out, too
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    found = next(f.getPath() for f in system.listStatus(path(written)) if f.getPath().getName().startswith("part-"))
    target = path(f"{folder}/part-{number}.csv")
    system.delete(target, False)
    system.rename(found, target)


def loaded_twice(spark, sf_dir) -> tuple[str, DataFrame, DataFrame]:
    """Conditions in five files by code, landed; then one file is put right, one added, one taken away; landed again."""
    rows = raw_table(spark, sf_dir, CONDITIONS)
    part = F.col("CODE").cast("long") % 5
    base, location = new_path(spark, "incoming"), new_path(spark, "landed")
    folder = f"{base}/synthea/csv/conditions.csv"
    wrong = rows.withColumn("DESCRIPTION", F.concat(F.lit("wrong "), "DESCRIPTION"))
    for number, content in ((0, rows), (1, rows), (2, wrong), (3, rows)):
        put_part(spark, content.filter(part == number), folder, number)
    first = incremental.land_changes(spark, base, location)
    put_part(spark, rows.filter(part == 2), folder, 2)
    put_part(spark, rows.filter(part == 4), folder, 4)
    session.delete(spark, f"{folder}/part-0.csv")
    return location, first, incremental.land_changes(spark, base, location, drop_removed=True)


@query("incremental_load", f"select * from ({oracle_raw(CONDITIONS)}) where cast(CODE as bigint) % 5 <> 0")
def incremental_load(spark, sf_dir):
    """What two loads leave: the rows of the files that are there."""
    location, _, _ = loaded_twice(spark, sf_dir)
    return incremental.table(spark, location, CONDITIONS)


@query(
    "incremental_report",
    "select run, status, count(*) as n_files, sum(n)::bigint as n_lines from (values (1, 'NEW', 0), (1, 'NEW', 1), (1, 'NEW', 2), (1, 'NEW', 3), "
    "(2, 'CHANGED', 2), (2, 'NEW', 4), (2, 'REMOVED', 0)) as f(run, status, part) join (select part, count(c) + 1 as n from range(5) p(part) "
    f"left join (select cast(CODE as bigint) % 5 as k, CODE as c from ({oracle_raw(CONDITIONS)})) on k = part group by part) using (part) group by 1, 2",
)
def incremental_report(spark, sf_dir):
    """The ledger of both loads: files by status, with the lines that their checksums cover (the header is one)."""
    _, first, second = loaded_twice(spark, sf_dir)
    lines = F.split("checksum", "-")[0].cast("long")
    return first.unionByName(second).groupBy("run", "status").agg(F.count("*").alias("n_files"), F.sum(lines).alias("n_lines"))


# ---- Checks on arrival ---------------------------------------------------------------------------------------------


#: A file with cells that may hold line breaks is read by one task, so there is one for as many bytes of the given tables.
ARRIVING_BYTES = 8 << 20


def arrivals(spark, sf_dir, view: str, bytes_a_file: int = ARRIVING_BYTES) -> tuple[validation.Feed, list[str], str, int]:
    """The raw table of a staging view as at least two CSV files in a folder, its feed, its columns and the number of files; no
    file has arrived yet."""
    table, project = VIEWS[view]
    raw, folder = RawTables(spark, sf_dir), new_path(spark, f"arriving-{view}")
    given = [t for t in TEST_TABLES if "{" + t + "}" in RAW_SQL[table]]
    parts = max(2, -(-sum(session.stored_bytes(spark, f"{sf_dir}/{t}.parquet") for t in given) // bytes_a_file))
    write_flat(raw[table].repartition(parts), f"{folder}/all")
    patients = VIEWS["stg_synthea_patients"][1](raw["synthea__patients"])
    feed = validation.Feed(view, project, quality.arrival_checks()[view], f"{folder}/feed", {"stg_synthea_patients": patients})
    return feed, raw[table].columns, folder, parts


def taken(spark, feed, columns: list[str], folder: str, parts: int, files: str = "all/part-*") -> None:
    """What has arrived and was not taken, half of the files a batch, with a checkpoint that outlives the stream."""
    stream = validation.arriving(spark, f"{folder}/{files}", columns, files_per_batch=-(-parts // 2))
    validation.watch(stream, feed, f"{folder}/checkpoint").awaitTermination()


@query("stream_checks", arrivals_sql())
def stream_checks(spark, sf_dir):
    """The event files of the synthetic source, checked batch by batch; the report over all batches."""
    reports = []
    for view in quality.arrival_checks():
        feed, columns, folder, parts = arrivals(spark, sf_dir, view)
        taken(spark, feed, columns, folder, parts)
        reports.append(validation.report(spark, feed))
    return union(reports)


@query("stream_landing", whole("synthea__encounters"))
def stream_landing(spark, sf_dir):
    """All visits, landed by a stream that ends and starts again from its checkpoint, and then has nothing to do."""
    feed, columns, folder, parts = arrivals(spark, sf_dir, "stg_synthea_encounters")
    for _ in range(2):
        taken(spark, feed, columns, folder, parts)
    return validation.rows(spark, feed, columns)


@query("dq_field_conformance", conformance_sql(seeds.packaged("cdm_v54_fields", seeds.FIELD_SCHEMA)))
def dq_field_conformance(spark, sf_dir):
    """Every published field of the clinical tables: absent, mistyped, extra, too long, or NULL where required."""
    models = layers(spark, sf_dir)
    # what rows are numbered by is not part of the table
    facts = {t: models.rows(t).drop("person_source_value") for t in CLINICAL if t != "person"} | {"person": models.person}
    whole_tables = {t: df.withColumn(NUMBERS[t], F.lit(1).cast("long")) if t in NUMBERS else df for t, df in facts.items()}
    return conformance.field_conformance(spark, whole_tables, seeds.cdm_fields(spark))


#: Ids that fact tables get when they are written; any value stands for them here.
NUMBERS = {t: f"{t}_id" for t in CLINICAL if t not in ("person", "death")}


# ---- Reconciliation ------------------------------------------------------------------------------------------------

REPORT = "check_group, item, source_count, modeled_count, delta, note"


PERSON_LINES_SQL = (
    f"select 'person' as check_group, r.source as item, r.n as source_count, coalesce(p.n, 0) as modeled_count, "
    f"r.n - coalesce(p.n, 0) as delta, 'distinct raw patients against persons; delta must be 0' as note "
    f"from ({RAW_PATIENTS_SQL}) r left join (select case "
    "when person_source_value in (select Id from synthea__patients) then 'synthea' "
    "when person_source_value in (select PATIENT_ID from metabric__data_clinical_patient) then 'metabric' "
    "when person_source_value in (select PATIENT_ID from tcga_brca__data_clinical_patient) then 'tcga_brca' "
    "else 'UNATTRIBUTED' end as source, count(*) as n from person group by 1) p on p.source = r.source"
)


@query("recon_person", statement(PERSON_LINES_SQL))
def recon_person(spark, sf_dir):
    models = layers(spark, sf_dir)
    return reconcile.person_lines(models.raw, models.person).drop("sort")


@query("recon_mapping", statement(lines_sql("mapping")))
def recon_mapping(spark, sf_dir):
    counted = written(layers(spark, sf_dir), list(reconcile.MAPPED))
    return reconcile.section(counted, reconcile.MAPPING_LINES).drop("sort")


@query("recon_deid", statement(lines_sql("deid")))
def recon_deid(spark, sf_dir):
    return reconcile.section(built(spark, sf_dir)[1], reconcile.DEID_LINES).drop("sort")


@query("recon_ohdsi", statement(lines_sql("ohdsi")))
def recon_ohdsi(spark, sf_dir):
    counted = written(layers(spark, sf_dir), ["person", "observation_period"])
    return reconcile.section(counted, reconcile.PERIOD_LINES).drop("sort")


@query("recon_totals", statement(lines_sql("total")))
def recon_totals(spark, sf_dir):
    counted = written(layers(spark, sf_dir), ["person", "sample_person", "unique_patients"])
    return reconcile.section(counted, reconcile.TOTAL_LINES).drop("sort")


@query("reconciliation", statement(PERSON_LINES_SQL + "\nunion all " + lines_sql("mapping", "deid", "ohdsi", "total")))
def reconciliation(spark, sf_dir):
    """The whole report over the layers as written."""
    models, kept, _ = built(spark, sf_dir)
    return reconcile.reconciliation(models.raw, kept)
