"""The declared checks of every layer, and the checks that span tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremeld.operators.checks import Check, report, unique
from caremeld.sources.seeds import REVIEW_STATUSES, SOURCES

# Accepted concept ids and the earliest plausible year.
GENDER_CONCEPTS = [8507, 8532, 0]
VISIT_CONCEPTS = [9201, 9202, 9203, 0]
EARLIEST_YEAR = 1900
# What names one row of the concept map.
MAP_KEY = ["source", "source_field", "source_value", "omop_table", "omop_field"]


def _keys(table: str, *columns: str) -> list[Check]:
    return [Check(table, column, kind) for column in columns for kind in ("not_null", "unique")]


def _linked(table: str, parent: str, required: bool = True) -> list[Check]:
    link = Check(table, "person_id", "relationships", arguments={"parent": parent, "parent_column": "person_id"})
    return [Check(table, "person_id", "not_null"), link] if required else [link]


def _one_of(table: str, column: str, values: list) -> Check:
    return Check(table, column, "accepted_values", arguments={"values": values})


def _holds(table: str, column: str, expression: str, category: str) -> Check:
    return Check(table, column, "expression_is_true", category, arguments={"expression": expression})


def _year(table: str, column: str, low: int, high: int) -> Check:
    known = f"{column} is not null"
    return Check(
        table, column, "between", "plausibility", arguments={"low": low, "high": high, "row_condition": known}
    )


def clinical_checks(as_of_year: int) -> list[Check]:
    return [
        *_keys("person", "person_id"),
        Check("person", "gender_concept_id", "not_null"),
        _one_of("person", "gender_concept_id", GENDER_CONCEPTS),
        _year("person", "year_of_birth", EARLIEST_YEAR, as_of_year),
        *_keys("condition_occurrence", "condition_occurrence_id"),
        *_linked("condition_occurrence", "person"),
        _holds("condition_occurrence", "condition_concept_id", "!= 0", "completeness"),
        *_linked("measurement", "person", required=False),
        Check("measurement", "value_as_number", "not_null", "completeness", "warn", "value_as_concept_id is null"),
        *_keys("drug_exposure", "drug_exposure_id"),
        *_linked("drug_exposure", "person"),
        Check("drug_exposure", "drug_concept_id", "not_null"),
        _holds("drug_exposure", "drug_concept_id", "!= 0", "completeness"),
        *_keys("procedure_occurrence", "procedure_occurrence_id"),
        *_linked("procedure_occurrence", "person"),
        Check("procedure_occurrence", "procedure_concept_id", "not_null"),
        *_keys("observation_period", "observation_period_id"),
        *_linked("observation_period", "person"),
        Check("observation_period", "person_id", "unique"),
        Check("observation_period", "observation_period_start_date", "not_null", "completeness"),
        Check("observation_period", "observation_period_end_date", "not_null", "completeness"),
        _holds("observation_period", "observation_period_end_date", ">= observation_period_start_date", "plausibility"),
        _one_of("observation_period", "period_type_concept_id", [32817]),
        *_linked("death", "person"),
        _one_of("visit_occurrence", "visit_concept_id", VISIT_CONCEPTS),
        *_keys("observation", "observation_id"),
        *_linked("observation", "person"),
        _holds("observation", "observation_concept_id", "!= 0", "completeness"),
    ]


def genomic_checks() -> list[Check]:
    return [
        *_keys("sample_person", "sample_id"),
        *_linked("sample_person", "person"),
        _one_of("sample_person", "source", ["metabric", "tcga_brca"]),
    ]


def analytics_checks(as_of_year: int) -> list[Check]:
    facts = [
        "condition_occurrence_deid",
        "measurement_deid",
        "observation_deid",
        "visit_occurrence_deid",
        "mutations_deid",
        "drug_exposure_deid",
        "procedure_occurrence_deid",
        "observation_period_deid",
    ]
    return [
        *_keys("person_deid", "person_id"),
        _year("person_deid", "year_of_birth", as_of_year - 90, as_of_year),
        *[check for fact in facts for check in _linked(fact, "person_deid")],
        _year("condition_occurrence_deid", "condition_start_year", EARLIEST_YEAR, as_of_year),
        _one_of("mutations_deid", "source", ["metabric", "tcga_brca"]),
        Check("observation_period_deid", "person_id", "unique"),
        *_keys("unique_patients", "person_id"),
    ]


def seed_checks() -> list[Check]:
    return [
        _one_of("concept_map", "review_status", REVIEW_STATUSES),
        _one_of("concept_map", "source", SOURCES),
        *_keys("cdm_v54_tables", "cdm_table_name"),
        _one_of("cdm_v54_tables", "is_required", ["TRUE", "FALSE"]),
        *_keys("cdm_scope", "cdm_table_name"),
        _one_of("cdm_scope", "status", ["BUILT", "OUT_OF_SCOPE"]),
        Check("cdm_scope", "reason", "not_null"),
    ]


def arrival_checks() -> dict[str, list[Check]]:
    """What the event files of the synthetic source can be checked for as they arrive, by staging view."""
    patients, key = "stg_synthea_patients", "person_source_value"

    def known(view: str) -> Check:
        return Check(view, key, "relationships", arguments={"parent": patients, "parent_column": key})

    def dated(view: str, column: str, end: str | None = None) -> list[Check]:
        ordered = [_holds(view, end, f">= {column}", "plausibility")] if end else []
        return [Check(view, column, "not_null", "completeness"), *ordered]

    visits, conditions, drugs = "stg_synthea_encounters", "stg_synthea_conditions", "stg_synthea_medications"
    results, procedures = "stg_synthea_observations", "stg_synthea_procedures"
    days = {"low": "1900-01-01", "high": "2100-12-31"}
    return {
        patients: [
            *_keys(patients, key),
            _one_of(patients, "gender_source_value", ["F", "M"]),
            Check(patients, "birth_date", "not_null", "completeness", "warn"),
            Check(patients, "birth_date", "between", "plausibility", arguments=days),
            _holds(patients, "death_date", ">= birth_date", "plausibility"),
        ],
        visits: [
            *_keys(visits, "visit_source_value"),
            known(visits),
            *dated(visits, "visit_start_date", "visit_end_date"),
            _one_of(visits, "encounter_class", ["inpatient", "emergency", "ambulatory", "outpatient", "wellness"]),
        ],
        conditions: [known(conditions), *dated(conditions, "condition_start_date")],
        drugs: [
            known(drugs),
            *dated(drugs, "drug_exposure_start_date", "drug_exposure_end_date"),
            Check(drugs, "dispenses", "between", "plausibility", "warn", arguments={"low": 1, "high": 40}),
        ],
        results: [
            known(results),
            *dated(results, "measurement_date"),
            Check(results, "value_as_number", "not_null", "completeness", "warn", "unit_source_value <> ''"),
        ],
        procedures: [known(procedures), *dated(procedures, "procedure_date")],
    }


def declared_checks(as_of_year: int) -> list[Check]:
    return [*clinical_checks(as_of_year), *genomic_checks(), *analytics_checks(as_of_year), *seed_checks()]


def death_before_birth(death: DataFrame, person: DataFrame) -> DataFrame:
    born = person.select("person_id", "birth_datetime")
    dated = death.select("person_id", "death_date").join(born, "person_id")
    return dated.filter(F.col("death_date") < F.col("birth_datetime"))


def dated_events(
    conditions: DataFrame, visits: DataFrame, drugs: DataFrame, procedures: DataFrame
) -> DataFrame:
    """Start dates of four fact tables as (person_id, src, event_date)."""
    streams = [
        (conditions, "condition_start_date", "condition"),
        (visits, "visit_start_date", "visit"),
        (drugs, "drug_exposure_start_date", "drug"),
        (procedures, "procedure_date", "procedure"),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.filter(F.col(date).isNotNull()).select("person_id", F.lit(src).alias("src"), F.col(date).alias("event_date"))
            for df, date, src in streams
        ],
    )


def events_outside_period(events: DataFrame, periods: DataFrame) -> DataFrame:
    """Events outside the period of a person who has one; an equality join with the range as a filter on top."""
    bounds = periods.select("person_id", "observation_period_start_date", "observation_period_end_date")
    start, end = F.col("observation_period_start_date"), F.col("observation_period_end_date")
    outside = (F.col("event_date") < start) | (F.col("event_date") > end)
    return events.join(bounds, "person_id").filter(outside).select(
        "person_id", "src", "event_date", "observation_period_start_date", "observation_period_end_date"
    )


def materialised_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables that exist in a database, read from the catalog and not from what was meant to be built."""
    return spark.sql(f"show tables in {database}").filter("not isTemporary").select(
        F.lower("tableName").alias("table_name")
    )


def cdm_coverage(spec: DataFrame, scope: DataFrame, materialised: DataFrame) -> DataFrame:
    """Published tables that are required but not built, undeclared, or declared built but absent."""
    spec = spec.select(F.lower("cdm_table_name").alias("cdm_table_name"), F.upper("is_required").alias("is_required"))
    scope = scope.select(F.lower("cdm_table_name").alias("cdm_table_name"), F.upper("status").alias("status"))
    built = scope.filter(F.col("status") == "BUILT")
    present = materialised.select(F.lower("table_name").alias("cdm_table_name"))

    def finding(rows: DataFrame, violation: str, detail: str) -> DataFrame:
        return rows.select("cdm_table_name", F.lit(violation).alias("violation"), F.lit(detail).alias("detail"))

    required = spec.filter(F.col("is_required") == "TRUE")
    return (
        finding(required.join(built, "cdm_table_name", "left_anti"), "MISSING_REQUIRED", "required but not built")
        .unionByName(
            finding(spec.join(scope, "cdm_table_name", "left_anti"), "UNDECLARED", "published but neither in nor out")
        )
        .unionByName(
            finding(built.join(present, "cdm_table_name", "left_anti"), "NOT_MATERIALIZED", "declared built but absent")
        )
    )


def validate(
    tables: dict[str, DataFrame],
    concept_map: DataFrame,
    spec: DataFrame,
    scope: DataFrame,
    materialised: DataFrame,
    as_of_year: int,
) -> DataFrame:
    """Every declared check, the checks across tables and the coverage gate, one row each.

    Two more report what would multiply rows: a patient id that several sources share and a map key listed twice.
    """
    checked = {**tables, "concept_map": concept_map, "cdm_v54_tables": spec, "cdm_scope": scope}
    events = dated_events(
        tables["condition_occurrence"],
        tables["visit_occurrence"],
        tables["drug_exposure"],
        tables["procedure_occurrence"],
    )
    across = {
        "death_before_birth": ("death", "plausibility", death_before_birth(tables["death"], tables["person"])),
        "events_outside_period": (
            "observation_period",
            "plausibility",
            events_outside_period(events, tables["observation_period"]),
        ),
        "cdm_coverage": ("cdm_scope", "completeness", cdm_coverage(spec, scope, materialised)),
        "shared_patient_ids": ("person", "conformance", unique(tables["person"], "person_source_value")),
        "repeated_map_keys": (
            "concept_map",
            "conformance",
            unique(concept_map, *MAP_KEY),
        ),
    }
    return report(declared_checks(as_of_year), checked, across)


def date_columns(layer: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Date and timestamp columns of a layer with the values they expose; a de-identified layer must have none.

    Found in the schemas, not by sampling; one pass per table that has such a column.
    """
    found = []
    for name, df in tables.items():
        dated = [f for f in df.schema if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
        if dated:
            counts = df.agg(*[F.count(f.name).alias(f.name) for f in dated])
            rows = [
                F.struct(
                    F.lit(layer).alias("layer"),
                    F.lit(name).alias("table_name"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.typeName()).alias("data_type"),
                    F.col(f.name).alias("n_values"),
                )
                for f in dated
            ]
            found.append(counts.select(F.inline(F.array(*rows))))
    if not found:
        return next(iter(tables.values())).sparkSession.createDataFrame(
            [], "layer string, table_name string, column_name string, data_type string, n_values long"
        )
    return reduce(DataFrame.unionByName, found)
