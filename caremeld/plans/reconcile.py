"""Completeness from raw to clinical to de-identified, as one report.

Every table is counted in one pass, which yields a handful of named counts; the report lines are arithmetic on those.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Clinical table -> (concept column, what the delta should be).
MAPPED = {
    "condition_occurrence": ("condition_concept_id", "unmapped rows; must be 0"),
    "observation": ("observation_concept_id", "unmapped rows; must be 0"),
    "drug_exposure": ("drug_concept_id", "unmapped rows; must be 0"),
    "procedure_occurrence": ("procedure_concept_id", "unmapped rows; codes the vocabulary lacks"),
    "measurement": ("measurement_concept_id", "unmapped rows; codes without an equivalent"),
}
DEIDENTIFIED = [
    "person",
    "condition_occurrence",
    "measurement",
    "observation",
    "visit_occurrence",
    "drug_exposure",
    "procedure_occurrence",
    "observation_period",
]
RAW_IDS = {
    "synthea": ("synthea__patients", "Id"),
    "metabric": ("metabric__data_clinical_patient", "PATIENT_ID"),
    "tcga_brca": ("tcga_brca__data_clinical_patient", "PATIENT_ID"),
}


Tables = Mapping[str, DataFrame]
REPORT_COLUMNS = ["sort", "check_group", "item", "source_count", "modeled_count", "delta", "note"]


@dataclass(frozen=True)
class Line:
    """One report line. ``source`` and ``modeled`` name counts to add up; ``delta`` is their difference, unless it
    names a count itself. A line without ``source`` is a headline count."""

    sort: int
    group: str
    item: str
    note: str
    modeled: tuple[str, ...]
    source: tuple[str, ...] = ()
    delta: str | None = None

    def columns(self) -> Column:
        def total(names: tuple[str, ...]) -> Column:
            return reduce(lambda a, b: a + b, [F.col("counts")[name] for name in names])

        none = F.lit(None).cast("long")
        source = total(self.source) if self.source else none
        modeled = total(self.modeled)
        delta = F.col("counts")[self.delta] if self.delta else source - modeled
        values = [F.lit(self.sort), F.lit(self.group), F.lit(self.item), source, modeled, delta, F.lit(self.note)]
        return F.struct(*[v.alias(n) for v, n in zip(values, REPORT_COLUMNS)])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Tables) -> DataFrame:
    """(name, n) per table. A mapped clinical table also yields its rows with and without a real concept."""
    parts = []
    for name, df in tables.items():
        counts = {name: F.count("*")}
        if name in MAPPED:
            concept = F.col(MAPPED[name][0])
            counts[f"{name} mapped"] = F.count_if(concept != 0)
            counts[f"{name} unmapped"] = F.count_if(concept == 0)
        one_row = df.agg(*[n.alias(label) for label, n in counts.items()])
        entries = [F.struct(F.lit(label).alias("name"), F.col(label).alias("n")) for label in counts]
        parts.append(one_row.select(F.inline(F.array(*entries))))
    return _union(parts)


def report_lines(counts: DataFrame, lines: list[Line]) -> DataFrame:
    """Lines computed from the named counts; there are as many counts as tables, so one row holds them all."""
    entries = F.collect_list(F.struct("name", "n"))
    return counts.agg(F.map_from_entries(entries).alias("counts")).select(
        F.inline(F.array(*[line.columns() for line in lines]))
    )


def raw_patients(raw: Tables) -> DataFrame:
    """Distinct patient ids per raw source."""
    return _union(
        [
            raw[table].agg(F.count_distinct(column).alias("n")).select(F.lit(source).alias("source"), "n")
            for source, (table, column) in RAW_IDS.items()
        ]
    )


def persons_by_source(raw: Tables, person: DataFrame) -> DataFrame:
    """Persons by the source their id came from; an id in several sources goes to the first one listed."""
    ids = _union(
        [
            raw[table].select(F.col(column).alias("person_source_value"), F.lit(rank).alias("_rank"))
            for rank, (table, column) in enumerate(RAW_IDS.values())
        ]
    )
    first = ids.groupBy("person_source_value").agg(F.min("_rank").alias("_rank"))
    names = F.array(*[F.lit(s) for s in RAW_IDS])
    source = F.coalesce(F.try_element_at(names, F.col("_rank") + 1), F.lit("UNATTRIBUTED"))
    people = person.select("person_source_value").join(first, "person_source_value", "left")
    return people.groupBy(source.alias("source")).agg(F.count("*").alias("n"))


def person_lines(raw: Tables, person: DataFrame) -> DataFrame:
    persons = persons_by_source(raw, person).withColumnRenamed("n", "_persons")
    found = F.coalesce("_persons", F.lit(0).cast("long"))
    return raw_patients(raw).join(persons, "source", "left").select(
        F.lit(1).alias("sort"),
        F.lit("person").alias("check_group"),
        F.col("source").alias("item"),
        F.col("n").alias("source_count"),
        found.alias("modeled_count"),
        (F.col("n") - found).alias("delta"),
        F.lit("distinct raw patients against persons; delta must be 0").alias("note"),
    )


MAPPING_LINES = [
    Line(2, "mapping", table, note, (f"{table} mapped",), (table,), f"{table} unmapped")
    for table, (_, note) in MAPPED.items()
]
DEID_LINES = [
    Line(3, "deid", table, "clinical against de-identified rows; delta must be 0", (f"{table}_deid",), (table,))
    for table in DEIDENTIFIED
] + [
    Line(
        3,
        "deid",
        "mutations",
        "variants whose sample has no person; must be 0",
        ("mutations_deid",),
        ("metabric_mutations", "tcga_brca_mutations"),
    )
]
PERIOD_LINES = [
    Line(
        3,
        "ohdsi",
        "observation_period coverage",
        "persons without any dated event",
        ("observation_period",),
        ("person",),
    )
]
TOTAL_LINES = [
    Line(4, "total", "OMOP.PERSON", "all sources together", ("person",)),
    Line(4, "total", "GENOMIC.SAMPLE_PERSON", "samples with their person", ("sample_person",)),
    Line(4, "total", "ANALYTICS.UNIQUE_PATIENTS", "roster; must equal the persons", ("unique_patients",)),
]


def section(tables: Tables, lines: list[Line]) -> DataFrame:
    """One section, counting only the tables its lines name."""
    named = {name.split(" ")[0] for line in lines for name in (*line.source, *line.modeled)}
    return report_lines(row_counts({t: df for t, df in tables.items() if t in named}), lines)


def reconciliation(raw: Tables, tables: Tables) -> DataFrame:
    """All sections in order. ``tables`` holds the clinical, genomic and de-identified tables by name."""
    counted = section(tables, [*MAPPING_LINES, *DEID_LINES, *PERIOD_LINES, *TOTAL_LINES])
    report = person_lines(raw, tables["person"]).unionByName(counted)
    return report.orderBy("sort", "item").drop("sort")
