"""Each finding fires once, on schemas and on values."""

from __future__ import annotations

import datetime as dt

from caremeld.plans import conformance as C
from caremeld.sources import seeds

SPEC = "cdm_table_name string, cdm_field_name string, is_required string, cdm_datatype string"


def found(spark, tables, spec):
    rows = C.field_conformance(spark, tables, spark.createDataFrame(spec, SPEC)).collect()
    assert len(rows) == len(set(rows))
    return {(r.table_name, r.field_name, r.violation, r.n_values) for r in rows}


def test_every_finding_once(spark):
    spec = [
        ("PERSON", "person_id", "TRUE", "integer"), ("person", "born", "TRUE", "date"), ("person", "name", "FALSE", "varchar(3)"),
        ("person", "weight", "FALSE", "float"), ("person", "at", "FALSE", "datetime"), ("person", "gone", "TRUE", "integer"),
        ("person", "rarely", "FALSE", "varchar(max)"), ("person", "note", "FALSE", "varchar(MAX)"), ("other", "x", "TRUE", "integer"),
    ]
    table = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), "four", 1, "2000", "long " * 50, 5), (None, dt.date(2000, 1, 1), "abc", 2, "2001", None, 6), (None, dt.date(2000, 1, 1), None, 2, "", "", 7)],
        "person_id long, Born date, name string, weight int, at string, note string, more int",
    )
    assert found(spark, {"person": table, "unpublished": table}, spec) == {
        ("person", "gone", "ABSENT_REQUIRED", None), ("person", "rarely", "ABSENT_OPTIONAL", None), ("person", "more", "EXTRA", None),
        ("person", "at", "MISTYPED", None), ("person", "name", "TOO_LONG", 1), ("person", "person_id", "NULL_REQUIRED", 2),
    }


def test_a_table_that_conforms(spark):
    spec = [("death", "person_id", "TRUE", "integer"), ("death", "death_date", "TRUE", "date"), ("death", "cause", "FALSE", "varchar(5)")]
    table = spark.createDataFrame([(1, dt.date(2000, 1, 1))], "person_id long, death_date date")
    result = C.field_conformance(spark, {"death": table}, spark.createDataFrame(spec, SPEC))
    assert [r.violation for r in result.collect()] == ["ABSENT_OPTIONAL"] and C.unmet(result).count() == 0
    empty = C.field_conformance(spark, {"death": table.limit(0)}, spark.createDataFrame(spec, SPEC))
    assert C.unmet(empty).count() == 0


def test_the_published_fields(spark):
    fields = seeds.packaged("cdm_v54_fields", seeds.FIELD_SCHEMA)
    assert len({f[:2] for f in fields}) == len(fields) and {f[2] for f in fields} == {"TRUE", "FALSE"}
    built = {t for t, *_ in fields}
    assert built == {"person", "observation_period", "visit_occurrence", "condition_occurrence", "drug_exposure", "procedure_occurrence", "measurement", "observation", "death"}
    for table in built - {"death"}:
        assert (table, f"{table}_id", "TRUE", "integer") in fields
    assert {f[3].split("(")[0] for f in fields} == set(C.TYPES)
