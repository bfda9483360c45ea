import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caremeld.functions.casts import date_or_null, has_text, number_or_null

DATES = {
    "": None, "NA": None, "2020": None, "2010-13-01": None, "2011-02-29": None, "10/01/2010": None, "bad": None, None: None,
    "2010-01-01": dt.date(2010, 1, 1), "2010-01-01T00:00:00Z": dt.date(2010, 1, 1),
    "2012-02-29 10:11:12": dt.date(2012, 2, 29), "2010-01-011": None,
}
NUMBERS = {
    "": None, "NA": None, "1d": None, "1f": None, "NaN": None, "inf": None, "1,5": None, "--1": None, None: None,
    " 3.5 ": 3.5, "+2": 2.0, "-.5": -0.5, "7.": 7.0, "1e2": 100.0, "26.2": 26.2,
}


def evaluate(spark, column, texts):
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in data.orderBy("i").select(column("t")).collect()]


def test_dates(spark):
    assert evaluate(spark, date_or_null, DATES) == list(DATES.values())


def test_numbers(spark):
    assert evaluate(spark, number_or_null, NUMBERS) == list(NUMBERS.values())


def test_has_text(spark):
    assert evaluate(spark, has_text, ["", None, " ", "NA"]) == [False, False, True, True]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_cast_never_fails(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert evaluate(spark, date_or_null, ["9999-99-99", "0000-00-00"]) == [None, None]
        assert evaluate(spark, number_or_null, ["1e999999", "."])[1] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.dates().map(str), st.text(alphabet="0123456789-T :eE+.dfNa", max_size=14)), min_size=40, max_size=80))
def test_random_text_agrees_with_python(spark, texts):
    def as_date(text):
        try:
            head, rest = text[:10], text[10:]
            return dt.date.fromisoformat(head) if len(head) == 10 and head[4] == "-" and rest[:1] in ("", "T", " ") else None
        except ValueError:
            return None

    assert evaluate(spark, date_or_null, texts) == [as_date(t) for t in texts]
    numbers = evaluate(spark, lambda c: F.when(number_or_null(c).isNotNull(), F.lit(True)), texts)
    for text, accepted in zip(texts, numbers):
        if accepted:
            float(text)
