"""Tolerant casts: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings. ISO dates, optionally followed by a time part; plain decimal numbers.
ISO_DATE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([T ].*)?$"
DECIMAL_NUMBER = r"^[ ]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ ]*$"


def date_or_null(text: Column | str) -> Column:
    """Date part of an ISO date or timestamp string."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(text, ISO_DATE, 1).try_cast("date")


def number_or_null(text: Column | str) -> Column:
    """Double from a decimal string; suffixed literals, NaN and infinities are refused."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(DECIMAL_NUMBER), text.try_cast("double"))


def has_text(text: Column | str) -> Column:
    """True when the value is neither NULL nor the empty string."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")) != ""


def year_of(date: Column | str) -> Column:
    return F.year(date).cast("long")
