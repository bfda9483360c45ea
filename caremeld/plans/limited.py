"""A limited data set: the clinical tables with dates, every date of a person moved by the same number of days.

The number comes from a keyed hash of the person's id (HMAC with SHA-256), so it is the same in every table and every run with
the same key, and nobody without the key can work it out from the id. Intervals of a person stay as they are: ages, times
between events, the order of events. People are told apart by ``person_id`` alone.

The numbers undo the shift. ``person_shifts`` makes them in one place; write them where only the holder of the key can read,
and join them from there, so that plans and logs of later steps do not hold the key.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremeld.operators.lookups import BROADCAST_BYTES, broadcast_if_small

BLOCK_BYTES = 64
#: Columns that name a person of a source.
IDENTIFYING = ("person_source_value",)
DAYS = 365


def padded(key: bytes) -> tuple[bytes, bytes]:
    """The inner and the outer key of HMAC."""
    whole = (hashlib.sha256(key).digest() if len(key) > BLOCK_BYTES else key).ljust(BLOCK_BYTES, b"\0")
    return bytes(b ^ 0x36 for b in whole), bytes(b ^ 0x5C for b in whole)


def keyed_hash(message: Column, key: bytes) -> Column:
    """HMAC-SHA-256 of a text, as lowercase hex."""
    inner, outer = (F.unhex(F.lit(k.hex())) for k in padded(key))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def person_shifts(person: DataFrame, key: str, days: int = DAYS) -> DataFrame:
    """(person_id, shift_days): 1 to ``days`` days, back or forth, for every person. NULL ids have none."""
    if not key:
        raise ValueError("an empty key would let anyone undo the shift")
    number = F.conv(F.substring(keyed_hash(F.col("person_id").cast("string"), key.encode()), 1, 15), 16, 10).cast("long")
    place = (number % (2 * days)).cast("int")
    shift = F.when(place < days, place - days).otherwise(place - days + 1)
    return person.where("person_id is not null").select("person_id", shift.alias("shift_days")).distinct()


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def shifted(df: DataFrame, shifts: DataFrame) -> DataFrame:
    """``df`` with every date and timestamp moved by its person's days and without identifying columns.

    Rows of people without a shift are left out: their dates would stand unmoved.
    """
    kept = df.drop(*IDENTIFYING)
    joined = kept.join(shifts.select("person_id", F.col("shift_days").alias("_days")), "person_id")
    moved = {}
    for field in kept.schema:
        if isinstance(field.dataType, T.DateType):
            moved[field.name] = F.date_add(field.name, F.col("_days"))
        elif field.name in date_columns(kept):
            moved[field.name] = F.col(field.name) + F.make_dt_interval(F.col("_days"))
    return joined.withColumns(moved).select(*kept.columns)


def limited_tables(tables: dict[str, DataFrame], shifts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> dict[str, DataFrame]:
    """Every table that holds a ``person_id``, shifted; the shifts are broadcast if they measure small."""
    side = broadcast_if_small(shifts, broadcast_bytes)
    return {name: shifted(df, side) for name, df in tables.items() if "person_id" in df.columns}
