"""Lookups that are broadcast only when they are measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 32


def measured_bytes(lookup: DataFrame) -> int:
    """What the rows take in memory, from one aggregation over the lookup."""
    parts = [
        F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long") if f.dataType == T.StringType() else F.lit(8)
        for f in lookup.schema
    ]
    row = sum(parts, F.lit(_ROW_OVERHEAD))
    return lookup.agg(F.coalesce(F.sum(row), F.lit(0)).cast("long")).first()[0]


def broadcast_if_small(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The lookup, marked for broadcast when its measured size is within the limit.

    The facts that join it are then not shuffled at all. Beyond the limit it stays as it is: Spark sort-merges and splits
    the hot keys of the facts at run time.
    """
    return F.broadcast(lookup) if measured_bytes(lookup) <= limit else lookup
