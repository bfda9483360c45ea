"""What the text operators share: written intermediate tables, column names that clash with nothing, batches."""

from __future__ import annotations

import sys
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.session import new_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its plan starts anew there, and lost executors redo nothing."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def col(name: str) -> Column:
    """The column of exactly this name, also if it holds dots or backticks."""
    return F.col(f"`{name.replace('`', '``')}`")


def kept_in_process(key: object, make: Callable[[], object], most: int = 4, only: str = "") -> object:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks; the latest few are kept.

    With ``only``, keys are tuples that begin with it, and what others of that beginning hold is let go first.

    Functions travel by value, so a variable of this module would start empty in every task.
    """
    place = sys.modules.setdefault("kept_in_this_process", ModuleType("kept_in_this_process"))
    held = vars(place).setdefault("held", OrderedDict())
    if key not in held:
        for other in [k for k in held if only and k[0] == only]:
            del held[other]
        held[key] = make()
    held.move_to_end(key)
    while len(held) > most:
        held.popitem(last=False)
    return held[key]


def per_text(make: Callable[[], Callable[[str], object]], schema: str, only: str = ""):
    """An Arrow-fed function of a text column; ``make`` runs once a worker, a null text counts as empty.

    A schema of named fields takes tuples, that of one type plain values. Of what is made for the same ``only``, a worker
    holds the latest alone.
    """
    key = (only, uuid.uuid4().hex)
    if " " in schema:
        names = [field.split()[0] for field in schema.split(", ")]

        @F.pandas_udf(schema)
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            one = kept_in_process(key, make, only=only)
            for texts in batches:
                yield pd.DataFrame([one(text if isinstance(text, str) else "") for text in texts], columns=names)

    else:

        @F.pandas_udf(schema)
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            one = kept_in_process(key, make, only=only)
            for texts in batches:
                out = [one(text if isinstance(text, str) else "") for text in texts]
                yield pd.Series(out) if out else pd.Series([], dtype=object)

    return apply


def slices(n: int, size: int) -> Iterable[tuple[int, int]]:
    return ((i, min(i + size, n)) for i in range(0, n, size))
