"""How many people share each combination of quasi-identifiers, and the least generalisation that makes that at least k.

People are counted once by their combination; that table is as small as the domains of its columns. Every step of the
generalisation hierarchy is then judged from these counts, in one pass over them, and never from the people.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUPPRESSED, UNKNOWN = "*", "unknown"


@dataclass(frozen=True)
class Identifier:
    """A quasi-identifier and the widths of its generalised values, from the finest: 1 is the value itself, a larger number
    a band of that many, 0 nothing at all."""

    column: str
    widths: tuple[int, ...] = (1, 0)

    def value(self, level: Column) -> Column:
        """The value at a level, as text; NULL is a value of its own until it is suppressed with the others."""
        known = F.col(self.column)
        out = None
        for place, width in enumerate(self.widths):
            if width == 0:
                text = F.lit(SUPPRESSED)
            elif width == 1:
                text = F.coalesce(known.cast("string"), F.lit(UNKNOWN))
            else:
                low = (F.floor(known / width) * width).cast("long")
                text = F.coalesce(F.concat_ws("-", low.cast("string"), (low + (width - 1)).cast("string")), F.lit(UNKNOWN))
                text = F.when(known.isNull(), UNKNOWN).otherwise(text)
            out = F.when(level == place, text) if out is None else out.when(level == place, text)
        return out


#: What is known of a person of the de-identified layer without being told.
PERSON = (
    Identifier("year_of_birth", (1, 5, 10, 25, 0)),
    Identifier("race_concept_id"),
    Identifier("ethnicity_concept_id"),
    Identifier("gender_concept_id"),
)


def class_sizes(people: DataFrame, identifiers: tuple[Identifier, ...] = PERSON) -> DataFrame:
    """(identifiers, n_people): one row for every combination that occurs."""
    return people.groupBy(*[i.column for i in identifiers]).agg(F.count("*").alias("n_people"))


def generalised_classes(classes: DataFrame, identifiers: tuple[Identifier, ...] = PERSON) -> DataFrame:
    """(levels, identifiers as text, n_people): the classes of every step, a step being the level of each identifier."""
    steps = F.array(*[F.array(*map(F.lit, step)) for step in product(*[range(len(i.widths)) for i in identifiers])])
    each = classes.select("*", F.explode(steps).alias("levels"))
    values = [i.value(F.get("levels", F.lit(place))).alias(i.column) for place, i in enumerate(identifiers)]
    each = each.select("levels", *values, "n_people")
    return each.groupBy("levels", *[i.column for i in identifiers]).agg(F.sum("n_people").alias("n_people"))


def step_report(people: DataFrame, k: int, identifiers: tuple[Identifier, ...] = PERSON, hidden_share: float = 0.0) -> DataFrame:
    """A row for every step of the hierarchy, from the least on, and which one is ``chosen``.

    (levels, height, n_classes, smallest_class, n_small_classes, n_people_at_risk, share_at_risk, chosen). People of classes below
    ``k`` are at risk. A step will do if their share is at most ``hidden_share`` (those would have to be left out). Of steps
    that do, the one with the fewest generalisations is chosen; of equally many the one that keeps more classes, then the
    one with lower levels for later identifiers. Without people there is no row.
    """
    classes = generalised_classes(class_sizes(people, identifiers), identifiers)
    small = F.col("n_people") < k
    counted = classes.groupBy("levels").agg(
        F.count("*").alias("n_classes"),
        F.min("n_people").alias("smallest_class"),
        F.count_if(small).alias("n_small_classes"),
        F.sum(F.when(small, F.col("n_people")).otherwise(0)).alias("n_people_at_risk"),
        F.sum("n_people").alias("n_people"),
    )
    judged = counted.select(
        "levels",
        F.aggregate("levels", F.lit(0), lambda a, x: a + x).alias("height"),
        "n_classes",
        "smallest_class",
        "n_small_classes",
        "n_people_at_risk",
        (F.col("n_people_at_risk") / F.col("n_people")).alias("share_at_risk"),
    )
    will_do = F.col("share_at_risk") <= hidden_share
    order = F.when(will_do, F.struct("height", -F.col("n_classes"), F.reverse("levels")))
    every = Window.partitionBy(F.lit(1))  # as many rows as the hierarchy has steps
    best = F.min_by("levels", order).over(every)
    return judged.withColumn("chosen", F.coalesce(F.col("levels") == best, F.lit(False)))


def small_classes(people: DataFrame, k: int, identifiers: tuple[Identifier, ...] = PERSON) -> DataFrame:
    """The combinations that fewer than ``k`` people share, with how many do."""
    return class_sizes(people, identifiers).where(F.col("n_people") < k)


def generalised(people: DataFrame, levels: list[int], identifiers: tuple[Identifier, ...] = PERSON) -> DataFrame:
    """``people`` with their quasi-identifiers at the given levels, as text."""
    values = {i.column: i.value(F.lit(level)) for i, level in zip(identifiers, levels)}
    return people.withColumns(values)


def anonymous(
    people: DataFrame, k: int, identifiers: tuple[Identifier, ...] = PERSON, hidden_share: float = 0.0
) -> tuple[DataFrame, list[int]]:
    """``people`` at the least step that reaches ``k``, without those who are still at risk there, and the step.

    Raises if no step will do: fewer than ``k`` people in all.
    """
    chosen = step_report(people, k, identifiers, hidden_share).where("chosen").select("levels").first()
    if chosen is None:
        raise ValueError(f"no generalisation makes classes of {k}")
    out, columns = generalised(people, chosen.levels, identifiers), [i.column for i in identifiers]
    large = out.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") >= k).select(*columns)
    return out.join(large, columns, "left_semi").select(*people.columns), list(chosen.levels)
