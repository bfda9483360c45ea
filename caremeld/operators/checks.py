"""Data-quality checks. Each returns its offending rows; no row means the check passes."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by more than one row. Of one column NULL is not judged; of several, NULL is a value like any other."""
    known = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return known.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with the rows that hold them; NULL is not judged."""
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    orphans = child.filter(F.col(column).isNotNull())
    return orphans.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; an unknown (NULL) outcome passes."""
    return df.filter(~F.expr(expression))


def between(df: DataFrame, column: str, low, high, row_condition: str = "true") -> DataFrame:
    """Rows meeting the condition whose value lies outside [low, high]."""
    return df.filter(F.expr(row_condition) & ~F.col(column).between(low, high))


@dataclass(frozen=True)
class Check:
    """One declared check on one column. ``where`` limits the rows it looks at."""

    table: str
    column: str
    kind: str
    category: str = "conformance"
    severity: str = "error"
    where: str | None = None
    arguments: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        target = f"_{self.arguments['parent']}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.table}_{self.column}{target}"

    def rows(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        return df.filter(self.where) if self.where else df

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        df, arguments = self.rows(tables), self.arguments
        if self.kind == "not_null":
            return not_null(df, self.column)
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, arguments["values"])
        if self.kind == "relationships":
            return relationships(df, self.column, tables[arguments["parent"]], arguments["parent_column"])
        if self.kind == "expression_is_true":
            return expression_is_true(df, f"{self.column} {arguments['expression']}")
        if self.kind == "between":
            return between(
                df, self.column, arguments["low"], arguments["high"], arguments.get("row_condition", "true")
            )
        raise ValueError(f"unknown check kind {self.kind}")

    def failing_row(self) -> Column | None:
        """The violation as a condition on one row, for the kinds that need no other row."""
        column, arguments = F.col(self.column), self.arguments
        if self.kind == "not_null":
            bad = column.isNull()
        elif self.kind == "expression_is_true":
            bad = ~F.expr(f"{self.column} {arguments['expression']}")
        elif self.kind == "between":
            outside = ~column.between(arguments["low"], arguments["high"])
            bad = F.expr(arguments.get("row_condition", "true")) & outside
        elif self.kind == "accepted_values":
            bad = ~column.isin(arguments["values"])
        else:
            return None
        return bad & F.expr(self.where) if self.where else bad

    def count(self) -> Column | None:
        """The violations as an aggregate over the table: its failing rows, or the distinct values outside a list."""
        bad = self.failing_row()
        if bad is None:
            return None
        return F.count_distinct(F.when(bad, F.col(self.column))) if self.kind == "accepted_values" else F.count_if(bad)


def _row_level_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of one table that need no other row or table, in a single pass."""
    counts = df.agg(*[check.count().alias(check.name) for check in checks])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c.name).alias("name"), F.col(c.name).alias("violations")) for c in checks]))
    )


def _orphan_count(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan rows, counted from one row per distinct key so that only the keys are shuffled and joined."""
    keys = check.rows(tables).groupBy(check.column).agg(F.count("*").alias("n"))
    arguments = check.arguments
    orphans = relationships(keys, check.column, tables[arguments["parent"]], arguments["parent_column"])
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))


def report(
    checks: list[Check], tables: dict[str, DataFrame], singular: dict[str, tuple[str, str, DataFrame]] | None = None
) -> DataFrame:
    """One row per check: its violations and PASS, WARN or ERROR.

    ``singular`` adds checks that are not tied to one column, as name -> (table, category, offending rows).
    """
    counts = []
    for table in dict.fromkeys(c.table for c in checks):
        single = [c for c in checks if c.table == table and c.failing_row() is not None]
        if single:
            counts.append(_row_level_counts(tables[table], single))
    facts = [(c.name, c.table, c.column, c.category, c.severity) for c in checks]
    for check in checks:
        if check.kind == "relationships":
            counted = _orphan_count(check, tables)
        elif check.failing_row() is None:
            counted = check.violations(tables).agg(F.count("*").alias("violations"))
        else:
            continue
        counts.append(counted.select(F.lit(check.name).alias("name"), "violations"))
    for name, (table, category, rows) in (singular or {}).items():
        facts.append((name, table, None, category, "error"))
        counts.append(rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("name"), "violations"))

    labels = ("table", "column", "category", "severity")
    declared = {
        name: F.struct(*[F.lit(value).cast("string").alias(label) for label, value in zip(labels, rest)])
        for name, *rest in facts
    }
    described = F.create_map(*[x for name, row in declared.items() for x in (F.lit(name), row)])
    clean = F.col("violations") == 0
    return (
        reduce(DataFrame.unionByName, counts)
        .withColumn("_about", described[F.col("name")])
        .select(
            F.col("name").alias("check_name"),
            F.col("_about.table").alias("table_name"),
            F.col("_about.column").alias("column_name"),
            F.col("_about.category").alias("category"),
            F.col("_about.severity").alias("severity"),
            "violations",
            F.when(clean, "PASS").when(F.col("_about.severity") == "warn", "WARN").otherwise("ERROR").alias("status"),
        )
    )
