"""Data-quality operators.

Every check can list its violating rows. All checks of a suite are counted together: each table is
read once and gives, for every check it takes part in, the keys to count or a mark for a broken row;
one grouping by check and key then answers unique, reference and row checks alike. Keys are summed
before the shuffle, so a hot key is one row by then. NULL passes unless a check says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.operators.joins import missing_parents, union_all
from excursio.operators.measures import row_count

Tables = Callable[[str], DataFrame]

ERROR, WARN = "error", "warn"
ROW_KINDS = ("not_null", "accepted_values", "expression")


class CheckFailed(Exception):
    """Raised with the summary rows of every failed check at once."""

    def __init__(self, failures: Sequence) -> None:
        self.failures = list(failures)
        lines = [f"- {f['table']}.{f['check']}: {f['violations']}" for f in self.failures]
        super().__init__("data-quality checks failed:\n" + "\n".join(lines))


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    severity: str = ERROR
    values: tuple[str, ...] = ()
    expression: str = ""
    parent: str = ""
    field: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}:{','.join(self.columns)}"

    def broken(self) -> Column:
        """Condition of a violating row, for row-level kinds."""
        column = F.col(self.columns[0])
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.values)
        return ~F.expr(self.expression)

    def violations(self, tables: Tables) -> DataFrame:
        """Violating rows, or violating keys with their row counts."""
        table = tables(self.table)
        if self.kind in ROW_KINDS:
            return table.filter(self.broken())
        if self.kind == "relationships":
            return missing_parents(table, self.columns, tables(self.parent), [self.field])
        counted = table.dropna("any", subset=list(self.columns)) if self.kind == "unique" else table
        return counted.groupBy(*self.columns).agg(row_count("n_rows")).filter("n_rows > 1")

    def probes(self) -> list[tuple[str, Column, Column]]:
        """What the check counts: (table, key or null for none, whether its rows are own or known ones)."""
        key = _key([F.col(c) for c in self.columns])
        own, known = F.lit(True), F.lit(False)
        if self.kind in ROW_KINDS:
            return [(self.table, F.when(self.broken(), F.lit("")), own)]
        if self.kind == "unique_combination":
            return [(self.table, key, own)]
        present = F.when(F.greatest(*[F.col(c).isNull() for c in self.columns], F.lit(False)), None).otherwise(key)
        if self.kind == "unique":
            return [(self.table, present, own)]
        field = F.col(self.field)
        return [(self.table, present, own), (self.parent, F.when(field.isNotNull(), _key([field])), known)]

    def found(self) -> Column:
        """Violations, from the sums over the check's keys."""
        if self.kind in ROW_KINDS:
            return F.col("rows")
        return F.col("unknown_rows" if self.kind == "relationships" else "repeated_keys")

    def labels(self) -> list[Column]:
        return [
            F.lit(self.name).alias("check"),
            F.lit(self.table).alias("table"),
            F.lit(",".join(self.columns)).alias("column"),
            F.lit(self.severity).alias("severity"),
        ]


def _key(columns: Sequence[Column]) -> Column:
    """One text for a key; NULL in a part of it is a value of its own."""
    return F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns])


def summarise(tables: Tables, checks: Iterable[Check]) -> DataFrame:
    """One row per check: check, table, column, severity, violations. Every table is read once."""
    checks = list(checks)
    entries: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        for table, key, own in check.probes():
            entry = F.struct(F.lit(number).alias("number"), key.alias("key"), own.alias("own"))
            entries.setdefault(table, []).append(F.when(key.isNotNull(), entry))
    parts = [tables(t).select(F.inline(F.array_compact(F.array(*found)))) for t, found in entries.items()]
    keys = union_all(parts).groupBy("number", "key").agg(F.count_if("own").alias("n"), F.bool_or(~F.col("own")).alias("known"))
    sums = keys.groupBy("number").agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("unknown_rows"),
    )
    declared = [F.struct(F.lit(i).alias("number"), *c.labels()) for i, c in enumerate(checks)]
    listed = sums.sparkSession.range(1).select(F.inline(F.array(*declared)))
    violations = F.lit(None).cast("bigint")
    for number, check in enumerate(checks):
        violations = F.when(F.col("number") == number, check.found()).otherwise(violations)
    counted = sums.select("number", violations.alias("violations"))
    joined = listed.join(counted, "number", "left")
    return joined.select("check", "table", "column", "severity", F.coalesce("violations", F.lit(0)).alias("violations"))


def enforce(summary: DataFrame) -> list:
    """Raise when any ``error`` check has violations; return the ``warn`` findings."""
    found = summary.filter("violations > 0").collect()  # one row per declared check at most
    failures = [row for row in found if row["severity"] == ERROR]
    if failures:
        raise CheckFailed(failures)
    return found


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def outside_range(column: str, low: float, high: float) -> Column:
    """Rows outside [low, high]; NULL fails."""
    return ~F.coalesce(F.col(column).between(low, high), F.lit(False))


def not_true(condition: Column) -> Column:
    """Rows for which the condition is false or unknown; NULL fails."""
    return ~F.coalesce(condition, F.lit(False))


def repeated_rows(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows repeat a key seen before (NULL counts as a key)."""
    counted = df.groupBy(key).agg(row_count("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))


def unknown_values(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Distinct child values the parent lacks; NULL is one of them."""
    known = parent.select(F.col(field).alias(column))
    return child.select(column).distinct().join(known, column, "left_anti")


def labelled(df: DataFrame, **labels: str) -> DataFrame:
    """Put constant label columns in front."""
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")


def counted(df: DataFrame, conditions: dict[str, Column], **labels: str) -> DataFrame:
    """One row per condition (``rule``, ``violations``), all counted in one pass; none without any."""
    if not conditions:
        none = df.sparkSession.createDataFrame([], "rule string, violations bigint")
        return labelled(none, **labels)
    counts = df.agg(*[F.count_if(c).alias(f"v{i}") for i, c in enumerate(conditions.values())])
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, rule in enumerate(conditions)
    ]
    return labelled(counts.select(F.inline(F.array(*rows))), **labels)
