"""Rule engine: a contract is one aggregate pass over its table.

A row rule names a condition that marks bad rows. A table rule is an aggregate that
yields the number of failures itself. All rules of a contract are evaluated in one
`agg`, so a table of any size is scanned once, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(RuntimeError):
    """A violated contract, with what was expected and what was found."""

    def __init__(self, table: str, contract: str, expected: object, actual: object):
        super().__init__(f"{table}: {contract}: expected {expected}, found {actual}")
        self.table, self.contract, self.expected, self.actual = table, contract, expected, actual


@dataclass(frozen=True)
class Rule:
    """`failures` is an aggregate expression; `bad` marks the violating rows where rows can be named."""

    name: str
    failures: Column
    bad: Column | None = None


def row_rule(name: str, bad: Column) -> Rule:
    return Rule(name, F.count_if(bad), bad)


def not_null(column: str) -> Rule:
    return row_rule(f"not_null_{column}", F.col(column).isNull())


def accepted(column: str, values: Iterable) -> Rule:
    """Values outside the list; null is left to `not_null`."""
    return row_rule(f"accepted_{column}", ~F.col(column).isin(*values))


def unique(*columns: str) -> Rule:
    """Rows beyond the first of each key; keys with a null are left to `not_null`."""
    key = F.when(_all_known(columns), F.lit(1))
    return Rule("unique_" + "_".join(columns), F.count(key) - F.count_distinct(*columns))


def grain(*columns: str) -> Rule:
    """Rows beyond the number of distinct keys; null counts as a key like any other."""
    if len(columns) == 1:
        # Counted as other rules count the column, so that Spark does not expand the rows once more for it.
        missing = F.coalesce(F.max(F.col(columns[0]).isNull().cast("int")), F.lit(0))
        keys = F.count_distinct(*columns) + missing
    else:
        keys = F.count_distinct(F.struct(*columns))  # never null itself, so rows with null keys are counted
    return Rule("grain_" + "_".join(columns), F.count(F.lit(1)) - keys)


def not_empty() -> Rule:
    return Rule("not_empty", (F.count(F.lit(1)) == 0).cast("long"))


def expected_value(name: str, actual: Column, expected: object) -> Rule:
    """1 when the aggregate differs from the expected value (null differs too)."""
    return Rule(name, (~actual.eqNullSafe(F.lit(expected))).cast("long"))


def expected_rows(count: int | None) -> list[Rule]:
    return [] if count is None else [expected_value("expected_rows", F.count(F.lit(1)), count)]


def total_equals(column: str, expected: int | None) -> list[Rule]:
    if expected is None:
        return []
    return [expected_value(f"total_{column}", F.coalesce(F.sum(column), F.lit(0)), expected)]


def _all_known(columns: Iterable[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def evaluate(rows: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: table_name, check, failures, status (pass or fail)."""
    counted = rows.agg(*[rule.failures.alias(f"r{i}") for i, rule in enumerate(rules)])
    entries = [
        F.struct(F.lit(rule.name).alias("check"), F.col(f"r{i}").cast("long").alias("failures"))
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("table_name"),
        "e.check",
        "e.failures",
        F.when(F.col("e.failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def violations(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Violating rows with the sorted names of the rules they break."""
    broken = [F.when(rule.bad, F.lit(rule.name)) for rule in rules if rule.bad is not None]
    marked = rows.withColumn("broken_rules", F.array_sort(F.array_compact(F.array(*broken))))
    return marked.where(F.size("broken_rules") > 0)


def require_all(results: DataFrame) -> DataFrame:
    """Raise for the first failed check; returns the results otherwise.

    A result table holds one row per rule, so looking at one failed row is all that
    reaches the driver.
    """
    failed = results.where("status = 'fail'").orderBy("table_name", "check").limit(1).collect()
    if failed:
        row = failed[0]
        raise ContractError(row["table_name"], row["check"], 0, row["failures"])
    return results


def require_none(table: str, contract: str, problems: list[str]) -> None:
    """Raise for problems found on the driver, such as those of a header or a schema."""
    if problems:
        raise ContractError(table, contract, "no problem", "; ".join(problems))
