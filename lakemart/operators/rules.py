"""Validity rules.

A rule is stated once, as the SQL predicate of an invalid row; a valid row is any
other row, also when the predicate is unknown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Rows matching ``invalid`` are rejected with ``reason``."""

    reason: str
    invalid: str

    @property
    def broken(self) -> Column:
        return F.coalesce(F.expr(self.invalid), F.lit(False))


def inexact(columns: Sequence[str], places: int) -> str:
    """SQL predicate of doubles of which one is no number of so many decimals; NaN and infinity are none.

    Plain comparisons, which stay inside code generation; a lambda over an array does not.
    """
    unit = f"1e{places}D"

    def off(x: str) -> str:
        noise = f"greatest(abs({x}) * {2.0**-40!r}D, 1e-{places + 6}D)"
        return f"({x} IS NOT NULL AND NOT abs(rint({x} * {unit}) / {unit} - {x}) <= {noise})"

    return " OR ".join(map(off, columns))


def invalid_rows(df: DataFrame, rule: Rule) -> DataFrame:
    # A filter drops unknown anyway; the bare predicate can be pushed into the scan.
    return df.where(rule.invalid)


def valid_rows(df: DataFrame, rule: Rule) -> DataFrame:
    return df.where(~rule.broken)


def first_broken(rules: Sequence[Rule]) -> Column:
    """Reason of the first broken rule, NULL for a valid row."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(r.broken, F.lit(r.reason)) for r in rules])


def missing_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNull())


def present_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def violation_counts(df: DataFrame, table: str, checks: Mapping[str, str]) -> DataFrame:
    """Rows breaking each check: (table_name, rule, violations), from one scan."""
    counts = df.agg(*[F.count_if(F.expr(check)).alias(name) for name, check in checks.items()])
    return counts.unpivot([], list(checks), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )
