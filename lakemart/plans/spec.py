"""Declarative description of a Silver table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import clean_id, named, safe_cast
from lakemart.operators.integrity import ForeignKey
from lakemart.operators.rules import Rule


@dataclass(frozen=True)
class Restatement:
    """Replace ``column`` by SQL ``value`` where all ``needs`` columns exist."""

    column: str
    needs: tuple[str, ...]
    value: str


@dataclass(frozen=True)
class TableSpec:
    """How raw text becomes a Silver table.

    ``optional`` names cast columns a batch may lack; all other named columns are required.
    """

    name: str
    key: str
    casts: Mapping[str, str] = field(default_factory=dict)
    recency: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    restatements: tuple[Restatement, ...] = ()
    optional: tuple[str, ...] = ("updated_at",)
    missing_key_reason: str = "missing_primary_key"

    @property
    def id_columns(self) -> tuple[str, ...]:
        return (self.key, *[e.column for e in self.foreign_keys])

    @property
    def required(self) -> list[str]:
        """Columns a batch must bring."""
        wanted = [*self.id_columns, *self.casts]
        return [c for c in dict.fromkeys(wanted) if c not in self.optional]

    @property
    def all_rules(self) -> tuple[Rule, ...]:
        """The key rule first, then the business rules."""
        return (Rule(self.missing_key_reason, f"`{self.key}` IS NULL"), *self.rules)

    @property
    def reasons(self) -> list[str]:
        """Every reason a row of this table can be rejected with, in order."""
        return [r.reason for r in self.all_rules] + [e.reason for e in self.foreign_keys]


def conform(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns and clean identifiers; unlisted columns pass through."""
    absent = [c for c in spec.required if c not in raw.columns]
    if absent:
        raise ValueError(f"{spec.name}: columns missing: {absent}")
    changed = {c: clean_id(c) for c in spec.id_columns}
    changed |= {c: safe_cast(c, t) for c, t in spec.casts.items() if c in raw.columns}
    return raw.select(
        *[changed[c].alias(c) if c in changed else named(c) for c in raw.columns]
    )


def restate(df: DataFrame, spec: TableSpec, where: Column | None = None) -> DataFrame:
    """Apply the restatements whose columns are all present, to rows matching ``where``."""
    usable = [r for r in spec.restatements if set(r.needs) <= set(df.columns)]
    if not usable:
        return df
    where = F.lit(True) if where is None else where
    return df.withColumns(
        {r.column: F.when(where, F.expr(r.value)).otherwise(F.col(r.column)) for r in usable}
    )
