"""Foreign-key checks.

A NULL foreign key has no parent and is an orphan. Parents that are unique on
their key (any Silver table) join directly: both sides are then plain exchanges,
which is the shape AQE can split when one foreign key, or NULL, is hot. Small parents
become broadcast joins by their measured size. Nothing is hinted here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must occur in ``parent_column`` of table ``parent``."""

    column: str
    parent: str
    parent_column: str
    reason: str


def parent_keys(parent: DataFrame, column: str, unique: bool, alias: str) -> DataFrame:
    """Key column of a parent, one row per key.

    Duplicate parents are reduced before they are shuffled. The rebalance makes
    the join shuffle the reduced keys anew, so that AQE may still split a hot child
    partition (it does not look through an aggregate).
    """
    keys = parent.select(named(column).alias(alias)).where(F.col(alias).isNotNull())
    return keys if unique else keys.distinct().hint("rebalance")


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, unique: bool = False
) -> DataFrame:
    """Child rows without a parent, NULL keys included."""
    keys = parent_keys(parent, parent_column, unique, "_parent_key")
    return child.join(keys, named(column) == F.col("_parent_key"), "left_anti")


def valid_fk(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, unique: bool = False
) -> DataFrame:
    """Child rows that have a parent."""
    keys = parent_keys(parent, parent_column, unique, "_parent_key")
    return child.join(keys, named(column) == F.col("_parent_key"), "left_semi")


def with_fk_reason(
    child: DataFrame,
    edges: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    reason: str,
    unique: bool = True,
) -> DataFrame:
    """Add ``reason``: that of the first failing edge, NULL when all edges hold.

    One left join per edge answers both "orphan" and "valid", and rows are
    never filtered in between, so the frame is computed once.
    """
    failed: list[Column] = []
    markers: list[str] = []
    joined = child
    for i, edge in enumerate(edges):
        marker = f"_parent_key_{i}"
        keys = parent_keys(parents[edge.parent], edge.parent_column, unique, marker)
        joined = joined.join(keys, named(edge.column) == F.col(marker), "left")
        failed.append(F.when(F.col(marker).isNull(), F.lit(edge.reason)))
        markers.append(marker)
    first = F.coalesce(*failed) if failed else F.lit(None).cast("string")
    return joined.withColumn(reason, first).drop(*markers)


def orphan_profile(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str
) -> DataFrame:
    """One row per relationship: distinct orphan values and non-NULL child rows.

    One aggregation over both sides: rows of a hot key shrink before the shuffle, each side is
    shuffled once and nothing is sorted. Keys of two types are compared as their common one.
    """
    types = [child.select(named(column)).schema[0].dataType, parent.select(named(parent_column)).schema[0].dataType]
    both = F.coalesce(*[F.lit(None).cast(t) for t in types]).alias("_key")
    common = child.sparkSession.range(0).select(both).schema[0].dataType

    def side(df: DataFrame, key: str, is_child: bool) -> DataFrame:
        marks = F.lit(is_child).alias("_is_child"), F.lit(not is_child).alias("_is_parent")
        return df.where(named(key).isNotNull()).select(named(key).cast(common).alias("_key"), *marks)

    matched = (
        side(child, column, True)
        .unionByName(side(parent, parent_column, False))
        .groupBy("_key")
        .agg(F.count_if("_is_child").alias("_rows"), F.some("_is_parent").alias("_known"))
    )
    return matched.agg(
        F.count_if((F.col("_rows") > 0) & ~F.col("_known")).alias("orphan_values"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("non_null_rows"),
    ).select(
        F.lit(name).alias("relationship"),
        "orphan_values",
        "non_null_rows",
        F.when(F.col("orphan_values") == 0, "PASS").otherwise("WARNING").alias("status"),
    )
