"""Joins that keep the grain of the left side."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.aggregates import measure
from lakemart.functions.columns import named


def enrich(fact: DataFrame, dimension: DataFrame, key: str, *columns: str | Column) -> DataFrame:
    """Left join of ``columns`` of a dimension that is unique on ``key``.

    No hint: Spark broadcasts the dimension when its size allows and otherwise
    shuffles both sides plainly, where AQE can split a hot key.
    """
    return fact.join(dimension.select(key, *columns), on=key, how="left")


def summarize(df: DataFrame, by: str | Column, **metrics: Column) -> DataFrame:
    """One row per ``by`` with the named aggregates."""
    group = named(by) if isinstance(by, str) else by
    return df.groupBy(group).agg(*[m.alias(name) for name, m in metrics.items()])


def preaggregate_join(
    parent: DataFrame, summary: DataFrame, key: str, defaults: Mapping[str, Any]
) -> DataFrame:
    """Left join of a child summary at parent grain; parents without children get defaults.

    The child is aggregated first (see :func:`summarize`), so parent rows and
    their measures are never repeated, and both sides hold one row per key.
    """
    joined = parent.join(summary, on=key, how="left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()}
    )


def fanout_factor(
    parent: DataFrame, child: DataFrame, key: str, amount: str, scale: int = 2
) -> DataFrame:
    """How much a direct one-to-many join would inflate a parent measure.

    (parent_rows, joined_rows, true_total, joined_total, inflation_factor). A parent
    with n children shows up max(n, 1) times in the join, so children are counted
    per key and the inflated join itself is never built. ``amount`` is stated with ``scale``
    decimals.
    """
    children = summarize(child.where(named(key).isNotNull()), key, _children=F.count("*"))
    copies = F.greatest(F.coalesce(F.col("_children"), F.lit(0)), F.lit(1))
    value = measure(amount, scale)
    return (
        parent.select(key, amount)
        .join(children, on=key, how="left")
        .agg(
            F.count("*").alias("parent_rows"),
            F.coalesce(F.sum(copies), F.lit(0)).alias("joined_rows"),
            F.round(F.sum(value).cast("double"), 2).alias("true_total"),
            F.round(F.sum(value * copies).cast("double"), 2).alias("joined_total"),
        )
        .withColumn(
            "inflation_factor",
            F.round(F.try_divide(F.col("joined_total"), F.col("true_total")), 4),
        )
    )
