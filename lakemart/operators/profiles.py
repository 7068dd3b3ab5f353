"""Profiles of a table: duplicates, value frequencies, expected sizes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named


def duplicate_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, duplicate_rows): rows equal to an earlier row in all columns."""

    def one(name: str, df: DataFrame) -> DataFrame:
        copies = df.groupBy(*[named(c) for c in df.columns]).agg(F.count("*").alias("_copies"))
        return copies.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        ).select(F.lit(name).alias("table_name"), "row_count", "duplicate_rows")

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def frequency_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Share of each value combination among the rows that have all ``columns``."""
    known = df.dropna(subset=list(columns))
    counts = known.groupBy(*columns).agg(F.count("*").alias("frequency"))
    whole = counts.agg(F.sum("frequency")).scalar()
    return counts.withColumn("relative_frequency", F.try_divide(F.col("frequency"), whole))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def row_count_check(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual against expected sizes; ``expected`` holds (table_name, expected_rows)."""
    return (
        row_counts(tables)
        .join(expected, "table_name", "left")
        .select(
            "table_name",
            "row_count",
            "expected_rows",
            F.when(F.equal_null("row_count", "expected_rows"), "PASS")
            .otherwise("FAIL")
            .alias("status"),
        )
    )
