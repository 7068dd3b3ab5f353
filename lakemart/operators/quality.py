"""Gates, grain checks, control totals and the quality report.

Reports are one row per table and stay DataFrames; only such rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.aggregates import exact_sum
from lakemart.functions.columns import named

TOLERANCE = 0.01
_NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)


class GateFailed(ValueError):
    """A gate refused a batch; nothing downstream may be published."""


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns the negative-value check covers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def grain_check(marts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, row_count, distinct_keys, status): rows exist and keys are unique.

    NULL counts as one key. One aggregation per mart, pre-aggregated per key.
    """

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(named(key)).agg(F.count("*").alias("_n"))
        return per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.count("*").alias("distinct_keys"),
        ).select(
            F.lit(name).alias("table_name"),
            "row_count",
            "distinct_keys",
            F.when(
                (F.col("row_count") > 0) & (F.col("row_count") == F.col("distinct_keys")), "PASS"
            )
            .otherwise("FAIL")
            .alias("status"),
        )

    return _union(one(n, df, key) for n, (df, key) in marts.items())


def key_assertions(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, null_keys, duplicate_keys, status) per table."""

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(named(key).alias("_key")).agg(F.count("*").alias("_n"))
        return per_key.agg(
            F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias(
                "null_keys"
            ),
            _count(F.col("_n") > 1).alias("duplicate_keys"),
        ).select(
            F.lit(name).alias("table_name"),
            "null_keys",
            "duplicate_keys",
            F.when((F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0), "PASS")
            .otherwise("FAIL")
            .alias("status"),
        )

    return _union(one(n, df, key) for n, (df, key) in tables.items())


def quality_report(marts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, columns, key defects and negative values per mart.

    FAIL without rows or with NULL or duplicate keys, WARNING with negative
    numbers, else PASS. All figures of a mart come from one aggregation.
    """

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        negatives = [
            F.when(named(c) < 0, 1).otherwise(0).cast("bigint") for c in numeric_columns(df)
        ]
        in_row = reduce(lambda a, b: a + b, negatives, F.lit(0).cast("bigint"))
        per_key = df.groupBy(named(key).alias("_key")).agg(
            F.count("*").alias("_n"), F.sum(in_row).alias("_negative")
        )
        figures = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias(
                "null_primary_keys"
            ),
            _count(F.col("_n") > 1).alias("duplicate_primary_keys"),
            F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_numeric_values"),
        )
        failed = (
            (F.col("row_count") == 0)
            | (F.col("null_primary_keys") > 0)
            | (F.col("duplicate_primary_keys") > 0)
        )
        return figures.select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(key).alias("primary_key"),
            "null_primary_keys",
            "duplicate_primary_keys",
            "negative_numeric_values",
            F.when(failed, "FAIL")
            .when(F.col("negative_numeric_values") > 0, "WARNING")
            .otherwise("PASS")
            .alias("validation_status"),
        )

    return _union(one(n, df, key) for n, (df, key) in marts.items())


def control_total(df: DataFrame, column: str, scale: int = 6) -> Column:
    """The total of a column of ``scale`` decimals as a scalar subquery; 0 for an empty table."""
    amount = F.coalesce(exact_sum(column, scale).cast("double"), F.lit(0.0))
    return df.agg(F.round(amount, 2).alias("total")).scalar()


def control_totals(
    silver: DataFrame,
    marts: Mapping[str, tuple[DataFrame, str]],
    column: str,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row: the Silver total of ``column``, each mart's total, and PASS or FAIL."""
    one_row = silver.sparkSession.range(1)
    totals = one_row.select(
        control_total(silver, column).alias("silver_total"),
        *[control_total(df, c).alias(f"{name}_total") for name, (df, c) in marts.items()],
    )
    off = [F.abs(F.col("silver_total") - F.col(f"{name}_total")) > tolerance for name in marts]
    return totals.withColumn(
        "status", F.when(reduce(lambda a, b: a | b, off), "FAIL").otherwise("PASS")
    )


def batch_gate(df: DataFrame, column: str) -> DataFrame:
    """(row_count, negative_rows, status): a batch passes with rows and no negative value."""
    return df.agg(
        F.count("*").alias("row_count"), _count(named(column) < 0).alias("negative_rows")
    ).withColumn(
        "status",
        F.when((F.col("row_count") > 0) & (F.col("negative_rows") == 0), "PASS").otherwise("FAIL"),
    )


def presence_gate(tables: Mapping[str, DataFrame | None], required: Iterable[str]) -> None:
    """Raise unless every required table exists and holds a row."""
    bad = [n for n in required if tables.get(n) is None or tables[n].isEmpty()]
    if bad:
        raise GateFailed(f"missing or empty: {bad}")


def require_pass(
    report: DataFrame, what: str, status: str = "status", bad: tuple[str, ...] = ("FAIL",)
) -> list:
    """Rows of a report, or GateFailed when the status of one of them is in ``bad``."""
    rows = report.collect()
    failed = [r.asDict() for r in rows if r[status] in bad]
    if failed:
        raise GateFailed(f"{what}: {failed}")
    return rows
