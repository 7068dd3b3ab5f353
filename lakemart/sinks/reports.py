"""Small report files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, order_by: str = "table_name") -> None:
    """One sorted CSV file with a header. For reports of one row per table only."""
    df.orderBy(order_by).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
