"""End-to-end run with its gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.quality import presence_gate
from lakemart.plans.bronze import run_bronze
from lakemart.plans.gold import run_gold, validate_gold
from lakemart.plans.logistics import GATED_GOLD, GATED_SILVER
from lakemart.plans.silver import run_silver
from lakemart.sources.ranges import Quoting
from lakemart.sources.tables import read_gold, read_silver


def _tables(read, spark: SparkSession, lake: str, names) -> dict[str, DataFrame | None]:
    found: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            found[name] = read(spark, lake, name)
        except FileNotFoundError:
            found[name] = None
    return found


def silver_gate(spark: SparkSession, lake: str) -> None:
    """Required Silver tables exist and hold rows; otherwise Gold must not run."""
    presence_gate(_tables(read_silver, spark, lake, GATED_SILVER), GATED_SILVER)


def published_gate(spark: SparkSession, lake: str) -> None:
    """The headline marts exist and hold rows."""
    presence_gate(_tables(read_gold, spark, lake, GATED_GOLD), GATED_GOLD)


def run(
    spark: SparkSession,
    lake: str,
    source: str | None = None,
    mode: str = "replace",
    quoting: Quoting = Quoting(),
) -> DataFrame:
    """Bronze (when ``source`` is given), Silver, gate, Gold, gate, report.

    Each step starts only when the one before passed. Running again with the
    same input publishes the same rows.
    """
    if source is not None:
        run_bronze(spark, source, lake, quoting=quoting)
    run_silver(spark, lake, quoting=quoting)
    silver_gate(spark, lake)
    run_gold(spark, lake, mode)
    published_gate(spark, lake)
    return validate_gold(spark, lake)
