"""Bronze job: check the delivery, land every file, describe it."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from lakemart.plans.concurrent import each
from lakemart.plans.logistics import SPECS
from lakemart.sinks.landing import SUMMARY_SCHEMA, land, manifest, manifest_row, write_manifest
from lakemart.sources.ranges import Quoting
from lakemart.sources.raw import check_tables, list_deliveries

log = logging.getLogger(__name__)


def run_bronze(
    spark: SparkSession,
    source: str,
    lake: str,
    expected: Iterable[str] = tuple(SPECS),
    quoting: Quoting = Quoting(),
) -> DataFrame:
    """Land every table delivered in a folder; returns the run summary.

    A missing expected table stops the run before anything lands. A table that
    fails later is reported as FAILED and does not stop the others.
    """
    deliveries = list_deliveries(spark, source)
    check_tables(deliveries, expected)

    def ingest(found) -> tuple[tuple | None, tuple]:
        table = found.table_name
        target = f"{lake}/bronze/{table}/{found.source_file}"
        try:
            landed = land(spark, found.path, target, quoting)
            row = manifest_row(
                spark, table, found.source_file, found.size_bytes, target, landed, quoting
            )
            return row, (table, "SUCCESS", landed.rows, row[5], None)
        except Exception as error:  # one bad table must not stop the rest
            log.error("%s: %s", table, error)
            return None, (table, "FAILED", None, None, str(error))

    # One row per delivered table: control data, not the batch itself.
    landed = each(spark, ingest, deliveries.orderBy("table_name", "source_file").collect())
    described = [row for row, _ in landed if row is not None]
    if described:
        write_manifest(manifest(spark, described), f"{lake}/metadata/bronze_manifest")
    return spark.createDataFrame([summary for _, summary in landed], SUMMARY_SCHEMA)
