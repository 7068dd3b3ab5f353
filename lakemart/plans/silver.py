"""Silver job: type, check, deduplicate and publish every table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.quarantine import REASON, accepted, classify
from lakemart.plans.concurrent import each
from lakemart.plans.logistics import SPECS
from lakemart.plans.spec import TableSpec
from lakemart.session import hashed_joins
from lakemart.sinks.paths import delete, name_of
from lakemart.sinks.quarantine import outcome_counts, write_batch
from lakemart.sinks.reports import write_report
from lakemart.sources.ranges import Quoting
from lakemart.sources.raw import read_bronze
from lakemart.sources.tables import ACCEPTED
from lakemart.sources.versions import current, new_run, publish, versions


def classify_all(
    raw: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = SPECS
) -> dict[str, DataFrame]:
    """Every table classified, as one lazy plan. Parents come before children in ``specs``.

    Children see the accepted rows of their parents, so a rejected parent takes its
    children along. For jobs use :func:`run_silver`, which writes each table once
    instead of computing parents again for every child.
    """
    classified: dict[str, DataFrame] = {}
    parents: dict[str, DataFrame] = {}
    for name, spec in specs.items():
        classified[name] = classify(raw[name], spec, parents)
        parents[name] = accepted(classified[name])
    return classified


def run_silver(
    spark: SparkSession,
    lake: str,
    raw: Mapping[str, DataFrame] | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
    quoting: Quoting = Quoting(),
    dealt: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Build all Silver tables, then publish them together; returns rows per table and outcome.

    Per table there is one read of the batch (``write_batch``). The written table cuts the
    lineage: children check their keys against Parquet, and a lost executor costs the
    running table only. Tables whose parents are written are built side by side. Readers see
    the former tables until all are written (``versions``): if one fails, none changes.

    ``dealt`` names tables with a join key and a number of buckets: their files are dealt and sorted by
    it and known to the session's catalog, so that marts join and sum them without a shuffle of
    theirs. A session whose catalog does not know them reads the same files plainly.
    """
    published: dict[str, DataFrame] = {}
    layer = f"{lake}/silver"
    folder = new_run(layer)
    noted: dict[str, dict] = {}

    def build(name: str) -> tuple[DataFrame, list[tuple]]:
        batch = raw[name] if raw is not None else read_bronze(spark, lake, name, quoting=quoting)
        path = f"{folder}/{name}"
        table, by = None, (dealt or {}).get(name)
        if by is not None:
            table = f"silver_{name}_{name_of(folder)}"
        schema = write_batch(batch, specs[name], published, path, table, *(by or ()))
        counts = outcome_counts(spark, path, schema, name).collect()
        rejected = any(r.outcome != ACCEPTED for r in counts)
        noted[name] = {"run": name_of(folder), "schema": schema.jsonValue(), "rejected": rejected, "table": table}
        written = spark.read.schema(schema).parquet(path)
        return written.where(F.col(REASON) == ACCEPTED).drop(REASON), [tuple(r) for r in counts]

    try:
        with hashed_joins(spark):
            counts = _build_in_order(spark, specs, published, build)
    except Exception:
        for name in dealt or {}:
            spark.sql(f"DROP TABLE IF EXISTS silver_{name}_{name_of(folder)}")
        delete(spark, folder)
        raise
    former = list(versions(spark, layer))
    built_from = current(spark, f"{lake}/gold")
    publish(spark, layer, folder, noted, keep=[built_from.tables["silver"]["of"]] if built_from else ())
    kept = {t.get("table") for v in versions(spark, layer) for t in v.tables.values()}
    for table in {t.get("table") for v in former for t in v.tables.values()} - kept:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    outcomes = spark.createDataFrame(
        counts, "table_name string, outcome string, row_count long"
    )
    write_report(silver_report(outcomes, specs), f"{lake}/reports/silver_quality_report")
    return outcomes


def _build_in_order(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    published: dict[str, DataFrame],
    build: Callable[[str], tuple[DataFrame, list[tuple]]],
) -> list[tuple]:
    """Every table after its parents; those of one generation side by side."""
    counts: list[tuple] = []
    while len(published) < len(specs):
        ready = [
            n
            for n, spec in specs.items()
            if n not in published and all(e.parent in published for e in spec.foreign_keys)
        ]
        if not ready:
            raise ValueError(f"foreign keys form a cycle: {sorted(set(specs) - set(published))}")
        for name, (table, rows) in zip(ready, each(spark, build, ready)):
            published[name] = table
            counts += rows
    return counts


def silver_report(outcomes: DataFrame, specs: Mapping[str, TableSpec] = SPECS) -> DataFrame:
    """(table_name, silver_row_count, processed_at_utc); tables without rows show 0."""
    spark = outcomes.sparkSession
    names = spark.createDataFrame([(n,) for n in specs], "table_name string")
    kept = outcomes.where(F.col("outcome") == ACCEPTED).groupBy("table_name").agg(
        F.sum("row_count").alias("_rows")
    )
    return names.join(kept, "table_name", "left").select(
        "table_name",
        F.coalesce("_rows", F.lit(0)).alias("silver_row_count"),
        F.current_timestamp().alias("processed_at_utc"),
    )


def conservation(raw: DataFrame, classified: DataFrame, table: str) -> DataFrame:
    """(table_name, bronze, silver, quarantined, superseded) row counts of one table."""
    outcome = classified.agg(
        F.count_if(F.col(REASON).isNull()).alias("silver_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("quarantined_rows"),
    )
    bronze = raw.agg(F.count("*").alias("n")).scalar()
    return outcome.select(
        F.lit(table).alias("table_name"), bronze.alias("bronze_rows"), "silver_rows",
        "quarantined_rows",
    ).withColumn(
        "superseded_rows",
        F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantined_rows"),
    )
