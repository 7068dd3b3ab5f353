"""Replace and upsert of Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named
from lakemart.operators.quality import GateFailed, key_assertions
from lakemart.sinks.paths import (
    children,
    delete,
    exists,
    name_of,
    parked,
    recover,
    recover_partitions,
    staging_path,
    swap_in,
)
from lakemart.sources.tables import read_path

INGESTED_AT = "last_ingested_at"


def stamped(df: DataFrame) -> DataFrame:
    """Add the time of this publication."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def stage(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` next to ``target``; returns the staged path."""
    staged = staging_path(target)
    try:
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(staged)
    except Exception:
        delete(df.sparkSession, staged)
        raise
    return staged


def replace(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh. ``df`` may read ``target``: it is swapped only after the write."""
    swap_in(df.sparkSession, stage(df, target, partition_by), target)


def merged(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` whose key ``source`` lacks, and all rows of ``source``.

    ``source`` must be unique and non-NULL on the key; a NULL key would match nothing and be
    inserted again on every run.
    """
    kept = target.join(source.select(key), on=key, how="left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def check_keys(source: DataFrame, key: str) -> None:
    """Raise when merge keys are NULL or repeated."""
    found = key_assertions({"source": (source, key)}).first()
    if found.status == "FAIL":
        raise GateFailed(
            f"merge key {key}: {found.null_keys} NULL, {found.duplicate_keys} repeated"
        )


def stage_upsert(source: DataFrame, target: str, key: str) -> str:
    """Stage the result of an upsert into ``target`` without publishing it."""
    spark = source.sparkSession
    recover(spark, target)
    batch = stage(source, target)
    try:
        written = read_path(spark, batch, source.schema)
        check_keys(written, key)
        first = not exists(spark, target)
        staged = batch if first else stage(merged(read_path(spark, target), written, key), target)
    except Exception:
        delete(spark, batch)
        raise
    if not first:
        delete(spark, batch)
    return staged


def upsert(source: DataFrame, target: str, key: str) -> None:
    """Update matching keys and insert new ones; other rows stay, nothing is deleted.

    The batch is computed once into a staged folder, then checked and merged from there.
    A plain Parquet folder has no row-level update, so the target is rewritten; for
    large tables use :func:`upsert_table` or :func:`overwrite_partitions`.
    """
    swap_in(source.sparkSession, stage_upsert(source, target, key), target)


def upsert_partitions(
    source: DataFrame, target: str, key: str, by: str, follows: bool = False
) -> list[str]:
    """Upsert into a table partitioned by ``by``, rewriting only the partitions concerned.

    These are the partitions the batch has rows for and those its keys sit in today, so a
    row that changes its partition leaves the old one. Returns their folder names. Each
    partition is swapped in by itself: run the upsert again if it was interrupted.

    Two scans of the table: its keys and partitions, to find those concerned, and then these
    partitions only. Where the partition ``follows`` from the key, the first is left out. The number
    of partitions concerned is bounded by that of the folders of the table.
    """
    spark = source.sparkSession
    recover(spark, target)
    batch = stage(source, target, [by])
    try:
        written = read_path(spark, batch, source.schema)
        check_keys(written, key)
        if not exists(spark, target):
            swap_in(spark, stage(written, target, [by]), target)
            return [name_of(p) for p in children(spark, target) if f"/{by}=" in p]
        recover_partitions(spark, target)
        current = read_path(spark, target, source.schema)
        # In file paths the folder name is URL-encoded once more.
        raw = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
        folder = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))).alias("_folder")
        keys = written.select(named(key).alias("_key"))
        located = current.select(named(key), named(by).alias("_by"), folder)
        hit = located.join(keys, named(key) == F.col("_key"), "left_semi").select("_by", "_folder")
        touched = written.select(named(by).alias("_by"), folder)
        found = (touched if follows else hit.union(touched)).distinct().collect()
        staged = stage(merged(within(current, by, [r[0] for r in found]), written, key), target, [by])
    finally:
        delete(spark, batch)
    full = {name_of(p) for p in children(spark, staged)}
    names = sorted({r[1] for r in found})
    for name in names:
        if name in full:
            swap_in(spark, f"{staged}/{name}", f"{target}/{name}", f"{parked(target)}/{name}")
        else:
            delete(spark, f"{target}/{name}")
    delete(spark, staged)
    delete(spark, parked(target))
    return names


def within(df: DataFrame, by: str, values: Sequence) -> DataFrame:
    """Rows whose ``by`` is among ``values`` (None for NULL): a filter that prunes partitions."""
    known = [v for v in values if v is not None]
    wanted = named(by).isin(known)
    return df.where(wanted | named(by).isNull() if len(known) < len(values) else wanted)


def overwrite_partitions(df: DataFrame, target: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(target)
    )


def create_or_replace(df: DataFrame, table: str, provider: str | None = None) -> None:
    """Atomic create-or-replace in a v2 catalog, overwrite in the session catalog.

    ``provider`` names a row-level format the catalog offers; none ships with Spark.
    """
    spark = df.sparkSession
    catalog = table.split(".")[0] if table.count(".") == 2 else spark.catalog.currentCatalog()
    if catalog == "spark_catalog":
        df.write.mode("overwrite").format(provider or "parquet").saveAsTable(table)
        return
    writer = df.writeTo(table)
    (writer.using(provider) if provider else writer).createOrReplace()


def create_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table dealt and sorted by ``key``: joins, sums and guards on it need no shuffle.

    Each bucket is one file, so rows of a key stand together. Choose buckets of a few hundred MB.
    """
    writer = df.repartition(buckets, named(key)).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def upsert_table(df: DataFrame, table: str, key: str) -> None:
    """Row-level MERGE into a v2 table; creates the table on first use."""
    spark = df.sparkSession
    check_keys(df, key)
    if not spark.catalog.tableExists(table):
        create_or_replace(df, table)
        return
    (
        df.alias("s")
        .mergeInto(table, F.expr(f"{table}.`{key}` = s.`{key}`"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def matched_and_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """(matched_rows, new_rows) an upsert of ``source`` would update and insert."""
    known = target.select(named(key).alias("_target_key")).distinct()
    return source.join(known, named(key) == F.col("_target_key"), "left").agg(
        F.count_if(F.col("_target_key").isNotNull()).alias("matched_rows"),
        F.count_if(F.col("_target_key").isNull()).alias("new_rows"),
    )
