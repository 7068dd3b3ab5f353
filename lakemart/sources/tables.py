"""Reading Silver and Gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.functions.columns import named
from lakemart.operators.dedup import latest_state
from lakemart.sources.versions import Version, current

REASON = "quarantine_reason"
ACCEPTED = "__accepted__"


def read_path(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table by path; a known schema saves the look into the files."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table not found: {path}") from error
        raise


def read_silver(
    spark: SparkSession,
    lake: str,
    table: str,
    key: str | None = None,
    recency: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame:
    """A Silver table.

    The last published version counts (see ``versions``); a lake without one holds plain folders.
    Silver is unique on its key by construction. Naming ``key`` guards the grain
    of tables that come from elsewhere; the guard costs a shuffle, so it is off by default.
    """
    version = current(spark, f"{lake}/silver")
    if version is not None and table in version.tables:
        df = read_version(spark, lake, version, table)
    else:
        df = read_path(spark, f"{lake}/silver/{table}", schema)
    return latest_state(df, key, recency) if key else df


def read_version(
    spark: SparkSession, lake: str, version: Version, table: str, accepted: bool = True
) -> DataFrame:
    """Silver rows of a table as a version has them, or its rejects with their reason."""
    noted = version.tables[table]
    schema = StructType.fromJson(noted["schema"])
    known = noted.get("table")
    if known and spark.catalog.tableExists(known):  # dealt by a key; joins on it shuffle less
        df = spark.table(known).select(*[named(c) for c in schema.names])
    else:
        df = spark.read.schema(schema).parquet(f"{lake}/silver/_runs/{noted['run']}/{table}")
    if accepted:
        return df.where(F.col(REASON) == ACCEPTED).drop(REASON)
    return df.where(F.col(REASON) != ACCEPTED)


def read_catalog(
    spark: SparkSession, name: str, key: str | None = None, recency: Sequence[str] = ()
) -> DataFrame:
    """The same from a catalog table."""
    df = spark.table(name)
    return latest_state(df, key, recency) if key else df


def read_unique(spark: SparkSession, name: str, key: str) -> DataFrame:
    """A catalog table whose key must be unique, guarded while it is read.

    In a table bucketed and sorted by its key (``sinks.tables.create_bucketed``) the rows of a key
    stand next to each other in one file, so the guard needs no shuffle; otherwise it costs one. A
    repeated key ends the query that reads it, so nothing is published from such a table. NULL
    is no key and refused as well.
    """
    df = spark.table(name)
    number = F.row_number().over(Window.partitionBy(named(key)).orderBy(named(key)))
    problem = F.concat(F.lit(f"{name}: repeated or missing {key} "), F.coalesce(named(key).cast("string"), F.lit("")))
    first = (F.col("_number") == 1) & named(key).isNotNull()
    # a filter, which stays in the plan whatever columns are asked for
    sound = F.when(first, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return df.withColumn("_number", number).where(sound).drop("_number")


def read_gold(spark: SparkSession, lake: str, mart: str) -> DataFrame:
    """A published mart, without the folder that an upsert keeps its rows in."""
    return read_path(spark, f"{lake}/gold/{mart}").drop("key_bucket")
