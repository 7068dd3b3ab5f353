"""Raw CSV batches: listing, scan, intake and expected-table check."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.ranges import Quoting

log = logging.getLogger(__name__)

VALID_DATA = "VALID_DATA"
EMPTY_VALID_BATCH = "EMPTY_VALID_BATCH"
SCHEMA_CORRUPTION = "SCHEMA_CORRUPTION"


class SchemaCorruption(ValueError):
    """The batch has no header or lacks required columns."""


def _not_found(error: AnalysisException, what) -> Exception:
    if error.getCondition() == "PATH_NOT_FOUND":
        return FileNotFoundError(f"no input at {what}")
    return error


def raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool = False,
    check_headers: bool = True,
    quoting: Quoting = Quoting(),
) -> DataFrame:
    """All CSV files at ``paths`` as one frame of string columns named by the header.

    Files whose header differs from the first one's fail the scan instead of being
    read by position (``check_headers=False`` restores that). ``multi_line`` accepts
    line breaks inside quotes, at the price of unsplittable files; parts landed in Bronze are
    cut between records and no larger than a byte range, so there it costs no parallelism.
    """
    paths = [paths] if isinstance(paths, str) else sorted(paths)
    try:
        return (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("mode", "PERMISSIVE")
            .option("multiLine", multi_line)
            .option("sep", quoting.sep)
            .option("quote", quoting.quote)
            .option("escape", quoting.escape)
            .option("enforceSchema", not check_headers)
            .option("recursiveFileLookup", True)
            .csv(paths)
        )
    except AnalysisException as error:
        raise _not_found(error, paths) from error


def holds_breaks(spark: SparkSession, lake: str, table: str) -> bool:
    """Whether the manifest says that records of the table go over several lines."""
    path = f"{lake}/metadata/bronze_manifest"
    try:
        rows = spark.read.schema("table_name string, multi_line boolean").json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return not rows.where((F.col("table_name") == table) & F.col("multi_line")).isEmpty()


def read_bronze(
    spark: SparkSession,
    lake: str,
    table: str,
    multi_line: bool | None = None,
    quoting: Quoting = Quoting(),
) -> DataFrame:
    """Bronze rows of a table; a batch with a header and no rows is only a warning.

    Unless told, the manifest decides whether quoted line breaks are to be expected.
    """
    if multi_line is None:
        multi_line = holds_breaks(spark, lake, table)
    df = raw_csv(spark, f"{lake}/bronze/{table}", multi_line, quoting=quoting)
    if df.isEmpty():
        log.warning("%s: header with 0 rows", table)
    return df


def table_name(path: str | Column) -> Column:
    """Table name of a file: stem, lower case, runs of other characters as ``_``."""
    path = F.col(path) if isinstance(path, str) else path
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(F.trim(F.lower(stem)), r"(?U)\W+", "_")


def list_deliveries(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(table_name, path, source_file, size_bytes): one row per delivered table.

    A delivery is a file ``<table>.csv`` or, for large tables, a folder ``<table>`` of
    such files. The contents are not read: the listing source skips them unless asked.
    """
    folder = folder.rstrip("/")
    try:
        found = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True)
            .load(folder)
        )
    except AnalysisException as error:
        raise _not_found(error, folder) from error
    # Zero-byte files are not listed: a table that consists of one counts as missing.
    below = F.element_at(F.split("path", rf"\Q{folder}/\E", 2), 2)
    return (
        found.groupBy(F.split_part(below, F.lit("/"), F.lit(1)).alias("source_file"))
        .agg(F.sum("length").alias("size_bytes"))
        .select(
            table_name("source_file").alias("table_name"),
            F.concat(F.lit(f"{folder}/"), "source_file").alias("path"),
            "source_file",
            "size_bytes",
        )
    )


def table_presence(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(table_name, presence): present, missing or unexpected, against expected names."""
    here = found.select("table_name").distinct().withColumn("_found", F.lit(True))
    wanted = expected.select("table_name").distinct().withColumn("_wanted", F.lit(True))
    return here.join(wanted, "table_name", "full").select(
        "table_name",
        F.when(F.col("_found").isNull(), "missing")
        .when(F.col("_wanted").isNull(), "unexpected")
        .otherwise("present")
        .alias("presence"),
    )


def check_tables(deliveries: DataFrame, expected: Iterable[str]) -> list[str]:
    """Names of the tables found. Missing ones raise, unexpected ones are logged."""
    spark = deliveries.sparkSession
    wanted = spark.createDataFrame([(t,) for t in expected], "table_name string")
    rows = table_presence(deliveries, wanted).orderBy("table_name").collect()
    by_presence = {
        p: [r.table_name for r in rows if r.presence == p]
        for p in ("present", "missing", "unexpected")
    }
    if not by_presence["present"] and not by_presence["unexpected"]:
        raise FileNotFoundError("no CSV files found")
    if by_presence["missing"]:
        raise ValueError(f"missing expected tables: {by_presence['missing']}")
    if by_presence["unexpected"]:
        log.warning("unexpected tables: %s", by_presence["unexpected"])
    return sorted(by_presence["present"] + by_presence["unexpected"])


def inspect_batch(
    spark: SparkSession, paths: str | Sequence[str], required: Iterable[str]
) -> tuple[str, DataFrame]:
    """Tell a batch with data from an empty one; raise on a corrupt one.

    Extra columns are allowed. Only the header and at most one row are looked at.
    """
    df = raw_csv(spark, paths)
    if not df.columns:
        raise SchemaCorruption(f"{SCHEMA_CORRUPTION}: empty file without a header")
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaCorruption(f"{SCHEMA_CORRUPTION}: missing required columns: {missing}")
    return (EMPTY_VALID_BATCH if df.isEmpty() else VALID_DATA), df


def intake_status(
    spark: SparkSession, batches: Mapping[str, str], required: Mapping[str, Iterable[str]]
) -> DataFrame:
    """(batch, status) for several batches, corrupt ones included."""
    rows = []
    for name, path in batches.items():
        try:
            status, _ = inspect_batch(spark, path, required[name])
        except SchemaCorruption:
            status = SCHEMA_CORRUPTION
        rows.append((name, status))
    return spark.createDataFrame(rows, "batch string, status string")
