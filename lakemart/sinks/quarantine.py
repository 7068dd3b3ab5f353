"""Publishing a classified batch: accepted rows to Silver, rejected rows to quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.functions.columns import named
from lakemart.operators.dedup import DIGEST, latest_of_repeated, latest_state, repeated
from lakemart.operators.quarantine import QUARANTINED_AT, REASON, check, tag
from lakemart.plans.spec import TableSpec
from lakemart.sinks.paths import delete, exists
from lakemart.sources.tables import ACCEPTED, read_version
from lakemart.sources.versions import current

VALID = "__valid__"  # rows that keep the rules, before their keys are checked
FEW = 500_000  # repeated keys that are treated apart: 4 MB of digests, which Spark sends to all tasks


def write_batch(
    raw: DataFrame,
    spec: TableSpec,
    parents: Mapping[str, DataFrame],
    path: str,
    table: str | None = None,
    key: str | None = None,
    buckets: int = 0,
) -> StructType:
    """Classify a batch as ``operators.quarantine.classify`` does and write it, one folder per outcome.

    The batch is read once: typed, checked by its rules and written, rejects to the folders where they
    stay and valid rows to one for a while. Only their keys are counted then; rows of repeated
    keys compete, the others go to the foreign keys as they are, without a shuffle for their key. So
    rejects are never shuffled, and no row is for being unique. The batch's schema is returned.

    With ``table`` the files are known to the catalog by that name, dealt and sorted by ``key``.
    """
    spark = raw.sparkSession
    arrived = path if table is None else f"{path}-arrived"
    digests = f"{path}-repeated"
    tagged = tag(raw, spec, REASON)
    rows = tagged.drop(REASON)
    schema = check(rows, spec, parents).schema
    typed = tagged.select(
        *[named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != REASON],
        F.coalesce(REASON, F.lit(VALID)).alias(REASON),
    )
    typed.write.partitionBy(REASON).parquet(arrived)
    waiting = f"{arrived}/{REASON}={VALID}"
    if exists(spark, waiting):
        valid = spark.read.schema(StructType([f for f in schema.fields if f.name != REASON])).parquet(waiting)
        repeated(valid, spec.key).write.parquet(digests)
        known = spark.read.schema(f"{DIGEST} long").parquet(digests)
        often = known.count()
        if not often:
            latest = valid
        elif often <= FEW:
            latest = latest_of_repeated(valid, spec.key, spec.recency, known)
        else:
            latest = latest_state(valid, spec.key, spec.recency)
        outcomes = check(latest, spec, parents).withColumn(REASON, F.coalesce(REASON, F.lit(ACCEPTED)))
        if table is None:
            outcomes.write.mode("append").partitionBy(REASON).parquet(path)
            delete(spark, waiting)
    if table is not None:
        rejects = spark.read.schema(schema).parquet(arrived).where(F.col(REASON) != VALID)
        every = outcomes.unionByName(rejects) if exists(spark, waiting) else rejects
        dealt = every.repartition(buckets, key).write.format("parquet").partitionBy(REASON).bucketBy(buckets, key)
        dealt.sortBy(key).option("path", path).saveAsTable(table)
        delete(spark, arrived)
    delete(spark, digests)
    return schema


def outcome_counts(spark: SparkSession, staged: str, schema: StructType, table: str) -> DataFrame:
    """(table_name, outcome, row_count) of a staged batch. Only Parquet footers are read."""
    return (
        spark.read.schema(schema)
        .parquet(staged)
        .groupBy(F.col(REASON).alias("outcome"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(table).alias("table_name"), "outcome", "row_count")
    )


def write_quarantine(df: DataFrame, quarantine: str, table: str, reason: str) -> bool:
    """Write one set of rejects under its table and reason; skipped when it is empty."""
    if df.isEmpty():
        return False
    (
        df.withColumn(QUARANTINED_AT, F.current_timestamp())
        .withColumn(REASON, F.lit(reason))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(REASON)
        .parquet(f"{quarantine}/{table}")
    )
    return True


def read_quarantine(
    spark: SparkSession, folder: str, tables: Iterable[str]
) -> dict[str, DataFrame]:
    """Quarantined rows per table that has any.

    ``folder`` is the quarantine folder of a lake; rejects of published Silver versions are those
    of the last one, with the time of its publication.
    """
    found = {}
    lake = folder.rstrip("/").rpartition("/")[0]
    version = current(spark, f"{lake}/silver")
    for name in tables:
        if version is not None and name in version.tables:
            if version.tables[name]["rejected"]:
                at = F.to_timestamp(F.lit(version.published_at))
                rejects = read_version(spark, lake, version, name, accepted=False)
                found[name] = rejects.withColumn(QUARANTINED_AT, at)
            continue
        try:
            found[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def defect_audit(quarantined: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, issue_type, affected_count) over all quarantined tables."""
    per_table = [
        df.groupBy(F.col(REASON).alias("issue_type"))
        .agg(F.count("*").alias("affected_count"))
        .select(F.lit(name).alias("table_name"), "issue_type", "affected_count")
        for name, df in quarantined.items()
    ]
    return reduce(DataFrame.unionByName, per_table)
