"""Classify every row of a batch once: accepted, rejected with a reason, or superseded.

Stages, in this order: missing key, business rules, latest state among the rows
still valid, restatement, foreign keys in their listed order. A row rejected early
takes no part in later stages, so an invalid newest correction does not displace
an older valid row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named
from lakemart.operators.dedup import latest_state
from lakemart.operators.integrity import with_fk_reason
from lakemart.operators.rules import first_broken
from lakemart.plans.spec import TableSpec, conform, restate

REASON = "quarantine_reason"
QUARANTINED_AT = "quarantined_at_utc"
_RULE = "_broken_rule"
_COPY = "_copy"
_TIMES = "_times"


def tag(raw: DataFrame, spec: TableSpec, column: str) -> DataFrame:
    """Typed rows with the first rule that each breaks, NULL for a valid one."""
    return conform(raw, spec).withColumn(column, first_broken(spec.all_rules))


def check(latest: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Valid rows, one per key, restated and with the reason of the first foreign key that fails."""
    return with_fk_reason(restate(latest, spec), spec.foreign_keys, parents, REASON)


def classify(raw: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Typed rows plus ``quarantine_reason`` (NULL = accepted); superseded rows are gone.

    The source is read once. Rejected rows travel through the same aggregate as
    the valid ones, grouped by their content and the partition they came in: the digest in
    ``_copy`` keeps them apart and spreads rejects with a NULL key, or equal ones, over all
    partitions; exact duplicates of a partition become one row with a count, and as many rows
    again at the end. None of this depends on the order of rows, so a task that runs again can
    neither lose nor double a reject. Valid rows share one ``_copy`` value and so compete per key.
    A job that writes the batch has no need of all this (``sinks.quarantine.write_batch``).
    ``parents`` must be unique on their key, as accepted Silver tables are.
    """
    tagged = tag(raw, spec, _RULE)
    row = F.to_json(F.struct(*[named(c) for c in tagged.columns]))
    content = F.concat_ws("/", F.sha2(row, 256), F.spark_partition_id())
    tagged = tagged.withColumn(_COPY, F.when(F.col(_RULE).isNotNull(), content))
    latest = latest_state(tagged, [spec.key, _COPY], spec.recency, counted=_TIMES).drop(_COPY)
    restated = restate(latest, spec, F.col(_RULE).isNull())
    checked = with_fk_reason(restated, spec.foreign_keys, parents, REASON)
    times = F.when(F.col(_RULE).isNotNull(), F.col(_TIMES)).otherwise(1)
    repeated = checked.withColumn(_TIMES, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return repeated.withColumn(REASON, F.coalesce(F.col(_RULE), F.col(REASON))).drop(_RULE, _TIMES)


def accepted(classified: DataFrame) -> DataFrame:
    """The Silver rows."""
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def rejected(classified: DataFrame) -> DataFrame:
    """The quarantined rows with their reason."""
    return classified.where(F.col(REASON).isNotNull())


def audit(classified: DataFrame, table: str) -> DataFrame:
    """Rejected rows per reason: (table_name, issue_type, affected_count)."""
    return (
        rejected(classified)
        .groupBy(named(REASON).alias("issue_type"))
        .agg(F.count("*").alias("affected_count"))
        .select(F.lit(table).alias("table_name"), "issue_type", "affected_count")
    )
