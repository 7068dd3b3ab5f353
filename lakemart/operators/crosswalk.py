"""Dense target identifiers for source keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.columns import named
from lakemart.session import checkpointed

# monotonically_increasing_id: partition number above, row number below this bit.
_ROW_BITS = 33


def key_crosswalk(
    df: DataFrame, column: str, prefix: str, capacity: int | None = None
) -> DataFrame:
    """(source_key, target_id): distinct keys in order, numbered ``PREFIX00000001`` on.

    The keys are range-sorted in parallel and checkpointed; a key's number is
    its row within its partition plus the rows of the partitions before. Only the
    per-partition counts (one row per partition) pass a single task and are broadcast.
    """
    keys = df.where(named(column).isNotNull()).select(named(column).alias("source_key")).distinct()
    placed = checkpointed(
        keys.orderBy("source_key").withColumn("_place", F.monotonically_increasing_id())
    )
    located = placed.select(
        "source_key",
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    sizes = located.groupBy("_part").agg(F.count("*").alias("_n"))
    if capacity is not None:
        found = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        if found > capacity:
            raise ValueError(f"{found} keys of {column} do not fit {capacity} target ids")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return located.join(F.broadcast(offsets), "_part").select(
        "source_key",
        F.format_string(prefix + "%08d", F.col("_offset") + F.col("_row") + 1).alias("target_id"),
    )


def map_keys(df: DataFrame, column: str, crosswalk: DataFrame) -> DataFrame:
    """``column`` replaced by its target id; unmapped values become NULL."""
    return (
        df.join(crosswalk, named(column) == F.col("source_key"), "left")
        .withColumn(column, F.col("target_id"))
        .drop("source_key", "target_id")
    )
