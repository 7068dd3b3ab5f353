"""Proportional stratified interleaving: every shard mirrors the mixture of strata.

Rows are shuffled by a seeded hash within their stratum; rank r of n rows becomes the fraction
(2r - 1) / 2n. In the order of these fractions the strata are interleaved evenly, so any
consecutive cut holds each stratum in proportion, and equal cuts differ by one row at most.

Exact ranks need no global sort. The hash is uniform, so its leading part cuts a stratum into
cells of a few thousand rows; a row's rank is its rank within the cell plus the rows of earlier
cells. The cells' counts are the only thing that is summed up in order. The same is done a second
time for the fractions, which are uniform by construction.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import small_join, tag, unit, written

CELL_ROWS = 2048  # mean rows of a cell, whatever the table's size


def _ranked(df: DataFrame, cell: list[str], order: list[str], within: list[str], rank: str):
    """Adds 0-based ``rank``: rows of a group ``within`` in the order of ``cell`` and ``order``."""
    counts = df.groupBy(*within, *cell).agg(F.count("*").alias("_q_cell"))
    before = Window.partitionBy(*within).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_q_start", F.coalesce(F.sum("_q_cell").over(before), F.lit(0)))
    inside = Window.partitionBy(*within, *cell).orderBy(*order)
    return (
        df.withColumn("_q_in", F.row_number().over(inside) - 1)
        .join(starts.drop("_q_cell"), [*within, *cell])
        .withColumn(rank, F.col("_q_start") + F.col("_q_in"))
        .drop("_q_start", "_q_in")
    )


def interleave(
    rows: DataFrame,
    stratum: str,
    shards: int,
    seed: int = 7,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and gapless ``slot`` in it, from 0.

    Pass narrow rows (ids and sizes, not texts): all columns are shuffled and take part in the
    order. Null strata form one stratum of their own. Equal rows are interchangeable, so reruns
    agree as a set of rows. An empty table gives an empty result. Input columns of the names
    ``shard`` and ``slot`` are replaced; those beginning with ``_q_`` are reserved.
    """
    given = [c for c in rows.columns if c not in ("shard", "slot")]
    hashed = written(
        rows.select(
            *given,
            tag(F.col(stratum).cast("string")).alias("_q_s"),
            F.xxhash64(F.lit(seed), F.to_json(F.struct(*given))).alias("_q_h"),
        ),
        "rows",
    )
    sizes = hashed.groupBy("_q_s").agg(F.count("*").alias("_q_n"))
    sizes = written(sizes.withColumn("_q_cells", F.ceil(F.col("_q_n") / cell_rows)), "strata")
    total = sizes.agg(F.sum("_q_n")).first()[0] or 0
    cells = max(1, math.ceil(total / cell_rows))
    placed = small_join(hashed, sizes, ["_q_s"]).withColumn(
        "_q_c", F.floor(unit(F.lit(seed), "_q_h") * F.col("_q_cells"))
    )
    ranked = _ranked(placed, ["_q_c"], ["_q_h", *given], ["_q_s"], "_q_r")
    fraction = (2 * F.col("_q_r") + 1) / (2 * F.col("_q_n"))
    mixed = written(
        ranked.withColumn("_q_f", fraction).withColumn("_q_c", F.floor(F.col("_q_f") * cells)),
        "fractions",
    )
    mixed = mixed.withColumn("_q_all", F.lit(0))
    placed = _ranked(mixed, ["_q_c"], ["_q_f", "_q_s", "_q_r"], ["_q_all"], "_q_p")
    # Integer division: a double could round up at a cut.
    shard = F.expr(f"_q_p * {shards}L div {max(total, 1)}L")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("_q_p") - first)
        .withColumn("shard", F.col("shard").cast("int"))
        .select(*given, "shard", "slot")
    )
