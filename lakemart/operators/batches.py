"""Combining batches and restating results after corrections and late arrivals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named
from lakemart.operators.dedup import latest_state, recency_order


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, matched by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def rows_missing_in(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of ``columns`` in ``left`` that ``right`` lacks; NULL equals NULL.

    One aggregation over both sides: repeated values shrink before the shuffle.
    """

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(*columns, F.lit(is_left).alias("_left"))

    return (
        side(left, True)
        .unionByName(side(right, False))
        .groupBy(*columns)
        .agg(F.every("_left").alias("_only_left"))
        .where("_only_left")
        .drop("_only_left")
    )


def apply_corrections(
    base: DataFrame, corrections: DataFrame, key: str, recency: Sequence[str]
) -> DataFrame:
    """Base and corrections reduced to the latest state; redelivery changes nothing."""
    return latest_state(union_batches(base, corrections), key, recency)


def restated_totals(
    totals: DataFrame,
    base: DataFrame,
    late: DataFrame,
    key: str,
    recency: Sequence[str],
    date_of: Callable[[], Column],
    date_column: str,
    measures: Mapping[str, Column],
) -> DataFrame:
    """The rows of ``totals`` that late rows change: what they replace taken off, they themselves added.

    ``totals`` holds one row per date with the sums of ``measures`` (expressions over one row, whole
    numbers or decimals, so that taking off is exact). ``base`` holds the latest state per key. Late rows
    are reduced to their latest state, which counts only if it is newer than the base's. Each
    input is read once; of ``base`` only the keys that arrived late meet anything. A date that nothing
    is left on shows zeros.
    """
    columns = [c for c in recency_order(base.columns, [key], recency) if c in late.columns]

    def state(df: DataFrame, name: str) -> DataFrame:
        return df.select(named(key).alias("_key"), F.struct(*[named(c) for c in columns]).alias(name))

    arrived = state(latest_state(late, key, recency), "_late")
    both = arrived.join(state(base, "_base"), "_key", "left")
    newest = F.greatest("_late", "_base")  # skips a NULL base
    moves = both.where(~F.equal_null(newest, F.col("_base"))).select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit(1).alias("sign"), newest.alias("row")),
                    F.when(F.col("_base").isNotNull(), F.struct(F.lit(-1).alias("sign"), F.col("_base").alias("row"))),
                )
            )
        ).alias("m")
    )
    rows = moves.select("m.sign", "m.row.*")
    deltas = rows.groupBy(date_of().alias(date_column)).agg(
        *[F.sum(F.col("sign") * F.coalesce(m, F.lit(0))).alias(f"_d_{n}") for n, m in measures.items()]
    )
    old = totals.select(named(date_column).alias("_date"), *[named(n) for n in measures])
    joined = deltas.join(old, F.equal_null(named(date_column), F.col("_date")), "left")
    types = totals.schema
    return joined.select(
        date_column,
        *[
            (F.coalesce(named(n), F.lit(0)) + F.col(f"_d_{n}")).cast(types[n].dataType).alias(n)
            for n in measures
        ],
    )


def restate_dates(
    mart: DataFrame,
    base: DataFrame,
    late: DataFrame,
    key: str,
    recency: Sequence[str],
    date_of: Callable[[], Column],
    date_column: str,
    summarize: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The mart with every business date touched by ``late`` computed anew.

    ``base`` holds the latest state per key. ``date_of`` gives the event-time date
    of a row and ``summarize`` turns rows into mart rows. Touched dates are those of the
    late rows and those their earlier versions sat on, so an event that moves is also
    taken off its old date and a date left without events disappears. All events of a
    touched date count, whenever they were ingested; other dates are left alone.
    """

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("_date", date_of())

    def on_touched(df: DataFrame, column: str, how: str) -> DataFrame:
        return df.join(touched, F.equal_null(named(column), F.col("_touched")), how)

    late_keys = late.select(key).distinct()
    replaced = base.join(late_keys, on=key, how="left_semi")
    changed = latest_state(union_batches(replaced, late), key, recency)
    touched = (
        union_batches(dated(late).select("_date"), dated(replaced).select("_date"))
        .distinct()
        .withColumnRenamed("_date", "_touched")
    )
    unchanged = base.join(late_keys, on=key, how="left_anti")
    current = union_batches(dated(unchanged), dated(changed))
    fresh = summarize(on_touched(current, "_date", "left_semi").drop("_date"))
    return on_touched(mart, date_column, "left_anti").unionByName(fresh)
