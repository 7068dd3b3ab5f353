"""One row per key, chosen deterministically.

The survivor is the greatest (or least) row under a total order over all
columns. Written as ``max(struct(...))`` it is an ordinary aggregate: every map
task keeps one row per key before the shuffle, so a key with a third of all rows
costs one row per map task, and no task ever holds a whole group. A struct compares
field by field with NULL lowest, so its maximum is exactly the first row under
``DESC NULLS LAST``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import named

DIGEST = "_key_digest"


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def recency_order(columns: Sequence[str], keys: Sequence[str], recency: Sequence[str]) -> list[str]:
    """Ranking columns: known recency columns as listed, then the others by name."""
    leading = [c for c in recency if c in columns]
    return leading + sorted(c for c in columns if c not in keys and c not in recency)


def latest_state(
    df: DataFrame,
    key: str | Sequence[str],
    recency: Sequence[str] = (),
    counted: str | None = None,
) -> DataFrame:
    """Latest row per key; later ``recency`` wins, ties fall to the other columns.

    ``counted`` names a further column for the number of rows of the key.
    """
    keys = _names(key)
    ranked = recency_order(df.columns, keys, recency)
    if not ranked and counted is None:
        return df.distinct()
    best = df.groupBy(*[named(k) for k in keys]).agg(
        F.max(F.struct(*[named(c) for c in ranked]) if ranked else F.lit(True)).alias("_best"),
        *([] if counted is None else [F.count("*").alias(counted)]),
    )
    return best.select(
        *[named(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns],
        *([] if counted is None else [counted]),
    )


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Digests (64 bits) of the keys that more than one row has; a key on its own may share one."""
    counted = df.groupBy(F.xxhash64(named(key)).alias(DIGEST)).agg(F.count("*").alias("_n"))
    return counted.where("_n > 1").select(DIGEST)


def latest_of_repeated(
    df: DataFrame, key: str, recency: Sequence[str], digests: DataFrame
) -> DataFrame:
    """Latest row per key where only keys of ``digests`` can have more rows than one.

    The other rows stay where they are: no shuffle, no sort. ``df`` is read twice, so it should be a table.
    """
    rows = df.withColumn(DIGEST, F.xxhash64(named(key)))
    alone = rows.join(digests, DIGEST, "left_anti").select(*[named(c) for c in df.columns])
    again = rows.join(digests, DIGEST, "left_semi").select(*[named(c) for c in df.columns])
    return alone.unionByName(latest_state(again, key, recency))


def first_row(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """First row per key under all columns ascending, NULL last."""
    keys = _names(key)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    # NULL sorts lowest inside a struct; the null flag before each value puts it last.
    ranked = []
    for i, c in enumerate(others):
        ranked += [named(c).isNull().alias(f"n{i}"), named(c).alias(f"v{i}")]
    best = df.groupBy(*[named(k) for k in keys]).agg(F.min(F.struct(*ranked)).alias("_best"))
    place = {c: f"v{i}" for i, c in enumerate(others)}
    return best.select(
        *[named(c) if c in keys else F.col("_best").getField(place[c]).alias(c) for c in df.columns]
    )


def keep_last(df: DataFrame, key: str | Sequence[str], arrival: str | Sequence[str]) -> DataFrame:
    """Row that arrived last per key; arrival must be a column, rows have no order."""
    return latest_state(df, key, _names(arrival))


def any_row(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Some row per key. Only for rows known to be equal; otherwise use latest_state."""
    return df.dropDuplicates(_names(key))
