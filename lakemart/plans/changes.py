"""From changed Silver rows to the mart rows they concern.

Two versions of a table are compared by the columns that lead anywhere and a digest of each row;
what is in one of them only has changed, in its old and its new state alike. A mart's feeds lead
from there to its keys. For these keys alone the mart is built anew, from the facts that hold them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import named
from lakemart.plans.marts import Mart, Tables, with_dates

BUCKET = "key_bucket"
BUCKETS = 64  # folders of a mart that is kept up to date by key


def _told_apart(df: DataFrame, column: str) -> Column:
    """A value that hashes differ for wherever the column's texts do."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(named(column) == 0, F.xxhash64(named(column).cast("string"))).otherwise(F.xxhash64(named(column)))
    atomic = isinstance(kind, (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.BooleanType, T.BinaryType))
    return named(column) if atomic else F.to_json(F.struct(named(column)))


def changed_rows(old: DataFrame, new: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``columns`` of the rows that one of the versions has more often than the other.

    Rows are told apart by 128 bits of their content besides these columns.
    """
    columns = list(dict.fromkeys(columns))

    def narrow(df: DataFrame, sign: int) -> DataFrame:
        # columns that only one version has count as null in the other
        every = sorted({*old.columns, *new.columns})
        # hashes skip nulls, and take 0.0 and -0.0 for equal; text of the places that are null goes in front
        nulls = F.concat(*[(F.when(named(c).isNull(), "0").otherwise("1") if c in df.columns else F.lit("0")) for c in every])
        values = [nulls, *[_told_apart(df, c) for c in every if c in df.columns]]
        digests = [F.xxhash64(F.lit(seed), *values).alias(f"_content_{seed}") for seed in (1, 2)]
        return df.select(*[named(c) for c in columns], *digests, F.lit(sign).alias("_sign"))

    both = narrow(new, 1).unionByName(narrow(old, -1))
    by = [*[named(c) for c in columns], "_content_1", "_content_2"]
    found = both.groupBy(*by).agg(F.sum("_sign").alias("_n"))
    return found.where("_n <> 0").select(*[named(c) for c in columns])


def feed_columns(marts: Iterable[Mart]) -> dict[str, list[str]]:
    """Per table the columns that its changed rows must bring."""
    found: dict[str, list[str]] = {}
    for mart in marts:
        for feed in mart.feeds:
            found.setdefault(feed.table, []).append(feed.column)
    return {t: list(dict.fromkeys(c)) for t, c in found.items()}


def touched_keys(mart: Mart, changes: Mapping[str, DataFrame], tables: Tables) -> DataFrame | None:
    """The mart's keys that changed rows concern, in ``mart.key``; None if no table of its feeds changed."""
    tables = with_dates(tables)
    found = []
    for feed in mart.feeds:
        if feed.table not in changes:
            continue
        values = changes[feed.table].select(named(feed.column).alias("_v")).distinct()
        if feed.through is None:
            found.append(values.select(F.col("_v").alias(mart.key)))
        else:
            table, on, key = feed.through
            rows = tables[table].select(named(on).alias("_on"), named(key).alias(mart.key))
            found.append(rows.join(values, F.col("_on") == F.col("_v"), "left_semi").select(mart.key))
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).where(named(mart.key).isNotNull()).distinct()


def only(mart: Mart, keys: DataFrame, tables: Tables) -> dict[str, DataFrame]:
    """The tables, the mart's facts reduced to those of ``keys``."""
    dated, cut = with_dates(tables), dict(tables)
    for table, by in mart.facts.items():
        if isinstance(by, str):
            rows = dated[table].join(keys.select(named(mart.key).alias(by)), by, "left_semi")
        else:
            other, shared = by
            rows = dated[table].join(cut[other].select(shared), shared, "left_semi")
        cut[table] = rows.select(*tables[table].columns)
    return cut


def with_bucket(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the folder its rows belong in, which follows from the key."""
    bucket = F.pmod(F.xxhash64(named(key)), F.lit(buckets)).cast("int")
    return df.withColumn(BUCKET, bucket)
