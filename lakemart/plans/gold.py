"""Gold job: build the marts, check them while staged, then publish them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.quality import (
    control_totals,
    grain_check,
    key_assertions,
    quality_report,
    require_pass,
)
from lakemart.plans.changes import (
    BUCKET,
    BUCKETS,
    changed_rows,
    feed_columns,
    only,
    touched_keys,
    with_bucket,
)
from lakemart.plans.concurrent import each
from lakemart.plans.logistics import SPECS
from lakemart.plans.marts import MARTS, Mart, with_dates
from lakemart.session import hashed_joins
from lakemart.sinks.paths import delete, exists, recover, staging_path, swap_in
from lakemart.sinks.reports import write_report
from lakemart.sinks.tables import (
    create_or_replace,
    merged,
    stage,
    stamped,
    upsert_partitions,
    upsert_table,
)
from lakemart.sources.tables import read_gold, read_path, read_silver, read_version
from lakemart.sources.versions import Version, current, publish, versions

LOAD_MART = "gold_load_performance"
CUSTOMER_MART = "gold_customer_performance"


def build_marts(
    tables: Mapping[str, DataFrame], marts: Mapping[str, Mart] = MARTS
) -> dict[str, DataFrame]:
    """All marts as lazy frames."""
    return {name: mart.build(tables) for name, mart in marts.items()}


def reconcile(
    loads: DataFrame, load_mart: DataFrame, customer_mart: DataFrame
) -> DataFrame:
    """Revenue of Silver loads against the load and the customer mart."""
    return control_totals(
        loads,
        {"load_mart": (load_mart, "revenue"), "customer_mart": (customer_mart, "total_revenue")},
        "revenue",
    )


def run_gold(
    spark: SparkSession, lake: str, mode: str = "replace", buckets: int = BUCKETS
) -> DataFrame:
    """Build, check and publish all marts; returns the control totals.

    ``mode="replace"`` refreshes every mart. ``mode="upsert"`` updates by key and leaves keys that
    vanished from Silver. Its first run brings the marts into ``buckets`` folders by key; later
    ones compare Silver with the version that Gold was last built from, build the rows concerned
    only, and read and rewrite only the folders that hold them (``changes``).
    All marts are staged and checked first: a failed check publishes nothing. They are
    then swapped in one by one, which on object stores copies them; use
    :func:`publish_catalog` there. A run that dies meanwhile is made good by the next, which still
    compares with the former version.
    """
    if mode not in ("replace", "upsert"):
        raise ValueError(f"mode must be replace or upsert, not {mode}")
    silver = {name: read_silver(spark, lake, name) for name in SPECS}
    now = current(spark, f"{lake}/silver")
    before = _built_from(spark, lake) if mode == "upsert" else None
    with hashed_joins(spark):
        if mode == "upsert" and before is not None:
            report = _update(spark, lake, silver, before, buckets)
        else:
            report = _refresh(spark, lake, silver, mode, buckets)
    if now is not None:
        tables = {"silver": {"run": now.run, "of": now.run, "buckets": buckets if mode == "upsert" else 0}}
        publish(spark, f"{lake}/gold", now.run, tables)
    return report


def _built_from(spark: SparkSession, lake: str) -> tuple[Version, int] | None:
    """The Silver version and number of folders of marts that can be updated, if it is still there."""
    gold = current(spark, f"{lake}/gold")
    if gold is None or not gold.tables["silver"]["buckets"]:
        return None
    for version in versions(spark, f"{lake}/silver"):
        if version.run == gold.tables["silver"]["of"]:
            return version, gold.tables["silver"]["buckets"]
    return None


def _refresh(
    spark: SparkSession, lake: str, silver: Mapping[str, DataFrame], mode: str, buckets: int
) -> DataFrame:
    """All marts built as a whole."""
    staged: dict[str, str] = {}
    schemas: dict[str, StructType] = {}

    def write(mart: Mart) -> None:
        df, target = stamped(mart.build(silver)), f"{lake}/gold/{mart.name}"
        if mode == "replace":
            schemas[mart.name] = df.schema
            staged[mart.name] = stage(df, target)
            return
        recover(spark, target)
        if exists(spark, target):
            df = merged(read_gold(spark, lake, mart.name), df, mart.key)
        df = with_bucket(df, mart.key, buckets)
        schemas[mart.name] = df.schema
        staged[mart.name] = stage(df.hint("rebalance", BUCKET), target, [BUCKET])

    try:
        each(spark, write, MARTS.values())
        written = {name: read_path(spark, path, schemas[name]) for name, path in staged.items()}
        require_pass(
            grain_check({n: (df, MARTS[n].key) for n, df in written.items()}), "grain"
        )
        load_mart, customer_mart = written[LOAD_MART], written[CUSTOMER_MART]
        if mode == "upsert":
            # Keys of earlier runs stay after an upsert; only this batch can be compared.
            loads = silver["loads"]
            load_mart = load_mart.join(loads.select("load_id"), "load_id", "left_semi")
            customers = loads.select("customer_id").distinct()
            customer_mart = customer_mart.join(customers, "customer_id", "left_semi")
        totals = reconcile(silver["loads"], load_mart, customer_mart)
        checked = require_pass(totals, "control totals")
        report = spark.createDataFrame(checked, totals.schema)
    except Exception:
        for path in staged.values():
            delete(spark, path)
        raise
    for name, path in staged.items():
        swap_in(spark, path, f"{lake}/gold/{name}")
    return report


def _update(
    spark: SparkSession, lake: str, silver: Mapping[str, DataFrame], before: tuple[Version, int], buckets: int
) -> DataFrame:
    """The rows that changed Silver rows concern, checked, then merged into their folders."""
    version, made = before
    if made != buckets:
        raise ValueError(f"Gold is kept in {made} folders a mart, not {buckets}; refresh it first")
    now = current(spark, f"{lake}/silver")
    staged: dict[str, str] = {}

    def compare(item: tuple[str, list[str]]) -> tuple[str, DataFrame] | None:
        table, columns = item
        if version.tables.get(table) == now.tables.get(table):
            return None
        dated = with_dates({"delivery_events": silver[table]}) if table == "delivery_events" else {}
        new = dated.get(table, silver[table])
        old = read_version(spark, lake, version, table)
        if dated:
            old = with_dates({table: old})[table]
        path = staging_path(f"{lake}/gold/changed_{table}")
        staged[f"changes of {table}"] = path
        changed_rows(old, new, columns).write.parquet(path)
        return table, spark.read.schema(new.select(*columns).schema).parquet(path)

    def write(mart: Mart) -> tuple[Mart, DataFrame, DataFrame] | None:
        keys = touched_keys(mart, changes, silver)
        if keys is None:
            return None
        path = staging_path(f"{lake}/gold/keys_{mart.name}")
        staged[f"keys of {mart.name}"] = path
        keys.write.parquet(path)
        keys = read_path(spark, path, keys.schema)
        rows = with_bucket(stamped(mart.build(only(mart, keys, silver))), mart.key, buckets)
        staged[mart.name] = stage(rows, f"{lake}/gold/{mart.name}")
        return mart, keys, read_path(spark, staged[mart.name], rows.schema)

    def merge(item: tuple[str, tuple[Mart, DataFrame, DataFrame]]) -> None:
        name, (mart, _, rows) = item
        upsert_partitions(rows, f"{lake}/gold/{name}", mart.key, BUCKET, follows=True)

    try:
        changes = dict(filter(None, each(spark, compare, feed_columns(MARTS.values()).items())))
        built = {m.name: (m, keys, rows) for m, keys, rows in filter(None, each(spark, write, MARTS.values()))}
        if built:
            assertions = key_assertions({n: (rows, m.key) for n, (m, _, rows) in built.items()})
            require_pass(assertions, "grain")
        totals = _updated_totals(spark, silver["loads"], built)
        each(spark, merge, built.items())
    finally:
        for path in staged.values():
            delete(spark, path)
    return totals


def _updated_totals(
    spark: SparkSession, loads: DataFrame, built: Mapping[str, tuple[Mart, DataFrame, DataFrame]]
) -> DataFrame:
    """Control totals over the loads whose rows were built anew; both marts on their own loads."""
    reports = []
    for name, label, column in (
        (LOAD_MART, "load_mart", "revenue"),
        (CUSTOMER_MART, "customer_mart", "total_revenue"),
    ):
        if name in built:
            mart, keys, rows = built[name]
            own = loads.join(keys, mart.key, "left_semi")
            totals = control_totals(own, {label: (rows, column)}, "revenue")
            reports.append(spark.createDataFrame(require_pass(totals, "control totals"), totals.schema))
    if not reports:
        return spark.createDataFrame([], "silver_total double, status string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def publish_catalog(
    marts: Mapping[str, DataFrame], database: str, mode: str = "upsert"
) -> None:
    """Publish marts as catalog tables: row-level MERGE by key, or create-or-replace.

    MERGE needs a catalog whose table format supports it.
    """

    def write(item: tuple[str, DataFrame]) -> None:
        name, df = item
        if mode == "upsert":
            upsert_table(stamped(df), f"{database}.{name}", MARTS[name].key)
        else:
            create_or_replace(stamped(df), f"{database}.{name}")

    each(next(iter(marts.values())).sparkSession, write, marts.items())


def validate_gold(spark: SparkSession, lake: str) -> DataFrame:
    """Write the quality report of the published marts; raise if one of them fails."""
    marts = {n: (read_gold(spark, lake, n), m.key) for n, m in MARTS.items()}
    report = quality_report(marts)
    rows = report.collect()
    checked = spark.createDataFrame(rows, report.schema)
    write_report(checked, f"{lake}/reports/gold_quality_report")
    require_pass(checked, "gold quality", "validation_status")
    return checked.orderBy(F.col("table_name"))
