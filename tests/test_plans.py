"""Shapes of physical plans: hot keys are split, joins are equi joins, scans are narrow."""

from __future__ import annotations

import datetime
import io
from contextlib import contextmanager, redirect_stdout

import pytest
from pyspark.sql import functions as F

from lakemart.operators import batches as late
from lakemart.operators import dedup, integrity, joins
from lakemart.operators.quarantine import classify
from lakemart.operators.rules import Rule, invalid_rows, present_key
from lakemart.plans import marts
from lakemart.plans.logistics import TRIPS
from lakemart.sinks.tables import create_bucketed
from lakemart.sources.tables import read_unique
from workload import batches, checks, files, rows
from workload import columns as scalar
from workload import marts as mart_queries

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def large(spark):
    """Thresholds scaled down, so that small frames behave like large ones."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="4KB",
        spark__sql__shuffle__partitions=16,
    ):
        yield


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_child(spark):
    """A third of the keys NULL, a third one value, the rest spread."""
    return spark.range(0, 30000, 1, 8).selectExpr(
        "id",
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'hot' ELSE CAST(id % 5000 AS STRING) END AS fk",
        "CAST(id AS STRING) AS payload",
    )


@pytest.fixture
def keys(spark):
    spread = spark.range(2500).selectExpr("CAST(id AS STRING) AS k")
    return spread.union(spark.range(1).selectExpr("'hot' AS k"))


def test_hot_and_null_foreign_keys_are_split(large, hot_child, keys):
    edge = integrity.ForeignKey("fk", "p", "k", "orphan")
    checked = integrity.with_fk_reason(hot_child, [edge], {"p": keys}, "why")
    assert "SortMergeJoin(skew=true)" in executed(checked)
    # The same figures from a plain count.
    valid = hot_child.where("fk = 'hot' OR CAST(fk AS INT) < 2500").count()
    assert checked.where("why IS NULL").count() == valid


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("check", [integrity.orphans, integrity.valid_fk])
def test_semi_and_anti_joins_are_split(large, hot_child, keys, unique, check):
    parent = keys if unique else keys.union(keys)
    assert "SortMergeJoin(skew=true)" in executed(check(hot_child, "fk", parent, "k", unique))


def test_fact_enrichment_is_split(large, hot_child, keys):
    fact = hot_child.withColumnRenamed("fk", "k")
    assert "SortMergeJoin(skew=true)" in executed(joins.enrich(fact, keys, "k"))


def test_foreign_keys_are_split_behind_the_dedup(large, spark):
    trips = spark.range(0, 20000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS trip_id",
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS load_id",
        "'d' AS driver_id", "'t' AS truck_id", "'2026-01-01' AS dispatch_date",
        "'1' AS actual_distance_miles", "'1' AS actual_duration_hours",
        "'1' AS fuel_gallons_used", "'1' AS idle_time_hours",
    )
    parents = {
        "loads": trips.select("load_id").distinct().repartition(8),
        "drivers": spark.createDataFrame([("d",)], "driver_id string"),
        "trucks": spark.createDataFrame([("t",)], "truck_id string"),
    }
    classified = classify(trips, TRIPS, parents)
    # Hot load, then one driver and one truck for all trips: each join is split.
    assert executed(classified).count("SortMergeJoin(skew=true)") == 3
    assert classified.where("quarantine_reason IS NULL").count() == 20000


def test_hot_primary_key_is_reduced_before_the_shuffle(spark):
    lines = spark.range(0, 100000, 1, 8).selectExpr("'same' AS k", "id")
    best = dedup.latest_state(lines, "k")
    text = plan(best)
    assert text.index("partial_max") < len(text) and text.count("Exchange") >= 1
    assert best.collect() == [("same", 99999)]
    metrics = executed(best)
    assert "Window" not in metrics


def test_rejects_without_key_spread_over_partitions(spark):
    """NULL keys do not meet in one task: rejects are grouped by content and incoming partition."""
    trips = spark.range(0, 4000, 1, 4).selectExpr(
        "CAST(NULL AS STRING) AS trip_id", "CAST(id AS STRING) AS load_id", "'d' AS driver_id",
        "'t' AS truck_id", "'x' AS dispatch_date", "'1' AS actual_distance_miles",
        "'1' AS actual_duration_hours", "'1' AS fuel_gallons_used", "'1' AS idle_time_hours",
    )
    one = spark.createDataFrame([("l", "d", "t")], "load_id string, driver_id string, truck_id string")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        classified = classify(trips, TRIPS, {"loads": one, "drivers": one, "trucks": one})
        sizes = classified.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in sizes) == 4000
    assert max(r[1] for r in sizes) < 2000
    # Equal rejects meet in one group per incoming partition at most, as one row with a count.
    equal = classify(trips.withColumn("load_id", F.lit("l")), TRIPS, {"loads": one, "drivers": one, "trucks": one})
    assert equal.count() == 4000
    assert "partial_count" in plan(equal)


def test_mart_scans_are_narrow(spark):
    text = plan(mart_queries.daily_operations(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    text = plan(mart_queries.customer_performance(spark, SF))
    assert "c_acctbal" in text and "c_nationkey" not in text and "o_orderdate" not in text


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    cheap = Rule("cheap", "o_totalprice IS NULL OR o_totalprice < 2000")
    assert "PushedFilters: [Or(IsNull(o_totalprice),LessThan(o_totalprice,2000.0))]" in plan(
        invalid_rows(orders, cheap)
    )
    text = plan(present_key(orders, "o_custkey"))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_aggregates_are_partial_and_fan_out_free(spark):
    text = plan(mart_queries.load_performance(spark, SF))
    assert "partial_count" in text
    # One shuffle for the child summary; dimensions are broadcast by size.
    assert "BroadcastHashJoin" in text


def test_daily_mart_has_one_shuffle(spark):
    text = plan(mart_queries.daily_operations(spark, SF), "simple")
    assert text.count("Exchange") == 1


# These write tables first; their plan is a plain read.
EAGER = {
    "silver_trips",
    "silver_delivery_events",
    "quarantined_trips",
    "quarantined_delivery_events",
    "silver_job",
    "silver_counts",
    "quarantine_audit",
    "upsert",
    "upsert_by_partition",
    "partition_overwrite",
    "medallion_run",
    "key_crosswalk",
    "mapped_keys",
    *files.QUERIES,
}


def test_no_query_multiplies_rows_or_leaves_the_jvm(spark):
    modules = (mart_queries, scalar, rows, batches, checks)
    for module in modules:
        for name, query in module.QUERIES.items():
            if name in EAGER:
                continue
            text = plan(query(spark, SF))
            for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
                assert banned not in text, f"{name}: {banned}"


def test_marts_are_lazy(spark, frame):
    """Building a mart starts no job."""
    events = frame("event_id int, actual_datetime timestamp, on_time_flag boolean, detention_minutes int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job may start")
    marts.daily_operations({"delivery_events": events})
    assert list(tracker.getJobIdsForGroup("lazy")) == []


def test_late_deltas_read_each_input_once(spark, frame, tmp_path, rows):
    kind = "k string, at date, n int"
    day = datetime.date
    inputs = {
        "base": [("a", day(2026, 1, 1), 1), ("b", day(2026, 1, 1), 2), ("c", day(2026, 1, 2), 4), ("e", day(2026, 1, 9), 5)],
        # a moves on, b is an older version, d is new, e's last version is repeated, c is corrected
        "late": [
            ("a", day(2026, 1, 3), 1), ("b", day(2025, 12, 31), 9), ("d", day(2026, 1, 1), None),
            ("e", day(2026, 1, 9), 5), ("c", day(2026, 1, 2), 5), ("c", day(2026, 1, 2), 3),
        ],
        "totals": [(day(2026, 1, 1), 2, 3), (day(2026, 1, 2), 1, 4), (day(2026, 1, 9), 1, 5)],
    }
    for name, data in inputs.items():
        schema = "at date, events long, total long" if name == "totals" else kind
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in inputs}
    measures = {"events": F.lit(1).cast("long"), "total": F.col("n").cast("long")}
    found = late.restated_totals(
        read["totals"], read["base"], read["late"], "k", ["at"], lambda: F.col("at"), "at", measures
    )
    assert rows(found, "at", "events", "total") == [
        (day(2026, 1, 1), 2, 2), (day(2026, 1, 2), 1, 5), (day(2026, 1, 3), 1, 1)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3
    empty = late.restated_totals(
        read["totals"], read["base"], read["late"].limit(0), "k", ["at"], lambda: F.col("at"), "at", measures
    )
    assert empty.collect() == []


def test_grain_guard_without_a_shuffle(spark, frame, tmp_path):
    sound = frame("k long, v string", *[(i, "x") for i in range(50)])
    create_bucketed(sound, "guard_sound", "k", 4, str(tmp_path / "sound"))
    create_bucketed(sound.union(sound.limit(1)), "guard_repeated", "k", 4, str(tmp_path / "repeated"))
    create_bucketed(sound.union(frame("k long, v string", (None, "y"))), "guard_null", "k", 4, str(tmp_path / "null"))
    try:
        guarded = read_unique(spark, "guard_sound", "k")
        assert guarded.count() == 50 and guarded.columns == ["k", "v"]
        assert "Exchange" not in guarded._jdf.queryExecution().executedPlan().toString()
        for name in ("guard_repeated", "guard_null"):
            with pytest.raises(Exception, match="repeated or missing k"):
                read_unique(spark, name, "k").select("v").collect()
    finally:
        for name in ("guard_sound", "guard_repeated", "guard_null"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
