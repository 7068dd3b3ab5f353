"""The six failure scenarios, on Spark."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakemart.functions import restate_cancelled
from lakemart.operators import batches, joins, quality
from lakemart.plans import marts
from lakemart.plans.logistics import REQUIRED_LOAD_COLUMNS
from lakemart.sinks import tables
from lakemart.sources import raw
from lakemart.sources.tables import read_path


def test_duplicate_delivery(spark):
    batch = spark.range(1, 101).selectExpr(
        "format_string('LD%05d', id) AS load_id",
        "format_string('CUST%03d', id % 10 + 1) AS customer_id",
        "format_string('RT%03d', id % 5 + 1) AS route_id",
        "CAST(12000 + id * 50 AS INT) AS weight_lbs",
        "CAST(20 + id % 15 AS INT) AS pieces",
        "CAST(250 + id * 5 AS DOUBLE) AS revenue",
        "'DELIVERED' AS load_status",
    )
    customers = batch.select(
        "customer_id", *[F.lit(None).cast("string").alias(c) for c in marts.CUSTOMER_ATTRIBUTES]
    ).distinct()
    for delivered in (batch, batches.union_batches(batch, batch)):
        loads = batches.apply_corrections(delivered, delivered.limit(0), "load_id", [])
        mart = marts.customer_performance({"loads": loads, "customers": customers})
        assert loads.count() == 100
        assert loads.agg(F.sum("revenue")).first()[0] == 50250.0
        assert mart.count() == 10
        assert mart.agg(F.sum("total_revenue")).first()[0] == 50250.0


@pytest.fixture
def shipments(spark):
    loads = spark.range(1, 51).selectExpr(
        "format_string('LD%05d', id) AS load_id",
        "format_string('CUST%03d', id % 5 + 1) AS customer_id",
        "1000.0D AS revenue",
        "15000 AS weight_lbs",
    )
    steps = "array('PICKUP', 'DEPART', 'HUB_SCAN', 'ARRIVE', 'DELIVERED')"
    events = loads.selectExpr(
        "load_id", f"explode({steps}) AS event_type", "15.0D AS detention_minutes",
        "true AS on_time_flag",
    )
    return loads, events


def test_child_table_fanout(shipments):
    loads, events = shipments
    naive = joins.fanout_factor(loads, events, "load_id", "revenue").first()
    assert (naive.joined_rows, naive.joined_total, naive.inflation_factor) == (250, 250000.0, 5.0)
    summary = joins.summarize(
        events, "load_id", total_events=F.count("*"), detention=F.sum("detention_minutes")
    )
    safe = joins.preaggregate_join(loads, summary, "load_id", {"total_events": 0, "detention": 0.0})
    got = safe.agg(F.count("*"), F.sum("revenue"), F.sum("detention"), F.sum("total_events")).first()
    assert tuple(got) == (50, 50000.0, 3750.0, 250)


def test_order_correction(frame, rows):
    schema = (
        "load_id string, customer_id string, revenue double, load_status string, updated_at string"
    )
    day1 = frame(
        schema,
        ("LD00001", "CUST001", 1200.0, "COMPLETED", "2026-10-01 09:00:00"),
        ("LD00002", "CUST001", 1500.0, "COMPLETED", "2026-10-01 10:00:00"),
        ("LD00003", "CUST002", 1800.0, "COMPLETED", "2026-10-01 11:00:00"),
        ("LD00004", "CUST002", 2000.0, "COMPLETED", "2026-10-01 12:00:00"),
    )
    corrections = frame(
        schema,
        ("LD00003", "CUST002", 1800.0, "CANCELLED", "2026-10-02 08:30:00"),
        ("LD00002", "CUST001", 1650.0, "COMPLETED", "2026-10-02 09:15:00"),
    )

    def restated(later):
        latest = batches.apply_corrections(day1, later, "load_id", ["updated_at"])
        return latest.withColumn("revenue", restate_cancelled("revenue", "load_status"))

    assert restated(day1.limit(0)).agg(F.sum("revenue")).first()[0] == 6500.0
    after = restated(corrections)
    assert after.agg(F.sum("revenue")).first()[0] == 4850.0
    assert rows(after.where("load_id = 'LD00003'"), "load_status", "revenue") == [("CANCELLED", 0.0)]
    # Redelivered corrections change nothing.
    assert rows(restated(corrections.union(corrections))) == rows(after)


def _events(frame, *data):
    df = frame("event_id string, at string, detention_minutes int, on_time_flag boolean, updated_at string", *data)
    return df.withColumn("actual_datetime", F.to_timestamp("at")).drop("at")


def _restate(base, late):
    return batches.restate_dates(
        mart=marts.daily_rows(base), base=base, late=late, key="event_id", recency=["updated_at"],
        date_of=lambda: F.to_date("actual_datetime"), date_column="event_date",
        summarize=marts.daily_rows,
    )


def test_late_event(frame, rows):
    base = _events(
        frame,
        ("EVT001", "2026-10-01", 20, True, "2026-10-01 14:00:00"),
        ("EVT002", "2026-10-01", 10, True, "2026-10-01 15:00:00"),
    )
    before = marts.daily_rows(base).first()
    assert (before.total_events, before.on_time_rate, before.avg_detention_minutes) == (2, 100.0, 15.0)
    late = _events(frame, ("EVT003", "2026-10-01", 90, False, "2026-10-08 10:00:00"))
    after = _restate(base, late).collect()
    assert len(after) == 1
    assert (after[0].total_events, after[0].on_time_rate, after[0].avg_detention_minutes) == (
        3, 66.67, 40.0,
    )


def test_late_events_that_move_or_lose(frame, rows):
    base = _events(
        frame,
        ("A", "2026-10-01", 20, True, "1"),
        ("B", "2026-10-02", 10, True, "1"),
        ("C", "2026-10-03", 30, True, "1"),
        ("D", "2026-10-04", 50, True, "1"),
        ("D2", None, 50, True, "1"),
    )
    late = _events(
        frame,
        ("A", "2026-10-02", 60, False, "2"),  # moves: its old date disappears
        ("C", "2026-10-01", 99, False, "0"),  # older than the known state: no effect
    )
    restated = _restate(base, late)
    everything = marts.daily_rows(
        batches.apply_corrections(base, late, "event_id", ["updated_at"])
    )
    assert rows(restated) == rows(everything)
    assert "2026-10-01" not in {str(r.event_date) for r in restated.collect()}


def test_blocked_publish_and_retry(spark, frame, tmp_path):
    store = str(tmp_path / "gold_loads")
    batch = spark.range(1, 26).selectExpr(
        "format_string('LD%05d', id) AS load_id", "'CUST001' AS customer_id", "1000.0D AS revenue"
    )
    poisoned = batch.union(frame("a string, b string, c double", ("LD00001", "CUST001", -1.0)))

    def publish(df):
        quality.require_pass(quality.batch_gate(df, "revenue"), "batch")
        tables.upsert(df, store, "load_id")

    with pytest.raises(quality.GateFailed):
        publish(poisoned)
    with pytest.raises(quality.GateFailed):
        publish(batch.limit(0))
    assert not (tmp_path / "gold_loads").exists()
    for _ in range(2):
        publish(batch)
        published = read_path(spark, store)
        assert published.count() == 25
        assert published.agg(F.sum("revenue")).first()[0] == 25000.0


@pytest.mark.parametrize(
    "text, status",
    [
        (",".join(REQUIRED_LOAD_COLUMNS) + "\n", "EMPTY_VALID_BATCH"),
        (",".join(REQUIRED_LOAD_COLUMNS) + ",extra\nL1,C,R,2026-01-01,1,1,1,X,y\n", "VALID_DATA"),
        ("load_id,customer_id,wrong_column\nLD001,CUST001,123\n", "SCHEMA_CORRUPTION"),
        ("", "SCHEMA_CORRUPTION"),
        (" \n\n", "SCHEMA_CORRUPTION"),
    ],
)
def test_intake(spark, tmp_path, text, status):
    path = tmp_path / "loads.csv"
    path.write_text(text)
    if status == "SCHEMA_CORRUPTION":
        with pytest.raises(raw.SchemaCorruption):
            raw.inspect_batch(spark, str(path), REQUIRED_LOAD_COLUMNS)
    else:
        found, df = raw.inspect_batch(spark, str(path), REQUIRED_LOAD_COLUMNS)
        assert found == status
        assert df.count() == (status == "VALID_DATA")
    report = raw.intake_status(spark, {"b": str(path)}, {"b": REQUIRED_LOAD_COLUMNS})
    assert report.first().status == status


def test_missing_batch(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw.inspect_batch(spark, str(tmp_path / "none.csv"), REQUIRED_LOAD_COLUMNS)
