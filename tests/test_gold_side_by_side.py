"""Gold brought up to date by key: narrow sides are hashed, marts are merged side by side."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from lakemart.plans import gold, silver
from lakemart.plans.concurrent import each
from lakemart.session import HASHED
from lakemart.sources.tables import read_gold

DELIVERED = {
    "customers": ("customer_id string, customer_name string, customer_type string, account_status string, "
                  "contract_start_date string, annual_revenue_potential string",
                  [("1", "a", "t", "s", None, "1"), ("2", "b", "t", "s", None, "1")]),
    "facilities": ("facility_id string, facility_name string, facility_type string, city string, state string, "
                   "latitude string, longitude string", [("1", "f", "t", "c", "s", "1", "1")]),
    "routes": ("route_id string, origin_city string, origin_state string, destination_city string, "
               "destination_state string, typical_distance_miles string, base_rate_per_mile string, "
               "fuel_surcharge_rate string, typical_transit_days string", [("1", "a", "b", "c", "d", "1", "1", "1", "1")]),
    "drivers": ("driver_id string, first_name string, last_name string, hire_date string, termination_date string, "
                "employment_status string, years_experience string", [("1", "x", "y", None, None, "s", "1")]),
    "trucks": ("truck_id string, unit_number string, make string, model_year string, acquisition_date string, "
               "acquisition_mileage string, fuel_type string, tank_capacity_gallons string, status string",
               [("1", "u", "m", "1", None, "1", "f", "1", "s")]),
    "loads": ("load_id string, customer_id string, route_id string, load_date string, load_type string, weight_lbs string, "
              "pieces string, revenue string, load_status string, booking_type string",
              [(str(i), str(i % 2 + 1), "1", "2026-01-01", "t", "1", "1", "10", "COMPLETED", "b") for i in range(4)]),
    "trips": ("trip_id string, load_id string, driver_id string, truck_id string, dispatch_date string, "
              "actual_distance_miles string, actual_duration_hours string, fuel_gallons_used string, idle_time_hours string, "
              "trip_status string", [(str(i), str(i), "1", "1", "2026-01-01", "1", "2", "1", "1", "s") for i in range(4)]),
    "delivery_events": ("event_id string, load_id string, trip_id string, event_type string, facility_id string, "
                        "scheduled_datetime string, actual_datetime string, detention_minutes string, on_time_flag string, "
                        "location_city string, location_state string",
                        [(str(i), str(i), str(i), "t", "1", "2026-01-01", "2026-01-02", "1", "true", "c", "s") for i in range(4)]),
}


@pytest.fixture
def deliveries(spark):
    first = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in DELIVERED.items()}
    return first, {**first, "loads": first["loads"].withColumn("revenue", F.lit("20"))}


def test_marts_are_merged_side_by_side(spark, deliveries, tmp_path, rows, monkeypatch):
    """Each merge waits for another one; with one after the other, none would come."""
    lake, together, merge = str(tmp_path), threading.Barrier(2), gold.upsert_partitions
    first, second = deliveries
    silver.run_silver(spark, lake, first)
    gold.run_gold(spark, lake, "upsert", buckets=2)
    met = []

    def wait(rows, target, *a, **k):
        if target.endswith(("gold_load_performance", "gold_customer_performance")):
            together.wait(60)
            met.append(target)
        return merge(rows, target, *a, **k)

    monkeypatch.setattr(gold, "upsert_partitions", wait)
    silver.run_silver(spark, lake, second)
    gold.run_gold(spark, lake, "upsert", buckets=2)
    assert len(met) == 2
    assert rows(read_gold(spark, lake, "gold_customer_performance"), "customer_id", "total_revenue") == [("1", 40.0), ("2", 40.0)]
    assert rows(read_gold(spark, lake, "gold_load_performance"), "load_id", "revenue") == [(str(i), 20.0) for i in range(4)]


@pytest.mark.parametrize("mode", ["replace", "upsert"])
def test_marts_hash_narrow_sides(spark, deliveries, tmp_path, monkeypatch, mode):
    """While marts are built and merged, and not after."""
    lake, seen = str(tmp_path), []
    former = {n: spark.conf.get(n) for n in HASHED}
    for name in ("_refresh", "_update"):
        inner = getattr(gold, name)

        def noting(*a, inner=inner):
            seen.append({n: spark.conf.get(n) for n in HASHED})
            return inner(*a)

        monkeypatch.setattr(gold, name, noting)
    for tables in deliveries:
        silver.run_silver(spark, lake, tables)
        gold.run_gold(spark, lake, mode, buckets=2)
        assert {n: spark.conf.get(n) for n in HASHED} == former
    assert seen == [HASHED, HASHED]


def test_jobs_side_by_side_have_properties_of_their_own(spark):
    """Spark keeps the number of a running query there; one that another thread takes away fails the query."""
    together = threading.Barrier(2)

    def job(name):
        spark.sparkContext.setLocalProperty("lakemart.test", name)
        together.wait(60)
        return spark.sparkContext.getLocalProperty("lakemart.test")

    assert each(spark, job, ["a", "b"]) == ["a", "b"]
