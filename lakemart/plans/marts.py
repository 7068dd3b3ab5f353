"""The eight performance marts of the logistics model.

Each mart is a function of Silver frames. Measures are aggregated on the fact side
and enriched afterwards, so a mart holds only keys that have facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.aggregates import count_true, exact_sum, mean, total
from lakemart.functions.columns import event_date, full_name, guarded_ratio, pct, ratio
from lakemart.operators.joins import enrich, preaggregate_join, summarize
from lakemart.plans.logistics import PLACES

Tables = Mapping[str, DataFrame]

# Output columns of each mart, in order.
LOAD_COLUMNS = (
    "load_id", "customer_id", "customer_name", "customer_type", "account_status", "route_id",
    "origin_city", "origin_state", "destination_city", "destination_state", "load_date",
    "load_type", "weight_lbs", "pieces", "revenue", "load_status", "booking_type",
    "total_delivery_events", "on_time_events", "total_detention_minutes",
)
DELIVERY_COLUMNS = (
    "event_id", "load_id", "trip_id", "customer_id", "driver_id", "truck_id", "event_type",
    "facility_id", "facility_name", "facility_type", "location_city", "location_state",
    "scheduled_datetime", "actual_datetime", "detention_minutes", "on_time_flag", "revenue",
    "trip_status",
)
DRIVER_COLUMNS = (
    "driver_id", "driver_name", "employment_status", "years_experience", "total_trips",
    "total_distance_miles", "avg_distance_miles", "avg_duration_hours", "total_fuel_gallons",
    "avg_fuel_gallons", "fuel_efficiency_miles_per_gallon", "total_idle_time_hours",
    "avg_idle_time_hours",
)
TRUCK_COLUMNS = (
    "truck_id", "unit_number", "make", "model_year", "fuel_type", "tank_capacity_gallons",
    "status", "total_trips", "total_distance_miles", "avg_distance_miles", "total_fuel_gallons",
    "avg_fuel_per_trip_gallons", "fuel_efficiency_miles_per_gallon", "total_idle_time_hours",
    "avg_idle_time_hours",
)
FACILITY_COLUMNS = (
    "facility_id", "facility_name", "city", "state", "total_events", "on_time_events",
    "on_time_rate", "avg_detention_minutes",
)
ROUTE_COLUMNS = (
    "route_id", "origin_city", "origin_state", "destination_city", "destination_state",
    "typical_distance_miles", "typical_transit_days", "total_trips", "avg_trip_duration_hours",
    "avg_actual_distance_miles", "avg_fuel_consumed_gallons", "fuel_efficiency_miles_per_gallon",
)
CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "customer_type", "account_status", "total_loads",
    "total_revenue", "avg_revenue_per_load", "avg_load_weight_lbs", "total_pieces",
)
DAILY_COLUMNS = (
    "event_date", "total_events", "on_time_events", "on_time_rate", "avg_detention_minutes",
)

# Decimals that measures are stated with. Their sums are exact; Silver rejects values with more.
# A measure that is not listed is added up as a double.
SCALES = dict.fromkeys(
    (
        "revenue", "weight_lbs", "detention_minutes", "actual_distance_miles", "actual_duration_hours",
        "fuel_gallons_used", "idle_time_hours",
    ),
    PLACES,
)

CUSTOMER_ATTRIBUTES = ("customer_name", "customer_type", "account_status")
ROUTE_ENDS = ("origin_city", "origin_state", "destination_city", "destination_state")


def _total(df: DataFrame, column: str) -> Column:
    return total(df, column, SCALES.get(column))


def _mean(df: DataFrame, column: str) -> Column:
    return mean(df, column, SCALES.get(column))


def load_performance(t: Tables) -> DataFrame:
    """One row per load with its delivery figures; loads without events show zeros."""
    events = t["delivery_events"]
    by_load = summarize(
        events,
        "load_id",
        total_delivery_events=F.count("*"),
        on_time_events=count_true("on_time_flag"),
        total_detention_minutes=F.round(_total(events, "detention_minutes"), 2).cast("double"),
    )
    zeros = {"total_delivery_events": 0, "on_time_events": 0, "total_detention_minutes": 0.0}
    mart = preaggregate_join(t["loads"], by_load, "load_id", zeros)
    mart = enrich(mart, t["customers"], "customer_id", *CUSTOMER_ATTRIBUTES)
    mart = enrich(mart, t["routes"], "route_id", *ROUTE_ENDS)
    return mart.select(*LOAD_COLUMNS)


def delivery_performance(t: Tables) -> DataFrame:
    """One row per delivery event. ``revenue`` repeats per event: never sum it here."""
    mart = enrich(t["delivery_events"], t["loads"], "load_id", "customer_id", "revenue")
    # The event's own load decides; the trip brings only its crew and status.
    mart = enrich(mart, t["trips"], "trip_id", "driver_id", "truck_id", "trip_status")
    mart = enrich(mart, t["facilities"], "facility_id", "facility_name", "facility_type")
    return mart.select(*DELIVERY_COLUMNS)


def driver_performance(t: Tables) -> DataFrame:
    """One row per driver with trips."""
    trips = t["trips"]
    mart = summarize(
        trips,
        "driver_id",
        total_trips=F.count("*"),
        total_distance_miles=_total(trips, "actual_distance_miles"),
        avg_distance_miles=_mean(trips, "actual_distance_miles"),
        avg_duration_hours=_mean(trips, "actual_duration_hours"),
        total_fuel_gallons=_total(trips, "fuel_gallons_used"),
        avg_fuel_gallons=_mean(trips, "fuel_gallons_used"),
        total_idle_time_hours=_total(trips, "idle_time_hours"),
        avg_idle_time_hours=_mean(trips, "idle_time_hours"),
    )
    mart = enrich(
        mart,
        t["drivers"],
        "driver_id",
        full_name("first_name", "last_name").alias("driver_name"),
        "employment_status",
        "years_experience",
    )
    mpg = ratio("total_distance_miles", "total_fuel_gallons")
    return mart.withColumn("fuel_efficiency_miles_per_gallon", mpg).select(*DRIVER_COLUMNS)


def truck_performance(t: Tables) -> DataFrame:
    """One row per truck with trips; efficiency is 0 without fuel."""
    trips = t["trips"]
    mart = summarize(
        trips,
        "truck_id",
        total_trips=F.count("*"),
        total_distance_miles=_total(trips, "actual_distance_miles"),
        avg_distance_miles=_mean(trips, "actual_distance_miles"),
        total_fuel_gallons=_total(trips, "fuel_gallons_used"),
        avg_fuel_per_trip_gallons=_mean(trips, "fuel_gallons_used"),
        total_idle_time_hours=_total(trips, "idle_time_hours"),
        avg_idle_time_hours=_mean(trips, "idle_time_hours"),
    )
    mart = enrich(
        mart,
        t["trucks"],
        "truck_id",
        *("unit_number", "make", "model_year", "fuel_type", "tank_capacity_gallons", "status"),
    )
    mpg = guarded_ratio("total_distance_miles", "total_fuel_gallons")
    return mart.withColumn("fuel_efficiency_miles_per_gallon", mpg).select(*TRUCK_COLUMNS)


def _punctuality(events: DataFrame, by) -> DataFrame:
    return summarize(
        events,
        by,
        total_events=F.count("*"),
        on_time_events=count_true("on_time_flag"),
        avg_detention_minutes=_mean(events, "detention_minutes"),
    ).withColumn("on_time_rate", pct("on_time_events", "total_events"))


def facility_performance(t: Tables) -> DataFrame:
    """One row per facility with events."""
    mart = _punctuality(t["delivery_events"], "facility_id")
    mart = enrich(mart, t["facilities"], "facility_id", "facility_name", "city", "state")
    return mart.select(*FACILITY_COLUMNS)


def route_performance(t: Tables) -> DataFrame:
    """One row per route. Averages skip missing values; efficiency is a ratio of averages.

    Trips are first reduced to one row per load (sums and counts), so the join to
    loads is one to one and a load with very many trips is no hot key in it.
    """
    trips = t["trips"]
    measures = {
        "avg_trip_duration_hours": "actual_duration_hours",
        "avg_actual_distance_miles": "actual_distance_miles",
        "avg_fuel_consumed_gallons": "fuel_gallons_used",
    }
    parts = {"_trips": F.count("*")}
    for column in measures.values():
        parts[f"_sum_{column}"] = exact_sum(column, SCALES[column])
        parts[f"_count_{column}"] = F.count(column)
    per_load = enrich(summarize(trips, "load_id", **parts), t["loads"], "load_id", "route_id")
    averages = {
        name: F.try_divide(F.sum(f"_sum_{c}").cast("double"), F.sum(f"_count_{c}"))
        for name, c in measures.items()
    }
    mart = summarize(per_load, "route_id", total_trips=F.sum("_trips"), **averages)
    mart = enrich(
        mart, t["routes"], "route_id", *ROUTE_ENDS, "typical_distance_miles", "typical_transit_days"
    )
    mpg = ratio("avg_actual_distance_miles", "avg_fuel_consumed_gallons")
    return mart.withColumn("fuel_efficiency_miles_per_gallon", mpg).select(*ROUTE_COLUMNS)


def customer_performance(t: Tables) -> DataFrame:
    """One row per customer with loads."""
    loads = t["loads"]
    mart = summarize(
        loads,
        "customer_id",
        total_loads=F.count("*"),
        total_revenue=_total(loads, "revenue"),
        avg_load_weight_lbs=_mean(loads, "weight_lbs"),
        total_pieces=_total(loads, "pieces"),
    )
    mart = enrich(mart, t["customers"], "customer_id", *CUSTOMER_ATTRIBUTES)
    per_load = ratio("total_revenue", "total_loads")
    return mart.withColumn("avg_revenue_per_load", per_load).select(*CUSTOMER_COLUMNS)


def daily_rows(events: DataFrame) -> DataFrame:
    """Daily figures by event time, never by arrival."""
    by_date = event_date("actual_datetime").alias("event_date")
    return _punctuality(events, by_date).select(*DAILY_COLUMNS)


def daily_operations(t: Tables) -> DataFrame:
    """One row per calendar date of the actual event time. Sort when reading it."""
    return daily_rows(t["delivery_events"])


@dataclass(frozen=True)
class Feed:
    """A table whose changed rows concern rows of a mart.

    ``column`` of the changed rows is the mart's key; with ``through`` = (table, on, key) it is
    equal to ``on`` in that table, whose column ``key`` is the mart's key.
    """

    table: str
    column: str
    through: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class Mart:
    """A mart, its grain, the function that builds it, and what its rows depend on.

    ``facts`` are the tables that a part of the mart can be built from alone: by the column that
    holds the mart's key, or by (another of them, column that both share).
    """

    name: str
    key: str
    build: Callable[[Tables], DataFrame]
    feeds: tuple[Feed, ...] = ()
    facts: Mapping[str, str | tuple[str, str]] = field(default_factory=dict)


def with_dates(tables: Tables) -> dict[str, DataFrame]:
    """The tables, events with the date that the daily mart is keyed by."""
    events = tables["delivery_events"]
    return {**tables, "delivery_events": events.withColumn("event_date", event_date("actual_datetime"))}


def _per(table: str, key: str, **parents: str) -> tuple[Feed, ...]:
    """The feeds of a mart of ``key`` over one table of facts; parents by the column that names them."""
    return Feed(table, key), *[Feed(p, c, (table, c, key)) for p, c in parents.items()]


MARTS: dict[str, Mart] = {
    m.name: m
    for m in (
        Mart(
            "gold_load_performance",
            "load_id",
            load_performance,
            (
                *_per("loads", "load_id", customers="customer_id", routes="route_id"),
                Feed("delivery_events", "load_id"),
            ),
            {"loads": "load_id", "delivery_events": "load_id"},
        ),
        Mart(
            "gold_delivery_performance",
            "event_id",
            delivery_performance,
            _per("delivery_events", "event_id", loads="load_id", trips="trip_id", facilities="facility_id"),
            {"delivery_events": "event_id"},
        ),
        Mart(
            "gold_driver_performance",
            "driver_id",
            driver_performance,
            (Feed("trips", "driver_id"), Feed("drivers", "driver_id")),
            {"trips": "driver_id"},
        ),
        Mart(
            "gold_truck_performance",
            "truck_id",
            truck_performance,
            (Feed("trips", "truck_id"), Feed("trucks", "truck_id")),
            {"trips": "truck_id"},
        ),
        Mart(
            "gold_facility_performance",
            "facility_id",
            facility_performance,
            (Feed("delivery_events", "facility_id"), Feed("facilities", "facility_id")),
            {"delivery_events": "facility_id"},
        ),
        Mart(
            "gold_route_performance",
            "route_id",
            route_performance,
            (
                Feed("loads", "route_id"),
                Feed("trips", "load_id", ("loads", "load_id", "route_id")),
                Feed("routes", "route_id"),
            ),
            {"loads": "route_id", "trips": ("loads", "load_id")},
        ),
        Mart(
            "gold_customer_performance",
            "customer_id",
            customer_performance,
            (Feed("loads", "customer_id"), Feed("customers", "customer_id")),
            {"loads": "customer_id"},
        ),
        Mart(
            "gold_daily_operations",
            "event_date",
            daily_operations,
            (Feed("delivery_events", "event_date"),),
            {"delivery_events": "event_date"},
        ),
    )
}
