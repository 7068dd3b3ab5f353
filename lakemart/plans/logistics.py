"""The logistics model: eight operational tables and how each becomes Silver."""

from __future__ import annotations

from lakemart.operators.integrity import ForeignKey
from lakemart.operators.rules import Rule, inexact
from lakemart.plans.spec import Restatement, TableSpec

# Rejection predicates. Zero revenue is valid, zero weight is not.
INVALID_LOADS = Rule(
    "invalid_business_values",
    "weight_lbs IS NULL OR weight_lbs <= 0 OR revenue IS NULL OR revenue < 0",
)
INVALID_TRIPS = Rule(
    "invalid_duration_metrics",
    "actual_duration_hours IS NULL OR idle_time_hours IS NULL "
    "OR actual_duration_hours < 0 OR idle_time_hours < 0 "
    "OR idle_time_hours > actual_duration_hours",
)
INVALID_EVENTS = Rule(
    "invalid_event_timestamps",
    "scheduled_datetime IS NULL OR actual_datetime IS NULL "
    "OR actual_datetime < scheduled_datetime",
)

# Measures are summed exactly, as numbers of so many decimals. A value that is none would fail a mart
# as a whole; its row is rejected instead.
PLACES = 6


def _inexact(*columns: str) -> Rule:
    return Rule("inexact_measure", inexact(columns, PLACES))


INEXACT_LOADS = _inexact("weight_lbs", "revenue")
INEXACT_TRIPS = _inexact(
    "actual_distance_miles", "actual_duration_hours", "fuel_gallons_used", "idle_time_hours"
)

# A cancelled load recognises no revenue.
CANCELLED_REVENUE = Restatement(
    "revenue",
    ("load_status", "revenue"),
    "CASE WHEN upper(load_status) = 'CANCELLED' THEN 0.0D ELSE revenue END",
)

# Keys, column types, recency columns, foreign keys and reasons per table.
CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    casts={"annual_revenue_potential": "double", "contract_start_date": "date"},
    recency=("updated_at", "contract_start_date"),
)
FACILITIES = TableSpec(
    name="facilities",
    key="facility_id",
    casts={"latitude": "double", "longitude": "double"},
    recency=("updated_at",),
)
ROUTES = TableSpec(
    name="routes",
    key="route_id",
    casts={
        "typical_distance_miles": "double",
        "base_rate_per_mile": "double",
        "fuel_surcharge_rate": "double",
        "typical_transit_days": "double",
    },
    recency=("updated_at",),
)
DRIVERS = TableSpec(
    name="drivers",
    key="driver_id",
    casts={"years_experience": "int", "hire_date": "date", "termination_date": "date"},
    recency=("updated_at", "termination_date", "hire_date"),
)
TRUCKS = TableSpec(
    name="trucks",
    key="truck_id",
    casts={
        "model_year": "int",
        "acquisition_mileage": "bigint",
        "tank_capacity_gallons": "double",
        "acquisition_date": "date",
    },
    recency=("updated_at", "acquisition_date"),
)
LOADS = TableSpec(
    name="loads",
    key="load_id",
    casts={
        "weight_lbs": "double",
        "pieces": "int",
        "revenue": "double",
        "load_date": "date",
        "updated_at": "timestamp",
    },
    recency=("updated_at", "load_date"),
    rules=(INVALID_LOADS, INEXACT_LOADS),
    restatements=(CANCELLED_REVENUE,),
    foreign_keys=(
        ForeignKey("customer_id", "customers", "customer_id", "invalid_customer_fk"),
        ForeignKey("route_id", "routes", "route_id", "invalid_route_fk"),
    ),
)
TRIPS = TableSpec(
    name="trips",
    key="trip_id",
    casts={
        "actual_distance_miles": "double",
        "actual_duration_hours": "double",
        "fuel_gallons_used": "double",
        "idle_time_hours": "double",
        "dispatch_date": "date",
        "updated_at": "timestamp",
    },
    recency=("updated_at", "dispatch_date"),
    rules=(INVALID_TRIPS, INEXACT_TRIPS),
    foreign_keys=(
        ForeignKey("load_id", "loads", "load_id", "invalid_load_fk"),
        ForeignKey("driver_id", "drivers", "driver_id", "invalid_driver_fk"),
        ForeignKey("truck_id", "trucks", "truck_id", "invalid_truck_fk"),
    ),
)
DELIVERY_EVENTS = TableSpec(
    name="delivery_events",
    key="event_id",
    casts={
        "detention_minutes": "int",
        "on_time_flag": "boolean",
        "scheduled_datetime": "timestamp",
        "actual_datetime": "timestamp",
        "updated_at": "timestamp",
    },
    recency=("updated_at", "actual_datetime", "scheduled_datetime"),
    rules=(INVALID_EVENTS,),
    foreign_keys=(
        ForeignKey("load_id", "loads", "load_id", "orphan_load_fk"),
        ForeignKey("trip_id", "trips", "trip_id", "orphan_trip_fk"),
        ForeignKey("facility_id", "facilities", "facility_id", "invalid_facility_fk"),
    ),
)

# Parents before children.
SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (CUSTOMERS, FACILITIES, ROUTES, DRIVERS, TRUCKS, LOADS, TRIPS, DELIVERY_EVENTS)
}

# Columns a batch of loads must bring to pass intake.
REQUIRED_LOAD_COLUMNS = (
    "load_id",
    "customer_id",
    "route_id",
    "load_date",
    "weight_lbs",
    "pieces",
    "revenue",
    "load_status",
)

# Silver tables that must hold rows before Gold may run, and marts that
# must exist after it.
GATED_SILVER = ("loads", "trips", "delivery_events", "customers", "routes")
GATED_GOLD = (
    "gold_load_performance",
    "gold_customer_performance",
    "gold_delivery_performance",
    "gold_daily_operations",
)

# Violations counted by the strict data check. Unlike the Silver rules
# it also objects to zero revenue, distance, duration and fuel.
STRICT_CHECKS: dict[str, dict[str, str]] = {
    "loads": {
        "invalid_weight": "weight_lbs <= 0",
        "invalid_revenue": "revenue <= 0",
    },
    "trips": {
        "invalid_distance": "actual_distance_miles <= 0",
        "invalid_duration": "actual_duration_hours <= 0",
        "invalid_fuel": "fuel_gallons_used <= 0",
        "negative_idle": "idle_time_hours < 0",
        "idle_exceeds_duration": "idle_time_hours > actual_duration_hours",
    },
    "delivery_events": {
        "invalid_scheduled_datetime": "scheduled_datetime IS NULL",
        "invalid_actual_datetime": "actual_datetime IS NULL",
        "actual_before_scheduled": "actual_datetime < scheduled_datetime",
    },
}
