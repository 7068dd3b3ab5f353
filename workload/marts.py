"""Marts and the reports served from them."""

from __future__ import annotations

from lakemart.plans import marts, serving
from workload.oracle_roles import half_up, with_roles
from workload.roles import scans, typed, typed_unique


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE)"


def load_performance(spark, sf_dir):
    names = ("loads", "customers", "routes", "delivery_events")
    return marts.load_performance(typed(spark, sf_dir, *names))


def delivery_performance(spark, sf_dir):
    return marts.delivery_performance(typed_unique(spark, sf_dir))


def driver_performance(spark, sf_dir):
    return marts.driver_performance(typed(spark, sf_dir, "trips", "drivers"))


def truck_performance(spark, sf_dir):
    return marts.truck_performance(typed(spark, sf_dir, "trips", "trucks"))


def facility_performance(spark, sf_dir):
    return marts.facility_performance(typed(spark, sf_dir, "delivery_events", "facilities"))


def route_performance(spark, sf_dir):
    return marts.route_performance(typed(spark, sf_dir, "trips", "loads", "routes"))


def customer_performance(spark, sf_dir):
    return marts.customer_performance(typed(spark, sf_dir, "loads", "customers"))


def daily_operations(spark, sf_dir):
    return marts.daily_operations({"delivery_events": scans(spark, sf_dir)})


def route_sla(spark, sf_dir):
    return serving.route_sla(route_performance(spark, sf_dir))


def top_facilities(spark, sf_dir):
    return serving.top_facilities(facility_performance(spark, sf_dir))


def daily_report(spark, sf_dir):
    return serving.daily_report(daily_operations(spark, sf_dir))


DRIVER = f"""
    SELECT a.driver_id, concat_ws(' ', first_name, last_name) AS driver_name, employment_status,
           years_experience, total_trips, total_distance_miles,
           total_distance_miles / n_dist AS avg_distance_miles,
           total_dur / n_dur AS avg_duration_hours, total_fuel_gallons,
           total_fuel_gallons / n_fuel AS avg_fuel_gallons,
           {half_up("total_distance_miles / total_fuel_gallons")} AS fuel_efficiency_miles_per_gallon,
           total_idle_time_hours, total_idle_time_hours / n_idle AS avg_idle_time_hours
    FROM (SELECT driver_id, count(*) AS total_trips,
                 {_money("actual_distance_miles")} AS total_distance_miles,
                 count(actual_distance_miles) AS n_dist,
                 {_money("actual_duration_hours")} AS total_dur,
                 count(actual_duration_hours) AS n_dur,
                 {_money("fuel_gallons_used")} AS total_fuel_gallons,
                 count(fuel_gallons_used) AS n_fuel,
                 {_money("idle_time_hours")} AS total_idle_time_hours,
                 count(idle_time_hours) AS n_idle
          FROM trips GROUP BY driver_id) a
    LEFT JOIN drivers d ON a.driver_id = d.driver_id"""

TRUCK = f"""
    SELECT a.truck_id, unit_number, make, model_year, fuel_type, tank_capacity_gallons, status,
           total_trips, total_distance_miles,
           total_distance_miles / n_dist AS avg_distance_miles, total_fuel_gallons,
           total_fuel_gallons / n_fuel AS avg_fuel_per_trip_gallons,
           CASE WHEN total_fuel_gallons > 0
                THEN {half_up("total_distance_miles / total_fuel_gallons")} ELSE 0.0 END
               AS fuel_efficiency_miles_per_gallon,
           total_idle_time_hours, total_idle_time_hours / n_idle AS avg_idle_time_hours
    FROM (SELECT truck_id, count(*) AS total_trips,
                 {_money("actual_distance_miles")} AS total_distance_miles,
                 count(actual_distance_miles) AS n_dist,
                 {_money("fuel_gallons_used")} AS total_fuel_gallons,
                 count(fuel_gallons_used) AS n_fuel,
                 {_money("idle_time_hours")} AS total_idle_time_hours,
                 count(idle_time_hours) AS n_idle
          FROM trips GROUP BY truck_id) a
    LEFT JOIN trucks d ON a.truck_id = d.truck_id"""

LOAD = """
    SELECT l.load_id, l.customer_id, customer_name, customer_type, account_status, l.route_id,
           origin_city, origin_state, destination_city, destination_state, load_date, load_type,
           weight_lbs, pieces, revenue, load_status, booking_type,
           coalesce(n, 0) AS total_delivery_events, coalesce(good, 0) AS on_time_events,
           coalesce(detention, 0.0) AS total_detention_minutes
    FROM loads l
    LEFT JOIN customers c ON l.customer_id = c.customer_id
    LEFT JOIN routes r ON l.route_id = r.route_id
    LEFT JOIN (SELECT load_id, count(*) AS n,
                      count(*) FILTER (WHERE on_time_flag) AS good,
                      CAST(sum(detention_minutes) AS DOUBLE) AS detention
               FROM delivery_events GROUP BY load_id) e ON l.load_id = e.load_id"""

DELIVERY = """
    SELECT e.event_id, e.load_id, e.trip_id, l.customer_id, t.driver_id, t.truck_id, e.event_type,
           e.facility_id, f.facility_name, f.facility_type, e.location_city, e.location_state,
           e.scheduled_datetime, e.actual_datetime, e.detention_minutes, e.on_time_flag,
           l.revenue, t.trip_status
    FROM unique_events e
    LEFT JOIN loads l ON e.load_id = l.load_id
    LEFT JOIN unique_trips t ON e.trip_id = t.trip_id
    LEFT JOIN facilities f ON e.facility_id = f.facility_id"""

FACILITY = f"""
    SELECT a.facility_id, facility_name, city, state, total_events, on_time_events,
           {half_up("CAST(on_time_events AS DOUBLE) / total_events * 100")} AS on_time_rate,
           avg_detention_minutes
    FROM (SELECT facility_id, count(*) AS total_events,
                 count(*) FILTER (WHERE on_time_flag) AS on_time_events,
                 CAST(sum(detention_minutes) AS DOUBLE) / count(detention_minutes)
                     AS avg_detention_minutes
          FROM delivery_events GROUP BY facility_id) a
    LEFT JOIN facilities f ON a.facility_id = f.facility_id"""

ROUTE = f"""
    SELECT a.route_id, origin_city, origin_state, destination_city, destination_state,
           typical_distance_miles, typical_transit_days, total_trips,
           dur / n_dur AS avg_trip_duration_hours, dist / n_dist AS avg_actual_distance_miles,
           fuel / n_fuel AS avg_fuel_consumed_gallons,
           {half_up("(dist / n_dist) / (fuel / n_fuel)")} AS fuel_efficiency_miles_per_gallon
    FROM (SELECT l.route_id, count(*) AS total_trips,
                 {_money("actual_duration_hours")} AS dur, count(actual_duration_hours) AS n_dur,
                 {_money("actual_distance_miles")} AS dist, count(actual_distance_miles) AS n_dist,
                 {_money("fuel_gallons_used")} AS fuel, count(fuel_gallons_used) AS n_fuel
          FROM trips t LEFT JOIN loads l ON t.load_id = l.load_id GROUP BY l.route_id) a
    LEFT JOIN routes r ON a.route_id = r.route_id"""

CUSTOMER = f"""
    SELECT a.customer_id, customer_name, customer_type, account_status, total_loads,
           total_revenue, {half_up("total_revenue / total_loads")} AS avg_revenue_per_load,
           weight / n_weight AS avg_load_weight_lbs, total_pieces
    FROM (SELECT customer_id, count(*) AS total_loads, {_money("revenue")} AS total_revenue,
                 {_money("weight_lbs")} AS weight, count(weight_lbs) AS n_weight,
                 CAST(sum(pieces) AS BIGINT) AS total_pieces
          FROM loads GROUP BY customer_id) a
    LEFT JOIN customers c ON a.customer_id = c.customer_id"""


def daily_sql(events: str) -> str:
    """Daily figures over a relation with the columns of ``scans``."""
    rate = "CAST(count(*) FILTER (WHERE on_time_flag) AS DOUBLE) / count(*) * 100"
    return f"""
    SELECT CAST(actual_datetime AS DATE) AS event_date, count(*) AS total_events,
           count(*) FILTER (WHERE on_time_flag) AS on_time_events,
           {half_up(rate)} AS on_time_rate,
           {_money("detention_minutes")} / count(detention_minutes) AS avg_detention_minutes
    FROM {events} GROUP BY 1"""


QUERIES = {
    "load_performance": load_performance,
    "delivery_performance": delivery_performance,
    "driver_performance": driver_performance,
    "truck_performance": truck_performance,
    "facility_performance": facility_performance,
    "route_performance": route_performance,
    "customer_performance": customer_performance,
    "daily_operations": daily_operations,
    "route_sla": route_sla,
    "top_facilities": top_facilities,
    "daily_report": daily_report,
}

ORACLE = {
    "load_performance": with_roles(LOAD),
    "delivery_performance": with_roles(DELIVERY),
    "driver_performance": with_roles(DRIVER),
    "truck_performance": with_roles(TRUCK),
    "facility_performance": with_roles(FACILITY),
    "route_performance": with_roles(ROUTE),
    "customer_performance": with_roles(CUSTOMER),
    "daily_operations": with_roles(daily_sql("scans")),
    "route_sla": with_roles(
        f"""SELECT route_id, origin_city, destination_city, total_trips,
               {half_up("avg_trip_duration_hours")} AS avg_duration_hrs,
               fuel_efficiency_miles_per_gallon
        FROM ({ROUTE}) WHERE total_trips >= 25
        ORDER BY fuel_efficiency_miles_per_gallon ASC NULLS LAST, route_id"""
    ),
    "top_facilities": with_roles(
        f"""SELECT facility_id, facility_name, city, state, total_events, on_time_rate,
               {half_up("m")} AS avg_detention_minutes
        FROM (SELECT * RENAME (avg_detention_minutes AS m) FROM ({FACILITY}))
        ORDER BY m DESC NULLS LAST, facility_id LIMIT 10"""
    ),
    "daily_report": with_roles(f"{daily_sql('scans')} ORDER BY event_date"),
}
