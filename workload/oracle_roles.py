"""The roles and their Silver form as SQL common table expressions."""

from __future__ import annotations

import re

ROLES = {
    "nations": """
        SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
               CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS account_status,
               CAST(NULL AS DATE) AS contract_start_date, c_acctbal AS annual_revenue_potential
        FROM customer""",
    "routes": """
        SELECT CAST(n_nationkey AS BIGINT) AS route_id, n_name AS origin_city,
               r_name AS origin_state, n_name AS destination_city, r_name AS destination_state,
               CAST(n_nationkey * 100 AS DOUBLE) AS typical_distance_miles,
               CAST(2.5 AS DOUBLE) AS base_rate_per_mile,
               CAST(0.25 AS DOUBLE) AS fuel_surcharge_rate,
               CAST(n_regionkey + 1 AS DOUBLE) AS typical_transit_days
        FROM nations""",
    "facilities": """
        SELECT s_suppkey AS facility_id, s_name AS facility_name,
               CASE WHEN s_acctbal < 0 THEN 'CROSSDOCK' ELSE 'WAREHOUSE' END AS facility_type,
               n_name AS city, r_name AS state, s_acctbal AS latitude,
               CAST(s_nationkey AS DOUBLE) AS longitude, '00-24' AS operating_hours
        FROM supplier JOIN nations ON s_nationkey = n_nationkey""",
    "drivers": """
        SELECT s_suppkey AS driver_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name, CAST(NULL AS DATE) AS hire_date,
               CAST(NULL AS DATE) AS termination_date,
               CASE WHEN s_acctbal < 0 THEN 'ON_LEAVE' ELSE 'ACTIVE' END AS employment_status,
               s_nationkey AS years_experience
        FROM supplier""",
    "trucks": """
        SELECT p_partkey AS truck_id, p_name AS unit_number, p_brand AS make,
               p_size AS model_year, CAST(NULL AS DATE) AS acquisition_date,
               p_partkey * 10 AS acquisition_mileage, p_type AS fuel_type,
               p_retailprice AS tank_capacity_gallons,
               CASE WHEN p_size > 45 THEN 'RETIRED' ELSE 'ACTIVE' END AS status
        FROM part""",
    "loads": """
        SELECT o_orderkey AS load_id, o_custkey AS customer_id, o_orderkey % 25 AS route_id,
               CAST(o_orderdate AS DATE) AS load_date, o_orderpriority AS load_type,
               o_totalprice - 5000 AS weight_lbs, CAST(o_orderkey % 50 AS INTEGER) AS pieces,
               o_totalprice AS revenue,
               CASE o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'COMPLETED'
                    ELSE 'IN_TRANSIT' END AS load_status,
               o_orderstatus AS booking_type
        FROM orders""",
    "trips": """
        SELECT l_orderkey * 8 + l_linenumber AS trip_id, l_orderkey AS load_id,
               l_suppkey AS driver_id, l_partkey AS truck_id,
               CAST(l_shipdate AS DATE) AS dispatch_date,
               l_extendedprice AS actual_distance_miles, l_tax AS actual_duration_hours,
               l_quantity AS fuel_gallons_used, l_discount AS idle_time_hours,
               l_linestatus AS trip_status
        FROM lineitem""",
    "delivery_events": """
        SELECT l_orderkey * 8 + l_linenumber AS event_id, l_orderkey AS load_id,
               l_orderkey * 8 + l_linenumber AS trip_id, l_returnflag AS event_type,
               l_suppkey AS facility_id, o_orderdate AS scheduled_datetime,
               l_shipdate AS actual_datetime, CAST(l_quantity AS INTEGER) AS detention_minutes,
               l_returnflag = 'N' AS on_time_flag, l_linestatus AS location_city,
               l_returnflag AS location_state
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scans": """
        SELECT event_id, user_id, ts AS actual_datetime, event_type <> 'error' AS on_time_flag,
               value AS detention_minutes
        FROM events""",
    # One row per key.
    "unique_trips": """
        SELECT * FROM trips QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY
            dispatch_date DESC NULLS LAST, actual_distance_miles DESC NULLS LAST,
            actual_duration_hours DESC NULLS LAST, driver_id DESC NULLS LAST,
            fuel_gallons_used DESC NULLS LAST, idle_time_hours DESC NULLS LAST,
            load_id DESC NULLS LAST, trip_status DESC NULLS LAST,
            truck_id DESC NULLS LAST) = 1""",
    "unique_events": """
        SELECT * FROM delivery_events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
            actual_datetime DESC NULLS LAST, scheduled_datetime DESC NULLS LAST,
            detention_minutes DESC NULLS LAST, event_type DESC NULLS LAST,
            facility_id DESC NULLS LAST, load_id DESC NULLS LAST,
            location_city DESC NULLS LAST, location_state DESC NULLS LAST,
            on_time_flag DESC NULLS LAST, trip_id DESC NULLS LAST) = 1""",
    # Classified batches: typed rows with quarantine_reason.
    "classified_customers": """
        SELECT CASE WHEN account_status <> 'SUSPENDED' THEN CAST(customer_id AS VARCHAR) END
                   AS customer_id,
               customer_name, customer_type, account_status, contract_start_date,
               annual_revenue_potential,
               CASE WHEN account_status = 'SUSPENDED' THEN 'missing_primary_key' END
                   AS quarantine_reason
        FROM customers""",
    "classified_facilities": """
        SELECT * REPLACE (CASE WHEN latitude >= -500 THEN CAST(facility_id AS VARCHAR) END
                   AS facility_id),
               CASE WHEN latitude < -500 THEN 'missing_primary_key' END AS quarantine_reason
        FROM facilities""",
    "classified_routes": """
        SELECT * REPLACE (CAST(route_id AS VARCHAR) AS route_id),
               CAST(NULL AS VARCHAR) AS quarantine_reason
        FROM routes""",
    "classified_drivers": """
        SELECT * REPLACE (CASE WHEN employment_status <> 'ON_LEAVE'
                   THEN CAST(driver_id AS VARCHAR) END AS driver_id),
               CASE WHEN employment_status = 'ON_LEAVE' THEN 'missing_primary_key' END
                   AS quarantine_reason
        FROM drivers""",
    "classified_trucks": """
        SELECT * REPLACE (CASE WHEN model_year <> 50 THEN CAST(truck_id AS VARCHAR) END
                   AS truck_id),
               CASE WHEN model_year = 50 THEN 'missing_primary_key' END AS quarantine_reason
        FROM trucks""",
    "ruled_loads": """
        SELECT * REPLACE (CAST(load_id AS VARCHAR) AS load_id,
                   CASE WHEN load_type = '1-URGENT' AND revenue < 50000 THEN NULL
                        ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
                   CAST(route_id AS VARCHAR) AS route_id),
               CASE WHEN weight_lbs IS NULL OR weight_lbs <= 0 OR revenue IS NULL OR revenue < 0
                    THEN 'invalid_business_values' END AS rule
        FROM loads""",
    "classified_loads": """
        SELECT * EXCLUDE (rule) REPLACE (CASE WHEN upper(load_status) = 'CANCELLED' AND rule IS NULL
                   THEN 0.0 ELSE revenue END AS revenue),
               CASE WHEN rule IS NOT NULL THEN rule
                    WHEN NOT EXISTS (SELECT 1 FROM classified_customers p
                         WHERE p.quarantine_reason IS NULL AND p.customer_id = l.customer_id)
                    THEN 'invalid_customer_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM classified_routes p
                         WHERE p.quarantine_reason IS NULL AND p.route_id = l.route_id)
                    THEN 'invalid_route_fk' END AS quarantine_reason
        FROM ruled_loads l""",
    "ruled_trips": """
        SELECT * REPLACE (CASE WHEN fuel_gallons_used <> 1 THEN CAST(trip_id AS VARCHAR) END
                   AS trip_id,
                   CAST(load_id AS VARCHAR) AS load_id, CAST(driver_id AS VARCHAR) AS driver_id,
                   CAST(truck_id AS VARCHAR) AS truck_id),
               CASE WHEN fuel_gallons_used = 1 THEN 'missing_primary_key'
                    WHEN actual_duration_hours IS NULL OR idle_time_hours IS NULL
                      OR actual_duration_hours < 0 OR idle_time_hours < 0
                      OR idle_time_hours > actual_duration_hours
                    THEN 'invalid_duration_metrics' END AS rule
        FROM trips""",
    "latest_trips": """
        SELECT * FROM ruled_trips WHERE rule IS NULL
        QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY
            dispatch_date DESC NULLS LAST, actual_distance_miles DESC NULLS LAST,
            actual_duration_hours DESC NULLS LAST, driver_id DESC NULLS LAST,
            fuel_gallons_used DESC NULLS LAST, idle_time_hours DESC NULLS LAST,
            load_id DESC NULLS LAST, trip_status DESC NULLS LAST,
            truck_id DESC NULLS LAST) = 1""",
    "classified_trips": """
        SELECT * EXCLUDE (rule),
               CASE WHEN NOT EXISTS (SELECT 1 FROM classified_loads p
                         WHERE p.quarantine_reason IS NULL AND p.load_id = t.load_id)
                    THEN 'invalid_load_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM classified_drivers p
                         WHERE p.quarantine_reason IS NULL AND p.driver_id = t.driver_id)
                    THEN 'invalid_driver_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM classified_trucks p
                         WHERE p.quarantine_reason IS NULL AND p.truck_id = t.truck_id)
                    THEN 'invalid_truck_fk' END AS quarantine_reason
        FROM latest_trips t
        UNION ALL
        SELECT * EXCLUDE (rule), rule FROM ruled_trips WHERE rule IS NOT NULL""",
    "ruled_delivery_events": """
        SELECT * REPLACE (CASE WHEN detention_minutes <> 50 THEN CAST(event_id AS VARCHAR) END
                   AS event_id,
                   CAST(load_id AS VARCHAR) AS load_id, CAST(trip_id AS VARCHAR) AS trip_id,
                   CAST(facility_id AS VARCHAR) AS facility_id),
               CASE WHEN detention_minutes = 50 THEN 'missing_primary_key'
                    WHEN scheduled_datetime IS NULL OR actual_datetime IS NULL
                      OR actual_datetime < scheduled_datetime
                    THEN 'invalid_event_timestamps' END AS rule
        FROM delivery_events""",
    "latest_delivery_events": """
        SELECT * FROM ruled_delivery_events WHERE rule IS NULL
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
            actual_datetime DESC NULLS LAST, scheduled_datetime DESC NULLS LAST,
            detention_minutes DESC NULLS LAST, event_type DESC NULLS LAST,
            facility_id DESC NULLS LAST, load_id DESC NULLS LAST,
            location_city DESC NULLS LAST, location_state DESC NULLS LAST,
            on_time_flag DESC NULLS LAST, trip_id DESC NULLS LAST) = 1""",
    "classified_delivery_events": """
        SELECT * EXCLUDE (rule),
               CASE WHEN NOT EXISTS (SELECT 1 FROM classified_loads p
                         WHERE p.quarantine_reason IS NULL AND p.load_id = e.load_id)
                    THEN 'orphan_load_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM classified_trips p
                         WHERE p.quarantine_reason IS NULL AND p.trip_id = e.trip_id)
                    THEN 'orphan_trip_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM classified_facilities p
                         WHERE p.quarantine_reason IS NULL AND p.facility_id = e.facility_id)
                    THEN 'invalid_facility_fk' END AS quarantine_reason
        FROM latest_delivery_events e
        UNION ALL
        SELECT * EXCLUDE (rule), rule FROM ruled_delivery_events WHERE rule IS NOT NULL""",
}

SILVER = (
    "customers",
    "facilities",
    "routes",
    "drivers",
    "trucks",
    "loads",
    "trips",
    "delivery_events",
)
for _name in SILVER:
    ROLES[f"silver_{_name}"] = (
        f"SELECT * EXCLUDE (quarantine_reason) FROM classified_{_name} "
        "WHERE quarantine_reason IS NULL"
    )


def half_up(expression: str) -> str:
    """Round a double to two digits, half away from zero, as Spark does.

    Spark rounds the shortest decimal text of the double; round() in DuckDB scales the
    double first, which differs at near-ties such as 219720.41499999998.
    """
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


def _needs(sql: str) -> list[str]:
    return [r for r in ROLES if re.search(rf"\b{r}\b", sql)]


def with_roles(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the common table expressions it refers to."""
    extra = extra or {}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in _needs(ROLES[name]):
            if needed != name:
                visit(needed)
        order.append(name)

    for text in [*extra.values(), sql]:
        for name in _needs(text):
            visit(name)
    ctes = [f"{n} AS ({ROLES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql
