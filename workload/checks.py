"""Gates, control totals, reports and profiles."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemart.operators import profiles, quality
from lakemart.operators.batches import union_batches
from lakemart.operators.quarantine import QUARANTINED_AT, REASON
from lakemart.operators.rules import violation_counts
from lakemart.plans import gold, marts, silver
from lakemart.plans.gold import run_gold, validate_gold
from lakemart.plans.logistics import STRICT_CHECKS
from lakemart.plans.run import published_gate, silver_gate
from lakemart.session import work_path
from lakemart.sinks.quarantine import read_quarantine
from lakemart.sources.tables import read_gold, read_silver
from workload.marts import (
    CUSTOMER,
    DELIVERY,
    DRIVER,
    FACILITY,
    LOAD,
    ROUTE,
    TRUCK,
    daily_sql,
)
from workload.oracle_roles import SILVER, with_roles
from workload.roles import customers, loads, raw, scans, table, typed

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


def _all(spark, sf_dir):
    return {n: table(spark, sf_dir, n) for n in TABLES}


def _marts(spark, sf_dir):
    roles = typed(spark, sf_dir)
    return {
        "gold_load_performance": (marts.load_performance(roles), "load_id"),
        "gold_customer_performance": (marts.customer_performance(roles), "customer_id"),
        "gold_facility_performance": (marts.facility_performance(roles), "facility_id"),
        "gold_daily_operations": (
            marts.daily_operations({"delivery_events": scans(spark, sf_dir)}),
            "event_date",
        ),
    }


def grain_check(spark, sf_dir):
    """Marts keep their grain; the line table has no such key and fails."""
    lines = {"lineitem": (typed(spark, sf_dir, "trips")["trips"], "trip_id")}
    return quality.grain_check({**_marts(spark, sf_dir), **lines})


def key_assertions(spark, sf_dir):
    """Text identifiers after cleaning: blanks and repeats are counted."""
    arrived = raw(spark, sf_dir, "customers", "loads", "trips")
    keyed = {
        n: (df.withColumn(k, F.nullif(F.trim(k), F.lit(""))), k)
        for (n, df), k in zip(arrived.items(), ("customer_id", "load_id", "trip_id"))
    }
    return quality.key_assertions(keyed)


def quality_report(spark, sf_dir):
    """Report over marts, customers with negative balances and repeated trip keys."""
    others = {
        "customers": (customers(spark, sf_dir), "customer_id"),
        "trips": (typed(spark, sf_dir, "trips")["trips"], "trip_id"),
    }
    return quality.quality_report({**_marts(spark, sf_dir), **others})


def control_totals(spark, sf_dir):
    """Revenue of the loads against the load and customer marts."""
    roles = typed(spark, sf_dir)
    return gold.reconcile(
        roles["loads"], marts.load_performance(roles), marts.customer_performance(roles)
    )


def control_totals_broken(spark, sf_dir):
    """The same against a mart inflated by a direct join to the lines."""
    roles = typed(spark, sf_dir)
    inflated = roles["loads"].join(roles["trips"].select("load_id"), "load_id", "left")
    return gold.reconcile(roles["loads"], inflated, marts.customer_performance(roles))


def batch_gate(spark, sf_dir):
    """Customers with a negative balance fail the batch, orders pass."""
    people = quality.batch_gate(table(spark, sf_dir, "customer"), "c_acctbal")
    orders = quality.batch_gate(loads(spark, sf_dir), "revenue")
    return union_batches(
        people.withColumn("batch", F.lit("customer")), orders.withColumn("batch", F.lit("orders"))
    )


def rule_violations(spark, sf_dir):
    """Strict business checks: zeros count as violations."""
    roles = typed(spark, sf_dir, *STRICT_CHECKS)
    return union_batches(
        *[violation_counts(roles[n], n, checks) for n, checks in STRICT_CHECKS.items()]
    )


def row_count_check(spark, sf_dir):
    """Sizes against an expectation taken from the key range of each table."""
    found = _all(spark, sf_dir)
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    expected = union_batches(
        *[
            found[n].agg((F.max(k) + 1).alias("expected_rows")).withColumn("table_name", F.lit(n))
            for n, k in keys.items()
        ]
    )
    return profiles.row_count_check({n: found[n] for n in keys}, expected)


KEY_RANGES = {
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
}


def row_count_check_all(spark, sf_dir):
    """The same for every table."""
    found = _all(spark, sf_dir)
    expected = union_batches(
        *[
            found[n].agg((F.max(k) + 1).alias("expected_rows")).withColumn("table_name", F.lit(n))
            for n, k in KEY_RANGES.items()
        ]
    )
    return profiles.row_count_check(found, expected)


def row_counts(spark, sf_dir):
    return profiles.row_counts(_all(spark, sf_dir))


def duplicate_profile(spark, sf_dir):
    """Whole-row repeats; two columns of the lines repeat often."""
    found = _all(spark, sf_dir)
    found["line_flags"] = found["lineitem"].select("l_orderkey", "l_returnflag", "l_linestatus")
    return profiles.duplicate_profile(found)


def frequency_profile(spark, sf_dir):
    """Customer and route pairs of the loads."""
    return profiles.frequency_profile(loads(spark, sf_dir), "customer_id", "route_id")


def frequency_profile_single(spark, sf_dir):
    return profiles.frequency_profile(typed(spark, sf_dir, "trips")["trips"], "driver_id")


def medallion_run(spark, sf_dir):
    """Silver job, gate, Gold job with its checks, and the report of the published marts."""
    lake = work_path(spark, "lake")
    silver.run_silver(spark, lake, raw(spark, sf_dir))
    silver_gate(spark, lake)
    run_gold(spark, lake)
    published_gate(spark, lake)
    return validate_gold(spark, lake)


def _dearer(tables):
    """The next delivery: of every fiftieth customer's loads, finished ones cost 100 more."""
    wanted = (F.col("load_status") == "COMPLETED") & (F.col("customer_id").try_cast("long") % 50 == 0)
    revenue = F.when(wanted, (F.col("revenue").cast("double") + 100).cast("string")).otherwise(F.col("revenue"))
    return {**tables, "loads": tables["loads"].withColumn("revenue", revenue)}


def delivery_mart_dealt(spark, sf_dir):
    """The widest mart from Silver facts that are dealt by the keys they are joined by."""
    lake = work_path(spark, "lake")
    dealt = {"loads": ("load_id", 8), "trips": ("trip_id", 8), "delivery_events": ("load_id", 8)}
    silver.run_silver(spark, lake, raw(spark, sf_dir), dealt=dealt)
    return marts.delivery_performance({n: read_silver(spark, lake, n) for n in silver.SPECS})


def grain_check_all(spark, sf_dir):
    """All eight published marts and all eight Silver tables keep their grain."""
    lake = work_path(spark, "lake")
    silver.run_silver(spark, lake, raw(spark, sf_dir))
    run_gold(spark, lake)
    published = {n: (read_gold(spark, lake, n), m.key) for n, m in marts.MARTS.items()}
    tables = {n: (read_silver(spark, lake, n), s.key) for n, s in silver.SPECS.items()}
    return quality.grain_check({**published, **tables})


def key_assertions_all(spark, sf_dir):
    """Missing and repeated keys of all eight tables as they arrive."""
    arrived = typed(spark, sf_dir)
    return quality.key_assertions({n: (arrived[n], s.key) for n, s in silver.SPECS.items()})


def conservation_all(spark, sf_dir):
    """Every arrived row of all eight tables is in Silver, in quarantine or superseded."""
    lake = work_path(spark, "lake")
    arrived = raw(spark, sf_dir)
    silver.run_silver(spark, lake, arrived)
    rejects = read_quarantine(spark, f"{lake}/quarantine", silver.SPECS)
    reports = []
    for name in silver.SPECS:
        rows = read_silver(spark, lake, name).withColumn(REASON, F.lit(None).cast("string"))
        if name in rejects:
            rows = rows.unionByName(rejects[name].drop(QUARANTINED_AT))
        reports.append(silver.conservation(arrived[name], rows, name))
    return union_batches(*reports)


def gold_update(spark, sf_dir):
    """The customer mart after a second delivery; Gold is brought up to date by key."""
    lake = work_path(spark, "lake")
    delivered = raw(spark, sf_dir)
    for tables in (delivered, _dearer(delivered)):
        silver.run_silver(spark, lake, tables)
        run_gold(spark, lake, "upsert", buckets=8)
    return read_gold(spark, lake, "gold_customer_performance").drop("last_ingested_at")


def silver_all_or_none(spark, sf_dir):
    """Rows of all Silver tables after a second run that failed in its last table."""
    lake = work_path(spark, "lake")
    delivered = raw(spark, sf_dir)
    silver.run_silver(spark, lake, delivered)
    broken = delivered["delivery_events"].withColumn("event_type", F.raise_error(F.lit("unreadable")).cast("string"))
    try:
        silver.run_silver(spark, lake, {**_dearer(delivered), "delivery_events": broken})
    except PySparkException as error:
        if "unreadable" not in str(error):
            raise
    rows = {n: read_silver(spark, lake, n) for n in silver.SPECS}
    revenue = rows["loads"].agg(F.round(F.sum(F.col("revenue").cast("decimal(28,2)")), 2).cast("double")).scalar()
    return profiles.row_counts(rows).withColumn("revenue", revenue)


QUERIES = {
    f.__name__: f
    for f in (
        gold_update,
        silver_all_or_none,
        delivery_mart_dealt,
        grain_check_all,
        key_assertions_all,
        conservation_all,
        grain_check,
        key_assertions,
        quality_report,
        control_totals,
        control_totals_broken,
        batch_gate,
        rule_violations,
        row_count_check,
        row_count_check_all,
        row_counts,
        duplicate_profile,
        frequency_profile,
        frequency_profile_single,
        medallion_run,
    )
}

_MARTS = {
    "gold_load_performance": (LOAD, "load_id"),
    "gold_customer_performance": (CUSTOMER, "customer_id"),
    "gold_facility_performance": (FACILITY, "facility_id"),
    "gold_daily_operations": (daily_sql("scans"), "event_date"),
}


def _grain(name: str, sql: str, key: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, count(*) AS row_count,
               count(DISTINCT {key}) AS distinct_keys,
               CASE WHEN count(*) > 0 AND count(*) = count(DISTINCT {key})
                    THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({sql})"""


def _report(name: str, sql: str, key: str, columns: int, numeric: list[str]) -> str:
    negative = " + ".join(f"coalesce(sum(CAST({c} < 0 AS INTEGER)), 0)" for c in numeric)
    return f"""
        SELECT '{name}' AS table_name, row_count, {columns} AS column_count,
               '{key}' AS primary_key, null_primary_keys, duplicate_primary_keys,
               negative_numeric_values,
               CASE WHEN row_count = 0 OR null_primary_keys > 0 OR duplicate_primary_keys > 0
                    THEN 'FAIL' WHEN negative_numeric_values > 0 THEN 'WARNING' ELSE 'PASS' END
                   AS validation_status
        FROM (SELECT count(*) AS row_count,
                     count(*) FILTER (WHERE {key} IS NULL) AS null_primary_keys,
                     (SELECT count(*) FROM (SELECT {key} FROM ({sql}) GROUP BY {key}
                                            HAVING count(*) > 1)) AS duplicate_primary_keys,
                     CAST({negative} AS BIGINT) AS negative_numeric_values
              FROM ({sql}))"""


# Numeric columns whose negatives the report counts, and the number of columns.
_REPORTED = {
    "gold_load_performance": (
        20,
        "load_id customer_id route_id weight_lbs pieces revenue total_delivery_events "
        "on_time_events total_detention_minutes",
    ),
    "gold_customer_performance": (
        9,
        "customer_id total_loads total_revenue avg_revenue_per_load avg_load_weight_lbs "
        "total_pieces",
    ),
    "gold_facility_performance": (
        8,
        "facility_id total_events on_time_events on_time_rate avg_detention_minutes",
    ),
    "gold_daily_operations": (
        5,
        "total_events on_time_events on_time_rate avg_detention_minutes",
    ),
    "customers": (6, "customer_id annual_revenue_potential"),
    "trips": (
        10,
        "trip_id load_id driver_id truck_id actual_distance_miles actual_duration_hours "
        "fuel_gallons_used idle_time_hours",
    ),
}
_REPORT_SQL = {
    **_MARTS,
    "customers": ("SELECT * FROM customers", "customer_id"),
    "trips": ("SELECT * FROM trips", "trip_id"),
}



def _on_silver(sql: str) -> str:
    """Mart SQL over the accepted Silver rows instead of the typed roles."""
    sql = sql.replace("unique_events", "delivery_events").replace("unique_trips", "trips")
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(SILVER)})\b", r"\1 silver_\2", sql)


# Marts of the full run: SQL, key, columns with last_ingested_at, numeric columns.
_PUBLISHED = {
    "gold_load_performance": (
        LOAD, "load_id", 21,
        "weight_lbs pieces revenue total_delivery_events on_time_events total_detention_minutes",
    ),
    "gold_delivery_performance": (DELIVERY, "event_id", 19, "detention_minutes revenue"),
    "gold_driver_performance": (
        DRIVER, "driver_id", 14,
        "years_experience total_trips total_distance_miles avg_distance_miles "
        "avg_duration_hours total_fuel_gallons avg_fuel_gallons "
        "fuel_efficiency_miles_per_gallon total_idle_time_hours avg_idle_time_hours",
    ),
    "gold_truck_performance": (
        TRUCK, "truck_id", 16,
        "model_year tank_capacity_gallons total_trips total_distance_miles avg_distance_miles "
        "total_fuel_gallons avg_fuel_per_trip_gallons fuel_efficiency_miles_per_gallon "
        "total_idle_time_hours avg_idle_time_hours",
    ),
    "gold_facility_performance": (
        FACILITY, "facility_id", 9,
        "total_events on_time_events on_time_rate avg_detention_minutes",
    ),
    "gold_route_performance": (
        ROUTE, "route_id", 13,
        "typical_distance_miles typical_transit_days total_trips avg_trip_duration_hours "
        "avg_actual_distance_miles avg_fuel_consumed_gallons fuel_efficiency_miles_per_gallon",
    ),
    "gold_customer_performance": (
        CUSTOMER, "customer_id", 10,
        "total_loads total_revenue avg_revenue_per_load avg_load_weight_lbs total_pieces",
    ),
    "gold_daily_operations": (
        daily_sql("delivery_events"), "event_date", 6,
        "total_events on_time_events on_time_rate avg_detention_minutes",
    ),
}

_TOTAL = "CAST(sum(CAST({} AS DECIMAL(18, 2))) AS DOUBLE)"

ORACLE = {
    "grain_check": with_roles(
        " UNION ALL ".join(
            _grain(n, sql, key)
            for n, (sql, key) in {
                **_MARTS,
                "lineitem": ("SELECT trip_id FROM trips", "trip_id"),
            }.items()
        )
    ),
    "key_assertions": with_roles(
        " UNION ALL ".join(
            f"""
        SELECT '{n}' AS table_name, count(*) FILTER (WHERE {k} IS NULL) AS null_keys,
               (SELECT count(*) FROM (SELECT {k} FROM {rel} GROUP BY {k} HAVING count(*) > 1))
                   AS duplicate_keys,
               CASE WHEN count(*) = count(DISTINCT {k}) THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {rel}"""
            for n, k, rel in (
                ("customers", "customer_id", "classified_customers"),
                ("loads", "load_id", "ruled_loads"),
                ("trips", "trip_id", "ruled_trips"),
            )
        )
    ),
    "quality_report": with_roles(
        " UNION ALL ".join(
            _report(n, sql, key, _REPORTED[n][0], _REPORTED[n][1].split())
            for n, (sql, key) in _REPORT_SQL.items()
        )
    ),
    "control_totals": f"""
        SELECT {_TOTAL.format("o_totalprice")} AS silver_total,
               {_TOTAL.format("o_totalprice")} AS load_mart_total,
               {_TOTAL.format("o_totalprice")} AS customer_mart_total, 'PASS' AS status
        FROM orders""",
    "control_totals_broken": f"""
        SELECT (SELECT {_TOTAL.format("o_totalprice")} FROM orders) AS silver_total,
               {_TOTAL.format("o_totalprice")} AS load_mart_total,
               (SELECT {_TOTAL.format("o_totalprice")} FROM orders) AS customer_mart_total,
               'FAIL' AS status
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "batch_gate": """
        SELECT 'customer' AS batch, count(*) AS row_count,
               count(*) FILTER (WHERE c_acctbal < 0) AS negative_rows,
               CASE WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'FAIL' ELSE 'PASS' END
                   AS status
        FROM customer
        UNION ALL
        SELECT 'orders', count(*), count(*) FILTER (WHERE o_totalprice < 0),
               CASE WHEN count(*) FILTER (WHERE o_totalprice < 0) > 0 THEN 'FAIL' ELSE 'PASS' END
        FROM orders""",
    "rule_violations": with_roles(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, '{rule}' AS rule, "
            f"count(*) FILTER (WHERE {check}) AS violations FROM {n}"
            for n, checks in STRICT_CHECKS.items()
            for rule, check in checks.items()
        )
    ),
    "row_count_check": " UNION ALL ".join(
        f"""
        SELECT '{n}' AS table_name, count(*) AS row_count, max({k}) + 1 AS expected_rows,
               CASE WHEN count(*) = max({k}) + 1 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {n}"""
        for n, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"))
    ),
    "row_count_check_all": " UNION ALL ".join(
        f"""
        SELECT '{n}' AS table_name, count(*) AS row_count, max({k}) + 1 AS expected_rows,
               CASE WHEN count(*) = max({k}) + 1 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {n}"""
        for n, k in KEY_RANGES.items()
    ),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES
    ),
    "duplicate_profile": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {rel}) AS row_count, "
        f"(SELECT count(*) FROM {rel}) - count(*) AS duplicate_rows "
        f"FROM (SELECT DISTINCT * FROM {rel})"
        for n, rel in [(t, t) for t in TABLES]
        + [("line_flags", "(SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem)")]
    ),
    "frequency_profile": with_roles(
        """SELECT customer_id, route_id, count(*) AS frequency,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM loads) AS relative_frequency
        FROM loads GROUP BY 1, 2"""
    ),
    "frequency_profile_single": with_roles(
        """SELECT driver_id, count(*) AS frequency,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM trips) AS relative_frequency
        FROM trips GROUP BY 1"""
    ),
    "delivery_mart_dealt": with_roles(_on_silver(DELIVERY)),
    "grain_check_all": with_roles(
        " UNION ALL ".join(
            [_grain(n, _on_silver(sql), key) for n, (sql, key, *_) in _PUBLISHED.items()]
            + [_grain(n, f"SELECT * FROM silver_{n}", s.key) for n, s in silver.SPECS.items()]
        )
    ),
    "key_assertions_all": with_roles(
        " UNION ALL ".join(
            f"""
        SELECT '{n}' AS table_name, count(*) FILTER (WHERE {s.key} IS NULL) AS null_keys,
               (SELECT count(*) FROM (SELECT {s.key} FROM {n} GROUP BY {s.key} HAVING count(*) > 1))
                   AS duplicate_keys,
               CASE WHEN count(*) = count(DISTINCT {s.key}) THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {n}"""
            for n, s in silver.SPECS.items()
        )
    ),
    "conservation_all": with_roles(
        " UNION ALL ".join(
            f"""
        SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS bronze_rows,
               count(*) FILTER (WHERE quarantine_reason IS NULL) AS silver_rows,
               count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS quarantined_rows,
               (SELECT count(*) FROM {n}) - count(*) AS superseded_rows
        FROM classified_{n}"""
            for n in SILVER
        )
    ),
    "gold_update": with_roles(
        _on_silver(CUSTOMER).replace("silver_loads", "dearer_loads"),
        {
            "dearer_loads": "SELECT * REPLACE (CASE WHEN load_status = 'COMPLETED' AND CAST(customer_id AS BIGINT) % 50 = 0 "
            "THEN revenue + 100 ELSE revenue END AS revenue) FROM silver_loads"
        },
    ),
    "silver_all_or_none": with_roles(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS row_count, (SELECT CAST(sum(CAST(revenue AS "
            f"DECIMAL(18, 2))) AS DOUBLE) FROM silver_loads) AS revenue FROM silver_{n}"
            for n in SILVER
        )
    ),
    "medallion_run": with_roles(
        " UNION ALL ".join(
            _report(n, _on_silver(sql), key, columns, numeric.split())
            for n, (sql, key, columns, numeric) in _PUBLISHED.items()
        )
    ),
}
