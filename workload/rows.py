"""Deduplication, validity rules, key checks and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators import dedup, integrity, joins, rules
from lakemart.plans import logistics
from lakemart.plans.spec import conform
from workload.oracle_roles import with_roles
from workload.roles import customers, loads, raw_role, scans, table, trips, typed

LINE_KEY = ["l_orderkey", "l_linenumber"]


def latest_state_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedup.latest_state(lines, LINE_KEY, ["updated_at", "l_shipdate"])


def first_row_dedup(spark, sf_dir):
    return dedup.first_row(table(spark, sf_dir, "lineitem"), LINE_KEY)


def keep_last_dedup(spark, sf_dir):
    """The last event of every user by arrival."""
    return dedup.keep_last(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def distinct_keys(spark, sf_dir):
    """Keys after dropping repeated ones; which row stays is open, so only keys are shown."""
    return dedup.any_row(table(spark, sf_dir, "lineitem").select(LINE_KEY), LINE_KEY)


def invalid_loads(spark, sf_dir):
    return rules.invalid_rows(loads(spark, sf_dir), logistics.INVALID_LOADS)


def valid_loads(spark, sf_dir):
    return rules.valid_rows(loads(spark, sf_dir), logistics.INVALID_LOADS)


def invalid_trips(spark, sf_dir):
    return rules.invalid_rows(trips(spark, sf_dir), logistics.INVALID_TRIPS)


def valid_trips(spark, sf_dir):
    return rules.valid_rows(trips(spark, sf_dir), logistics.INVALID_TRIPS)


def _events(spark, sf_dir):
    return typed(spark, sf_dir, "delivery_events")["delivery_events"]


def invalid_events(spark, sf_dir):
    return rules.invalid_rows(_events(spark, sf_dir), logistics.INVALID_EVENTS)


def valid_events(spark, sf_dir):
    return rules.valid_rows(_events(spark, sf_dir), logistics.INVALID_EVENTS)


def _typed_trips(spark, sf_dir):
    return conform(raw_role(spark, sf_dir, "trips"), logistics.TRIPS)


def missing_key(spark, sf_dir):
    return rules.missing_key(_typed_trips(spark, sf_dir), "trip_id")


def present_key(spark, sf_dir):
    return rules.present_key(_typed_trips(spark, sf_dir), "trip_id")


def _solvent(spark, sf_dir):
    return customers(spark, sf_dir).where("annual_revenue_potential >= 0")


def fk_orphans(spark, sf_dir):
    return integrity.orphans(
        loads(spark, sf_dir), "customer_id", _solvent(spark, sf_dir), "customer_id", unique=True
    )


def fk_valid(spark, sf_dir):
    return integrity.valid_fk(
        loads(spark, sf_dir), "customer_id", _solvent(spark, sf_dir), "customer_id", unique=True
    )


def fk_orphans_repeated_parent(spark, sf_dir):
    """Customers without orders of more than 400,000: the parent repeats its key."""
    big = loads(spark, sf_dir).where("revenue > 400000")
    return integrity.orphans(customers(spark, sf_dir), "customer_id", big, "customer_id")


def fk_chain_reason(spark, sf_dir):
    parents = {
        "loads": loads(spark, sf_dir).where("revenue >= 20000"),
        "drivers": typed(spark, sf_dir, "drivers")["drivers"].where("employment_status = 'ACTIVE'"),
        "trucks": typed(spark, sf_dir, "trucks")["trucks"].where("status = 'ACTIVE'"),
    }
    return integrity.with_fk_reason(
        trips(spark, sf_dir), logistics.TRIPS.foreign_keys, parents, "quarantine_reason"
    ).select("trip_id", "load_id", "driver_id", "truck_id", "quarantine_reason")


def orphan_profile(spark, sf_dir):
    return integrity.orphan_profile(
        loads(spark, sf_dir), "customer_id", _solvent(spark, sf_dir), "customer_id",
        "customers.customer_id -> loads.customer_id",
    )


def preaggregate_join(spark, sf_dir):
    """Orders with their line figures; orders without lines show zeros."""
    lines = table(spark, sf_dir, "lineitem")
    by_order = joins.summarize(
        lines,
        F.col("l_orderkey").alias("o_orderkey"),
        line_count=F.count("*"),
        returned=F.count_if(F.col("l_returnflag") == "R"),
        max_quantity=F.max("l_quantity"),
    )
    zeros = {"line_count": 0, "returned": 0, "max_quantity": 0.0}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.preaggregate_join(orders, by_order, "o_orderkey", zeros)


def fanout_factor(spark, sf_dir):
    lines = trips(spark, sf_dir)
    return joins.fanout_factor(loads(spark, sf_dir), lines, "load_id", "revenue")


def enrich(spark, sf_dir):
    """User events with the customer of that number, when there is one."""
    people = customers(spark, sf_dir).withColumnRenamed("customer_id", "user_id")
    return joins.enrich(scans(spark, sf_dir), people, "user_id", "customer_name")


QUERIES = {
    f.__name__: f
    for f in (
        latest_state_dedup,
        first_row_dedup,
        keep_last_dedup,
        distinct_keys,
        invalid_loads,
        valid_loads,
        invalid_trips,
        valid_trips,
        invalid_events,
        valid_events,
        missing_key,
        present_key,
        fk_orphans,
        fk_valid,
        fk_orphans_repeated_parent,
        fk_chain_reason,
        orphan_profile,
        preaggregate_join,
        fanout_factor,
        enrich,
    )
}

_BAD_LOAD = "(weight_lbs IS NULL OR weight_lbs <= 0 OR revenue IS NULL OR revenue < 0)"
_BAD_TRIP = (
    "(actual_duration_hours IS NULL OR idle_time_hours IS NULL OR actual_duration_hours < 0 "
    "OR idle_time_hours < 0 OR idle_time_hours > actual_duration_hours)"
)
_BAD_EVENT = (
    "(scheduled_datetime IS NULL OR actual_datetime IS NULL "
    "OR actual_datetime < scheduled_datetime)"
)
_TEXT_TRIPS = """SELECT * EXCLUDE (rule) FROM ruled_trips"""
_SOLVENT = "SELECT customer_id FROM customers WHERE annual_revenue_potential >= 0"

ORACLE = {
    "latest_state_dedup": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            l_shipdate DESC NULLS LAST, l_discount DESC NULLS LAST,
            l_extendedprice DESC NULLS LAST, l_linestatus DESC NULLS LAST,
            l_partkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
            l_returnflag DESC NULLS LAST, l_suppkey DESC NULLS LAST,
            l_tax DESC NULLS LAST) = 1""",
    "first_row_dedup": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST, l_quantity ASC NULLS LAST,
            l_extendedprice ASC NULLS LAST, l_discount ASC NULLS LAST, l_tax ASC NULLS LAST,
            l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS LAST,
            l_shipdate ASC NULLS LAST) = 1""",
    "keep_last_dedup": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "invalid_loads": with_roles(f"SELECT * FROM loads WHERE {_BAD_LOAD}"),
    "valid_loads": with_roles(f"SELECT * FROM loads WHERE NOT {_BAD_LOAD}"),
    "invalid_trips": with_roles(f"SELECT * FROM trips WHERE {_BAD_TRIP}"),
    "valid_trips": with_roles(f"SELECT * FROM trips WHERE NOT {_BAD_TRIP}"),
    "invalid_events": with_roles(f"SELECT * FROM delivery_events WHERE {_BAD_EVENT}"),
    "valid_events": with_roles(f"SELECT * FROM delivery_events WHERE NOT {_BAD_EVENT}"),
    "missing_key": with_roles(f"{_TEXT_TRIPS} WHERE trip_id IS NULL"),
    "present_key": with_roles(f"{_TEXT_TRIPS} WHERE trip_id IS NOT NULL"),
    "fk_orphans": with_roles(
        f"SELECT * FROM loads l WHERE NOT EXISTS (SELECT 1 FROM ({_SOLVENT}) p "
        "WHERE p.customer_id = l.customer_id)"
    ),
    "fk_valid": with_roles(
        f"SELECT * FROM loads l WHERE EXISTS (SELECT 1 FROM ({_SOLVENT}) p "
        "WHERE p.customer_id = l.customer_id)"
    ),
    "fk_orphans_repeated_parent": with_roles(
        "SELECT * FROM customers c WHERE NOT EXISTS (SELECT 1 FROM loads l "
        "WHERE revenue > 400000 AND l.customer_id = c.customer_id)"
    ),
    "fk_chain_reason": with_roles(
        """SELECT trip_id, load_id, driver_id, truck_id,
               CASE WHEN NOT EXISTS (SELECT 1 FROM loads p
                         WHERE revenue >= 20000 AND p.load_id = t.load_id) THEN 'invalid_load_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM drivers p WHERE employment_status = 'ACTIVE'
                         AND p.driver_id = t.driver_id) THEN 'invalid_driver_fk'
                    WHEN NOT EXISTS (SELECT 1 FROM trucks p WHERE status = 'ACTIVE'
                         AND p.truck_id = t.truck_id) THEN 'invalid_truck_fk'
               END AS quarantine_reason
        FROM trips t"""
    ),
    "orphan_profile": with_roles(
        f"""SELECT 'customers.customer_id -> loads.customer_id' AS relationship,
               count(DISTINCT customer_id) FILTER (WHERE customer_id NOT IN ({_SOLVENT}))
                   AS orphan_values,
               count(customer_id) AS non_null_rows,
               CASE WHEN count(*) FILTER (WHERE customer_id NOT IN ({_SOLVENT})) = 0
                    THEN 'PASS' ELSE 'WARNING' END AS status
        FROM loads"""
    ),
    "preaggregate_join": """
        SELECT o_orderkey, o_custkey, o_totalprice, coalesce(n, 0) AS line_count,
               coalesce(r, 0) AS returned, coalesce(q, 0.0) AS max_quantity
        FROM orders LEFT JOIN (
            SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r,
                   max(l_quantity) AS q
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "fanout_factor": """
        WITH parents AS (
            SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS t
            FROM orders),
        joined AS (
            SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS t
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
        SELECT p.n AS parent_rows, j.n AS joined_rows, p.t AS true_total, j.t AS joined_total,
               round(j.t / p.t, 4) AS inflation_factor
        FROM parents p, joined j""",
    "enrich": with_roles(
        """SELECT s.*, c.customer_name FROM scans s
        LEFT JOIN customers c ON s.user_id = c.customer_id"""
    ),
}
