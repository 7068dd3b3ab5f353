"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import columns as c
from workload.oracle_roles import half_up, with_roles
from workload.roles import raw_role, table, trips, typed

TIMES = ("scheduled_datetime", "actual_datetime")


def clean_id(spark, sf_dir):
    return raw_role(spark, sf_dir, "loads").select(
        c.clean_id("load_id").alias("load_id"), c.clean_id("customer_id").alias("customer_id")
    )


def safe_cast(spark, sf_dir):
    """Text that does not always fit its target type."""
    text = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CAST(l_quantity AS STRING) AS whole_text",
        "CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS STRING) ELSE 'n/a' END "
        "AS real_text",
        "CASE WHEN l_returnflag = 'N' THEN 'yesterday' ELSE CAST(l_shipdate AS STRING) END "
        "AS time_text",
        "CASE l_returnflag WHEN 'N' THEN 'true' WHEN 'R' THEN 'false' ELSE 'maybe' END "
        "AS flag_text",
    )
    return text.select(
        "l_orderkey",
        "l_linenumber",
        c.safe_cast("whole_text", "int").alias("as_int"),
        c.safe_cast("whole_text", "bigint").alias("as_bigint"),
        c.safe_cast("real_text", "double").alias("as_double"),
        c.safe_cast("time_text", "date").alias("as_date"),
        c.safe_cast("time_text", "timestamp").alias("as_timestamp"),
        c.safe_cast("flag_text", "boolean").alias("as_boolean"),
    )


def name_concat(spark, sf_dir):
    people = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "split_part(c_name, '#', 1) AS first_name",
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS last_name",
    )
    return people.select("c_custkey", c.full_name("first_name", "last_name").alias("full_name"))


def ratios(spark, sf_dir):
    """Guarded and unguarded ratios; idle time is often zero."""
    return trips(spark, sf_dir).select(
        "trip_id",
        c.ratio("actual_distance_miles", "fuel_gallons_used").alias("unguarded"),
        c.ratio("fuel_gallons_used", "idle_time_hours").alias("null_on_zero"),
        c.guarded_ratio("fuel_gallons_used", "idle_time_hours").alias("zero_on_zero"),
    )


def pct_rate(spark, sf_dir):
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("total_events"),
        F.count_if(F.col("event_type") != "error").alias("on_time_events"),
    )
    rate = c.pct("on_time_events", "total_events")
    return counted.withColumn("on_time_rate", rate)


def cancel_restatement(spark, sf_dir):
    loads = typed(spark, sf_dir, "loads")["loads"]
    return loads.select(
        "load_id", "load_status", c.restate_cancelled("revenue", "load_status").alias("revenue")
    )


def clamp_repair(spark, sf_dir):
    """Idle time within [0, duration], then floors for the measures."""
    return (
        trips(spark, sf_dir)
        .withColumn("idle_time_hours", c.clamp("idle_time_hours", 0.0, "actual_duration_hours"))
        .select(
            "trip_id",
            "load_id",
            "truck_id",
            "idle_time_hours",
            c.floor_at("actual_duration_hours", 0.01).alias("actual_duration_hours"),
            c.floor_at("actual_distance_miles", 0.01).alias("actual_distance_miles"),
            c.floor_at("fuel_gallons_used", 0.01).alias("fuel_gallons_used"),
        )
    )


def time_order_repair(spark, sf_dir):
    events = typed(spark, sf_dir, "delivery_events")["delivery_events"]
    repaired = events.withColumn("actual_datetime", c.ordered_actual(*TIMES))
    return repaired.withColumn("on_time_flag", c.on_time(*TIMES)).select(
        "event_id", *TIMES, "on_time_flag"
    )


def event_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", c.event_date("ts").alias("event_date")
    )


QUERIES = {
    "clean_id": clean_id,
    "safe_cast": safe_cast,
    "name_concat": name_concat,
    "ratios": ratios,
    "pct_rate": pct_rate,
    "cancel_restatement": cancel_restatement,
    "clamp_repair": clamp_repair,
    "time_order_repair": time_order_repair,
    "event_dates": event_dates,
}


_RATE = "CAST(count(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) / count(*) * 100"

ORACLE = {
    "clean_id": with_roles(
        """SELECT CAST(load_id AS VARCHAR) AS load_id,
               CASE WHEN load_type = '1-URGENT' AND revenue < 50000 THEN NULL
                    ELSE CAST(customer_id AS VARCHAR) END AS customer_id
        FROM loads"""
    ),
    "safe_cast": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS as_int,
               CAST(l_quantity AS BIGINT) AS as_bigint,
               CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS as_double,
               CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS as_date,
               CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS as_timestamp,
               CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS as_boolean
        FROM lineitem""",
    "name_concat": """
        SELECT c_custkey,
               concat_ws(' ', split_part(c_name, '#', 1),
                         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) AS full_name
        FROM customer""",
    "ratios": with_roles(
        f"""SELECT trip_id,
               {half_up("actual_distance_miles / fuel_gallons_used")} AS unguarded,
               CASE WHEN idle_time_hours <> 0
                    THEN {half_up("fuel_gallons_used / idle_time_hours")} END AS null_on_zero,
               CASE WHEN idle_time_hours > 0
                    THEN {half_up("fuel_gallons_used / idle_time_hours")} ELSE 0.0 END
                    AS zero_on_zero
        FROM trips"""
    ),
    "pct_rate": f"""
        SELECT user_id, count(*) AS total_events,
               count(*) FILTER (WHERE event_type <> 'error') AS on_time_events,
               {half_up(_RATE)} AS on_time_rate
        FROM events GROUP BY user_id""",
    "cancel_restatement": with_roles(
        """SELECT load_id, load_status,
               CASE WHEN upper(load_status) = 'CANCELLED' THEN 0.0 ELSE revenue END AS revenue
        FROM loads"""
    ),
    "clamp_repair": with_roles(
        """SELECT trip_id, load_id, truck_id,
               greatest(least(idle_time_hours, actual_duration_hours), 0.0) AS idle_time_hours,
               greatest(actual_duration_hours, 0.01) AS actual_duration_hours,
               greatest(actual_distance_miles, 0.01) AS actual_distance_miles,
               greatest(fuel_gallons_used, 0.01) AS fuel_gallons_used
        FROM trips"""
    ),
    "time_order_repair": with_roles(
        """SELECT event_id, scheduled_datetime,
               greatest(scheduled_datetime, actual_datetime) AS actual_datetime,
               actual_datetime <= scheduled_datetime AS on_time_flag
        FROM delivery_events"""
    ),
    "event_dates": "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events",
}
