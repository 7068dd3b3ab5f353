"""The provided tables in the roles of the logistics model.

orders play loads, lineitem plays trips and (with orders) delivery events, supplier plays
drivers and facilities, part plays trucks, nation and region play routes. ``typed``
gives Silver-like frames, ``raw`` the same as text with padded and blank
identifiers, the way a batch arrives. All are lazy projections of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import latest_state
from lakemart.plans.logistics import SPECS
from lakemart.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_name",
        "c_mktsegment AS customer_type",
        "CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS account_status",
        "CAST(NULL AS DATE) AS contract_start_date",
        "c_acctbal AS annual_revenue_potential",
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nations(spark, sf_dir).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS route_id",
        "n_name AS origin_city",
        "r_name AS origin_state",
        "n_name AS destination_city",
        "r_name AS destination_state",
        "CAST(n_nationkey * 100 AS DOUBLE) AS typical_distance_miles",
        "2.5D AS base_rate_per_mile",
        "0.25D AS fuel_surcharge_rate",
        "CAST(n_regionkey + 1 AS DOUBLE) AS typical_transit_days",
    )


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "s_suppkey AS facility_id",
        "s_name AS facility_name",
        "CASE WHEN s_acctbal < 0 THEN 'CROSSDOCK' ELSE 'WAREHOUSE' END AS facility_type",
        "n_name AS city",
        "r_name AS state",
        "s_acctbal AS latitude",
        "CAST(s_nationkey AS DOUBLE) AS longitude",
        "'00-24' AS operating_hours",
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS driver_id",
        "split_part(s_name, '#', 1) AS first_name",
        "split_part(s_name, '#', 2) AS last_name",
        "CAST(NULL AS DATE) AS hire_date",
        "CAST(NULL AS DATE) AS termination_date",
        "CASE WHEN s_acctbal < 0 THEN 'ON_LEAVE' ELSE 'ACTIVE' END AS employment_status",
        "s_nationkey AS years_experience",
    )


def trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS truck_id",
        "p_name AS unit_number",
        "p_brand AS make",
        "p_size AS model_year",
        "CAST(NULL AS DATE) AS acquisition_date",
        "p_partkey * 10 AS acquisition_mileage",
        "p_type AS fuel_type",
        "p_retailprice AS tank_capacity_gallons",
        "CASE WHEN p_size > 45 THEN 'RETIRED' ELSE 'ACTIVE' END AS status",
    )


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS load_id",
        "o_custkey AS customer_id",
        "o_orderkey % 25 AS route_id",
        "CAST(o_orderdate AS DATE) AS load_date",
        "o_orderpriority AS load_type",
        "o_totalprice - 5000 AS weight_lbs",
        "CAST(o_orderkey % 50 AS INT) AS pieces",
        "o_totalprice AS revenue",
        "CASE o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'COMPLETED' "
        "ELSE 'IN_TRANSIT' END AS load_status",
        "o_orderstatus AS booking_type",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS trip_id",
        "l_orderkey AS load_id",
        "l_suppkey AS driver_id",
        "l_partkey AS truck_id",
        "CAST(l_shipdate AS DATE) AS dispatch_date",
        "l_extendedprice AS actual_distance_miles",
        "l_tax AS actual_duration_hours",
        "l_quantity AS fuel_gallons_used",
        "l_discount AS idle_time_hours",
        "l_linestatus AS trip_status",
    )


def delivery_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey * 8 + l_linenumber AS event_id",
        "l_orderkey AS load_id",
        "l_orderkey * 8 + l_linenumber AS trip_id",
        "l_returnflag AS event_type",
        "l_suppkey AS facility_id",
        "o_orderdate AS scheduled_datetime",
        "l_shipdate AS actual_datetime",
        "CAST(l_quantity AS INT) AS detention_minutes",
        "l_returnflag = 'N' AS on_time_flag",
        "l_linestatus AS location_city",
        "l_returnflag AS location_state",
    )


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as delivery events, for the daily grain."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "ts AS actual_datetime",
        "event_type <> 'error' AS on_time_flag",
        "value AS detention_minutes",
    )


TYPED = {
    "customers": customers,
    "facilities": facilities,
    "routes": routes,
    "drivers": drivers,
    "trucks": trucks,
    "loads": loads,
    "trips": trips,
    "delivery_events": delivery_events,
}

# When a raw identifier arrives blank instead of padded.
_BLANK = {
    ("customers", "customer_id"): "account_status = 'SUSPENDED'",
    ("facilities", "facility_id"): "latitude < -500",
    ("drivers", "driver_id"): "employment_status = 'ON_LEAVE'",
    ("trucks", "truck_id"): "model_year = 50",
    ("loads", "customer_id"): "load_type = '1-URGENT' AND revenue < 50000",
    ("trips", "trip_id"): "fuel_gallons_used = 1",
    ("delivery_events", "event_id"): "detention_minutes = 50",
}


def typed(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Typed frames of the named roles (all by default)."""
    return {n: TYPED[n](spark, sf_dir) for n in (names or TYPED)}


def raw_role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One role as a text batch."""
    df = TYPED[name](spark, sf_dir)
    if name == "delivery_events":
        # Whole numbers arrive as 12.0, like nullable integers from an export.
        df = df.withColumn("detention_minutes", F.col("detention_minutes").cast("double"))
    columns = []
    for c in df.columns:
        text = F.col(c).cast("string")
        if c.endswith("_id"):
            text = F.concat(F.lit(" "), text, F.lit(" "))
        if (name, c) in _BLANK:
            text = F.when(F.expr(_BLANK[name, c]), F.lit("  ")).otherwise(text)
        columns.append(text.alias(c))
    return df.select(columns)


def raw(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Text batches of the named roles (all by default)."""
    return {n: raw_role(spark, sf_dir, n) for n in (names or TYPED)}


def typed_unique(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Typed frames with trips and delivery events reduced to their latest state."""
    frames = typed(spark, sf_dir)
    for name in ("trips", "delivery_events"):
        spec = SPECS[name]
        frames[name] = latest_state(frames[name], spec.key, spec.recency)
    return frames
