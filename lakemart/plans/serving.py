"""Reports served from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route_sla(routes: DataFrame, min_trips: int = 25) -> DataFrame:
    """Routes with enough trips, least fuel-efficient first."""
    return (
        routes.where(F.col("total_trips") >= min_trips)
        .select(
            "route_id",
            "origin_city",
            "destination_city",
            "total_trips",
            F.round("avg_trip_duration_hours", 2).alias("avg_duration_hrs"),
            "fuel_efficiency_miles_per_gallon",
        )
        .orderBy(F.asc_nulls_last("fuel_efficiency_miles_per_gallon"), "route_id")
    )


def top_facilities(facilities: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` facilities with the longest average detention."""
    return (
        facilities.orderBy(F.desc_nulls_last("avg_detention_minutes"), "facility_id")
        .limit(k)
        .select(
            "facility_id",
            "facility_name",
            "city",
            "state",
            "total_events",
            "on_time_rate",
            F.round("avg_detention_minutes", 2).alias("avg_detention_minutes"),
        )
    )


def daily_report(daily: DataFrame) -> DataFrame:
    """The daily mart in date order; sorted when read, as a stored table has no order."""
    return daily.orderBy("event_date")
