"""Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import published_schema
from ..functions.amounts import exact_avg, exact_sum, percentage


def _mean(column: str):
    return F.round(exact_avg(column), 2)


def gold_trips_clean(valid: DataFrame) -> DataFrame:
    """The 22 published columns of the valid trips; map-only."""
    return valid.select(*published_schema("gold_trips_clean").fieldNames())


def gold_daily_revenue(valid: DataFrame) -> DataFrame:
    """Revenue and operations per service and pickup day."""
    return valid.groupBy("service_type", F.to_date("pickup_datetime").alias("trip_date")).agg(
        F.count("*").alias("total_trips"),
        F.round(exact_sum("total_amount"), 2).alias("total_revenue"),
        _mean("fare_amount").alias("average_fare"),
        _mean("tip_amount").alias("average_tip"),
        _mean("trip_distance").alias("average_trip_distance"),
        _mean("trip_duration_minutes").alias("average_trip_duration"),
        F.count_if("is_suspicious_trip").alias("suspicious_trips"),
        percentage(F.count_if(F.col("quality_status") == "VALID"), F.count("*")).alias("quality_percentage"),
    )


def gold_location_performance(valid: DataFrame, min_trips: int = 1) -> DataFrame:
    """Performance per service and pair of zones with at least `min_trips` trips."""
    return (
        valid.groupBy("service_type", "pickup_location_id", "dropoff_location_id")
        .agg(
            F.count("*").alias("total_trips"),
            F.round(exact_sum("total_amount"), 2).alias("total_revenue"),
            _mean("fare_amount").alias("average_fare"),
            _mean("trip_distance").alias("average_distance"),
            _mean("trip_duration_minutes").alias("average_duration"),
            F.count_if("is_suspicious_trip").alias("suspicious_trip_count"),
            _mean("average_speed_mph").alias("average_speed_mph"),
        )
        .filter(F.col("total_trips") >= min_trips)
    )
