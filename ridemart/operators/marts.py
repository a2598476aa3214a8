"""Gold marts: daily KPIs (AGG2), zone-daily (AGG23) and hourly trips (AGG24).

All three aggregate the fact on its foreign keys first and only then join the (tiny) result
with dim_date: the per-row dimension lookup is replaced by one lookup per group, and the
shuffle carries partial aggregates instead of trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def daily_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per (full_date, day_name): revenue, round(avg duration, 2), trips, round(avg distance, 2).

    Inner join: trips without a booked-for date are not counted. avg skips NULLs, so a day
    without any duration has a NULL average.
    """
    per_key = fact.groupBy("trip_booked_for_date_key").agg(
        F.sum("fare_amount").alias("total_revenue"),
        F.sum("trip_duration_minutes").alias("_dur_sum"),
        F.count("trip_duration_minutes").alias("_dur_n"),
        F.count("trip_key").alias("total_trips"),
        F.sum("distance").alias("_dist_sum"),
        F.count("distance").alias("_dist_n"),
    )
    d = dim_date.select("date_key", "full_date", "day_name")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return j.select(
        "full_date", "day_name", "total_revenue",
        F.round(F.col("_dur_sum") / F.col("_dur_n"), 2).alias("avg_trip_duration_min"),
        "total_trips",
        F.round(F.col("_dist_sum") / F.col("_dist_n"), 2).alias("avg_distance_km"),
    )


def zone_daily(fact: DataFrame) -> DataFrame:
    """Per (booked-for date key, pickup zone key): revenue and trips."""
    return fact.groupBy("trip_booked_for_date_key", "pickup_zone_key").agg(
        F.sum("fare_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_trips"),
    )


def hourly_trips(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per (trip_date, day_name, hour_of_day): number of trips (inner join on the date key)."""
    per_key = fact.groupBy(
        "trip_booked_for_date_key",
        F.hour("pickup_due_timestamp").alias("hour_of_day"),
    ).agg(F.count(F.lit(1)).alias("trip_count"))
    d = dim_date.select("date_key", "full_date", "day_name")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return j.select(F.col("full_date").alias("trip_date"), "day_name",
                    F.col("hour_of_day").cast("int").alias("hour_of_day"), "trip_count")
