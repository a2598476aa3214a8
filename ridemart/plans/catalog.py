"""Registered queries: one callable (spark, sf_dir) -> DataFrame per SURVEY section-2 ID.

Gold-layer queries read the warehouse built once per session from the driver's tables
(``plans.warehouse``). Sums of money are rounded to 2 digits and other non-integral measures
to 4 in the returned frames, because floating-point addition order differs between engines
and the independent DuckDB oracle (``plans.oracle``) rounds the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import analytics as A
from ridemart.operators import features as FE
from ridemart.operators import silver as S
from ridemart.plans.warehouse import AS_OF, warehouse, weather_tables
from ridemart.sources import testdata

# Fixed dashboard selection used by the filtered variants (exercises FLT9-FLT10).
DEMO_FILTER = A.TripFilter(
    start="1996-01-01", end="1999-12-31",
    days=("Monday", "Wednesday", "Friday", "Saturday"),
    zones=("Nation_1", "Nation_3", "Nation_5", "Nation_7", "Nation_11", "Nation_13"),
    payment_types=("1-urgent", "3-medium", "Card"),
)
DEMO_HOUR_FILTER = A.TripFilter(start="2024-01-05", end="2024-01-25",
                                days=("Monday", "Tuesday", "Saturday"), hours=tuple(range(6, 20)))
DEMO_WEATHER_FILTER = A.TripFilter(start="1996-01-01", end="2000-12-31",
                                   days=("Tuesday", "Thursday", "Sunday"),
                                   weather=("Light rain shower", "Overcast", "Sunny", "Light snow"))


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


def _r4(df: DataFrame, *cols: str) -> DataFrame:
    return rounded(df, {c: 4 for c in cols})


WEATHER_MEASURES = ["avg_temp_c", "total_precip_mm", "avg_wind_speed_kmph", "avg_humidity",
                    "avg_visibility_km", "avg_cloud_cover", "avg_pressure_mb"]


def _wh(spark: SparkSession, sf: str, source: str = "orders"):
    return warehouse(spark, sf, source)


def _trips(spark, sf, f: A.TripFilter | None = None):
    wh = _wh(spark, sf)
    return (f or A.TripFilter()).trips(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])


def _weather_days(spark, sf, f: A.TripFilter | None = None):
    wh = _wh(spark, sf)
    return (f or A.TripFilter()).weather_days(wh["daily_kpis"], wh["dim_date"])


def _hourly(spark, sf, f: A.TripFilter | None = None):
    wh = _wh(spark, sf, "events")
    return (f or A.TripFilter()).hourly(wh["hourly_trips"], wh["dim_date"])


def _zone_map(spark, sf, f: A.TripFilter | None = None):
    wh = _wh(spark, sf)
    zd = (f or A.TripFilter()).zone_days(wh["zone_daily"], wh["dim_date"], wh["dim_zone"])
    return A.zone_revenue_map(zd, wh["dim_zone"])


def _features(spark, sf):
    wh = _wh(spark, sf)
    return FE.feature_table(FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # ---- silver / weather / star builds
    "WIN1_silver_taxi": lambda s, sf: _wh(s, sf)["silver_taxi"],
    "FLT2_future_pickup_report": lambda s, sf: S.future_pickup_report(
        testdata.trips_typed(s, sf), AS_OF["orders"]),
    "FLT3_silver_weather": lambda s, sf: weather_tables(s, sf)["silver_weather"],
    "AGG1_weather_daily": lambda s, sf: _r4(weather_tables(s, sf)["weather_daily"], *WEATHER_MEASURES),
    "JN1_dim_date": lambda s, sf: _r4(_wh(s, sf)["dim_date"], *WEATHER_MEASURES),
    "WIN4_dim_zone": lambda s, sf: _wh(s, sf)["dim_zone"],
    "JN4_fact_trip": lambda s, sf: _wh(s, sf)["fact_trip"],
    "WIN1_event_silver_taxi": lambda s, sf: _wh(s, sf, "events")["silver_taxi"],
    "JN4_event_fact_trip": lambda s, sf: _wh(s, sf, "events")["fact_trip"],
    # ---- marts
    "AGG2_daily_kpis": lambda s, sf: rounded(_wh(s, sf)["daily_kpis"], {"total_revenue": 2}),
    "AGG23_zone_daily": lambda s, sf: rounded(_wh(s, sf)["zone_daily"], {"total_revenue": 2}),
    "AGG24_hourly_trips": lambda s, sf: _wh(s, sf, "events")["hourly_trips"],
    # ---- saved SQL questions
    "AGG3_monthly_revenue": lambda s, sf: rounded(
        A.monthly_revenue(_wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"]), {"total_revenue": 2}),
    "AGG4_trips_per_hour_weekday": lambda s, sf: A.trips_per_hour_weekday(
        _wh(s, sf, "events")["fact_trip"], _wh(s, sf, "events")["dim_date"]),
    "AGG5_revenue_by_zone_payment": lambda s, sf: rounded(
        A.revenue_by_zone_payment(_wh(s, sf)["fact_trip"], _wh(s, sf)["dim_zone"]), {"revenue": 2}),
    "AGG6_top_zones": lambda s, sf: rounded(
        A.top_zones(_wh(s, sf)["fact_trip"], _wh(s, sf)["dim_zone"]), {"revenue": 2}),
    "AGG7_wait_by_weekday": lambda s, sf: A.wait_by_weekday(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"]),
    # ---- dashboard
    "AGG8_kpi_cards": lambda s, sf: rounded(A.kpi_cards(_trips(s, sf)), {
        "total_revenue": 2, "avg_duration_min": 4, "avg_distance_km": 4}),
    "FLT10_kpi_cards_filtered": lambda s, sf: rounded(A.kpi_cards(_trips(s, sf, DEMO_FILTER)), {
        "total_revenue": 2, "avg_duration_min": 4, "avg_distance_km": 4}),
    "AGG9_monthly_revenue_trend": lambda s, sf: rounded(
        A.monthly_revenue_trend(_trips(s, sf)), {"revenue": 2}),
    "AGG10_top15_zones_filtered": lambda s, sf: rounded(
        A.top_zones_by_revenue(_trips(s, sf, DEMO_FILTER), _wh(s, sf)["dim_zone"]), {"revenue": 2}),
    "AGG11_duration_by_weekday": lambda s, sf: _r4(
        A.duration_by_weekday(_trips(s, sf)), "avg_duration_min"),
    "AGG12_revenue_zone_payment_top10": lambda s, sf: rounded(
        A.revenue_zone_payment_top(_trips(s, sf), _wh(s, sf)["dim_zone"]), {"revenue": 2}),
    "AGG13_zone_revenue_map": lambda s, sf: rounded(_zone_map(s, sf), {
        "total_revenue": 2, "revenue_per_trip": 4}),
    "AGG14_zone_revenue_map_filtered": lambda s, sf: rounded(_zone_map(s, sf, DEMO_FILTER), {
        "total_revenue": 2, "revenue_per_trip": 4}),
    "AGG15_zone_revenue_summary": lambda s, sf: rounded(
        A.zone_revenue_summary(_zone_map(s, sf)), {"total_revenue": 2}),
    "AGG16_hourly_by_day": lambda s, sf: A.hourly_by_day(_hourly(s, sf)),
    "FLT11_hourly_by_day_filtered": lambda s, sf: A.hourly_by_day(_hourly(s, sf, DEMO_HOUR_FILTER)),
    "AGG17_avg_trips_heatmap": lambda s, sf: _r4(
        A.avg_trips_heatmap(_hourly(s, sf)), *[f"h{h:02d}" for h in range(24)]),
    "AGG18_total_trips_heatmap": lambda s, sf: A.total_trips_heatmap(_hourly(s, sf)),
    "AGG19_weather_avg_daily_trips": lambda s, sf: _r4(
        A.weather_avg_daily_trips(_weather_days(s, sf)), "avg_trips"),
    "FLT12_weather_avg_daily_trips_filtered": lambda s, sf: _r4(
        A.weather_avg_daily_trips(_weather_days(s, sf, DEMO_WEATHER_FILTER)), "avg_trips"),
    "AGG20_trips_by_day_weather_group": lambda s, sf: A.trips_by_day_weather_group(
        _weather_days(s, sf)),
    "AGG21_revenue_by_weather_group": lambda s, sf: rounded(
        A.revenue_by_weather_group(_weather_days(s, sf)), {"avg_daily_revenue": 2}),
    "AGG22_duration_by_weather": lambda s, sf: _r4(
        A.duration_by_weather(_weather_days(s, sf)), "avg_duration"),
    "AGG26_date_range": lambda s, sf: A.date_range(_wh(s, sf)["dim_date"]),
    "FLT14_filter_options": lambda s, sf: A.filter_options(
        _wh(s, sf)["dim_date"], _wh(s, sf)["dim_zone"], _wh(s, sf)["fact_trip"]),
    "ORD5_trip_details_page": lambda s, sf: A.page(
        A.trip_details(_trips(s, sf, DEMO_FILTER), _wh(s, sf)["dim_zone"]), page_no=3, page_size=50),
    # ---- business questions
    "BQ1_revenue_last_week": lambda s, sf: rounded(A.revenue_last_week(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"], AS_OF["orders"]), {"total_revenue": 2}),
    "BQ2_zones_most_trips": lambda s, sf: rounded(A.zones_most_trips(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_zone"]), {"revenue": 2}),
    "BQ3_weather_duration_effect": lambda s, sf: _r4(A.weather_duration_effect(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"], _wh(s, sf)["daily_kpis"]),
        "mean_of_daily_avg_duration", "trip_weighted_avg_duration"),
    "BQ4_avg_fare_by_weekday": lambda s, sf: rounded(A.avg_fare_by_weekday(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"]), {"avg_fare": 2}),
    "BQ5_busiest_hour_per_weekday": lambda s, sf: A.busiest_hour_per_weekday(
        A.trips_per_hour_weekday(_wh(s, sf, "events")["fact_trip"], _wh(s, sf, "events")["dim_date"])),
    "BQ5_busiest_hour_overall": lambda s, sf: A.busiest_hour_overall(
        A.trips_per_hour_weekday(_wh(s, sf, "events")["fact_trip"], _wh(s, sf, "events")["dim_date"])),
    "BQ6_revenue_rainy_vs_dry": lambda s, sf: rounded(A.revenue_rainy_vs_dry(
        _weather_days(s, sf)), {"avg_daily_revenue": 2, "total_revenue": 2}),
    "BQ7_trip_details": lambda s, sf: A.trip_details(_trips(s, sf, DEMO_FILTER),
                                                     _wh(s, sf)["dim_zone"]).drop("trip_key"),
    # ---- ML features
    "ML1_trip_features": lambda s, sf: _r4(_features(s, sf), "fare_per_distance", "lat_delta",
                                           "lon_delta", "location_distance_proxy"),
    "ML3_train_test_split": lambda s, sf: FE.with_split(_features(s, sf)).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(FE.TARGET), 4).alias("avg_target")),
    "AGG25_feature_null_profile": lambda s, sf: FE.null_profile(FE.trip_features_view(
        _wh(s, sf)["fact_trip"], _wh(s, sf)["dim_date"], _wh(s, sf)["dim_zone"])),
    "AGG27_feature_medians": lambda s, sf: _r4(FE.exact_medians(
        _features(s, sf), FE.NUMERIC_FEATURES), "median"),
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query, including the ones defined in other plan modules."""
    from ridemart.plans.checks import MORE_QUERIES
    from ridemart.plans.extra import EXTRA_QUERIES
    from ridemart.plans.loads import LOAD_QUERIES
    from ridemart.plans.profiles import PROFILE_QUERIES
    return QUERIES | EXTRA_QUERIES | MORE_QUERIES | LOAD_QUERIES | PROFILE_QUERIES
