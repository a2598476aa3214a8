"""Table schemas and column specs shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the raw bookings file, in file order.
BOOKING_RAW_COLUMNS = [
    "Booking ID", "Source", "Pickup Due", "Time Dispatched", "Time Vehicle Arrived",
    "Time Picked Up", "Completed", "Driver", "Vehicle", "Payment Type", "Priority",
    "Capabilities", "Booking source", "Price", "Distance", "Pickup Zone", "Destination Zone",
    "Pickup Latitude", "Pickup Longitude", "Destination Latitude", "Destination Longitude",
    "Booked by",
]

# Header of the raw weather file.
WEATHER_RAW_COLUMNS = [
    "loc_id", "date", "avgtempC", "totalprecipMM", "windspeedKmph", "humidity",
    "visibilityKm", "cloudcover", "pressureMB", "weatherDesc",
]

# Fixed value: minute-resolution timestamp pattern of the booking file.
BOOKING_TS_PATTERN = "dd/MM/yyyy HH:mm"

CORRUPT_COLUMN = "_corrupt_record"


def all_string_schema(columns: list[str], with_corrupt: bool = False) -> T.StructType:
    """Bronze keeps source text untouched: every column is a string, typing happens in silver."""
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


BOOKING_RAW_SCHEMA = all_string_schema(BOOKING_RAW_COLUMNS)
WEATHER_RAW_SCHEMA = all_string_schema(WEATHER_RAW_COLUMNS)

# (silver name, raw column, kind). kind drives the parse expression in silver.
SILVER_SPEC = [
    ("booking_id", "Booking ID", "id"),
    ("trip_status", "Source", "text"),
    ("pickup_due_ts", "Pickup Due", "ts"),
    ("time_dispatched_ts", "Time Dispatched", "ts"),
    ("time_vehicle_arrived_ts", "Time Vehicle Arrived", "ts"),
    ("time_picked_up_ts", "Time Picked Up", "ts"),
    ("completed_ts", "Completed", "ts"),
    ("driver", "Driver", "text"),
    ("vehicle", "Vehicle", "text"),
    ("payment_type", "Payment Type", "text"),
    ("priority", "Priority", "int"),
    ("capabilities", "Capabilities", "text"),
    ("booking_source", "Booking source", "text"),
    ("price", "Price", "number"),
    ("distance", "Distance", "number"),
    ("pickup_zone", "Pickup Zone", "text"),
    ("destination_zone", "Destination Zone", "text"),
    ("pickup_latitude", "Pickup Latitude", "double"),
    ("pickup_longitude", "Pickup Longitude", "double"),
    ("destination_latitude", "Destination Latitude", "double"),
    ("destination_longitude", "Destination Longitude", "double"),
    ("booked_by", "Booked by", "text"),
]

SILVER_COLUMNS = [name for name, _, _ in SILVER_SPEC]

SILVER_SCHEMA = T.StructType([
    T.StructField(name, {
        "id": T.StringType(), "text": T.StringType(), "ts": T.TimestampType(),
        "int": T.IntegerType(), "number": T.DoubleType(), "double": T.DoubleType(),
    }[kind], True)
    for name, _, kind in SILVER_SPEC
])

# Six columns where a blank string means "missing"; driver, vehicle, capabilities and
# booked_by keep their blank strings.
BLANK_TO_NULL_COLUMNS = [
    "booking_id", "trip_status", "payment_type", "booking_source", "pickup_zone",
    "destination_zone",
]

# Text columns conformed with initcap(trim()).
CONFORMED_TEXT_COLUMNS = [
    "payment_type", "booking_source", "pickup_zone", "destination_zone", "trip_status",
]

# (silver weather name, raw column, spark type)
WEATHER_SPEC = [
    ("loc_id", "loc_id", "int"),
    ("date", "date", "date"),
    ("avg_temp_c", "avgtempC", "int"),
    ("total_precip_mm", "totalprecipMM", "double"),
    ("wind_speed_kmph", "windspeedKmph", "int"),
    ("humidity", "humidity", "int"),
    ("visibility_km", "visibilityKm", "int"),
    ("cloud_cover", "cloudcover", "int"),
    ("pressure_mb", "pressureMB", "int"),
    ("weather_desc", "weatherDesc", "string"),
]

WEATHER_DAILY_COLUMNS = [
    "date", "avg_temp_c", "total_precip_mm", "avg_wind_speed_kmph", "avg_humidity",
    "avg_visibility_km", "avg_cloud_cover", "avg_pressure_mb", "weather_desc",
]

DIM_DATE_COLUMNS = [
    "date_key", "full_date", "day", "day_name", "week", "month", "month_name", "quarter",
    "year", "weekend_flag",
] + WEATHER_DAILY_COLUMNS[1:]

DIM_ZONE_COLUMNS = ["zone_key", "zone_code", "latitude", "longitude"]

FACT_TRIP_COLUMNS = [
    "trip_key", "booking_id", "trip_booked_for_date_key", "pickup_zone_key",
    "destination_zone_key", "status", "payment_type", "booking_source", "driver_id",
    "vehicle_id", "priority_level", "capabilities", "dispatcher_id", "fare_amount",
    "dispatch_timestamp", "pickup_due_timestamp", "distance",
    "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes",
    "trip_duration_minutes",
]
