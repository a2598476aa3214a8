"""The driver's tables in the roles of the booking and weather feeds.

The generated tables (TPC-H-like orders/lineitem plus an events stream) stand in for the
operator's raw files. Each mapping is plain column arithmetic, mirrored one-to-one by the
DuckDB oracle SQL in ``ridemart.plans.oracle``.

Trips (one booking per lineitem row; (orderkey, linenumber) repeats, so WIN1 has work):
  booking_id = l_orderkey-l_linenumber     pickup_due = o_orderdate
  dispatched = due - 4*l_linenumber min    arrived = due + round(100*l_tax) min
  picked_up  = due + round(100*l_discount) min
  completed  = picked_up + (l_quantity*l_linenumber div 2) min   (0..175: outliers exist)
  status / payment / source = o_orderstatus / o_orderpriority / c_mktsegment
  capabilities = l_returnflag with 'R' playing the card-only capability 'Z'
  pickup zone / destination zone = customer nation / supplier nation
  latitude = account balance, longitude = -key/1000 (customer) or -key/100 (supplier)
  driver / vehicle / booked_by = l_suppkey / l_partkey / c_name; price = l_extendedprice;
  distance = l_quantity; priority = l_linenumber.

Event trips (hour-of-day analytics; orders carry no time of day):
  booking_id = event_id, pickup_due = picked_up = ts, completed = ts + round(60*value) s,
  payment = event_type, price = value, distance = value/4, pickup zone = nation of user_id.

Weather readings (one per lineitem row): date = l_shipdate, loc_id = l_suppkey,
  avgtempC = round(100*l_discount), totalprecipMM = l_tax, windspeedKmph = 5*l_linenumber,
  humidity = floor(2.2*l_quantity) (can exceed 100), visibilityKm = 10 - l_linenumber,
  cloudcover = 16*l_linenumber (line 7 -> 112, invalid), pressureMB = 1000 + round(100*l_tax),
  weatherDesc by l_linenumber from WEATHER_DESCS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.sources.schemas import BOOKING_RAW_COLUMNS, SILVER_COLUMNS, WEATHER_RAW_COLUMNS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Weather description for line numbers 1..7.
WEATHER_DESCS = [
    "Patchy rain possible", "Light rain shower", "Moderate rain at times",
    "Light freezing rain", "Overcast", "Light snow", "Sunny",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed_paths(sf_dir: str) -> list[str]:
    """Files of the tables that the booking and weather feeds are made from."""
    return [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("customer", "supplier", "orders", "lineitem", "events")]


def _add_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("long") * F.lit(60_000_000))


def _add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * F.lit(1_000_000))


def _nation_names(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return (n.select(F.col("n_nationkey").alias(f"{prefix}_nationkey"),
                                      F.col("n_name").alias(f"{prefix}_zone")))


#: The first part of a booking id. Lines meet their orders by it, so that bookings of one id lie together already.
ORDER_OR_LINE = "l_orderkey_or_line"


def trips_typed(spark: SparkSession, sf_dir: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Typed bookings (silver column names and types, before cleaning); ``also``: further columns kept."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        ORDER_OR_LINE, F.coalesce(F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_acctbal", "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    # orders meet their customers before their lines do: the lines, the most rows, are dealt once, by narrow columns
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    j = (li.join(o, (F.col(ORDER_OR_LINE) == F.col("o_orderkey")) & F.col("l_orderkey").isNotNull(), "left")
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    j = (j.join(_nation_names(spark, sf_dir, "p"), F.col("c_nationkey") == F.col("p_nationkey"),
                "left")
         .join(_nation_names(spark, sf_dir, "d"), F.col("s_nationkey") == F.col("d_nationkey"),
               "left"))
    due = F.col("o_orderdate").cast("timestamp")
    picked = _add_minutes(due, F.round(F.col("l_discount") * 100))
    out = j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("booking_id"),
        F.col("o_orderstatus").alias("trip_status"),
        due.alias("pickup_due_ts"),
        _add_minutes(due, -4 * F.col("l_linenumber")).alias("time_dispatched_ts"),
        _add_minutes(due, F.round(F.col("l_tax") * 100)).alias("time_vehicle_arrived_ts"),
        picked.alias("time_picked_up_ts"),
        _add_minutes(picked, F.floor(F.col("l_quantity").cast("long") * F.col("l_linenumber") / 2))
        .alias("completed_ts"),
        F.col("l_suppkey").cast("string").alias("driver"),
        F.col("l_partkey").cast("string").alias("vehicle"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("l_linenumber").cast("int").alias("priority"),
        F.when(F.col("l_returnflag") == "R", F.lit("Z")).otherwise(F.col("l_returnflag"))
        .alias("capabilities"),
        F.col("c_mktsegment").alias("booking_source"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("distance"),
        F.col("p_zone").alias("pickup_zone"),
        F.col("d_zone").alias("destination_zone"),
        F.col("c_acctbal").alias("pickup_latitude"),
        (F.col("c_custkey").cast("double") * F.lit(-0.001)).alias("pickup_longitude"),
        F.col("s_acctbal").alias("destination_latitude"),
        (F.col("s_suppkey").cast("double") * F.lit(-0.01)).alias("destination_longitude"),
        F.col("c_name").alias("booked_by"),
        *also,
    )
    return out.select(*SILVER_COLUMNS, *also)


def event_trips_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bookings from the events stream (real times of day)."""
    ev = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = (ev.join(c, ev["user_id"] == c["c_custkey"], "left")
         .join(_nation_names(spark, sf_dir, "p"), F.col("c_nationkey") == F.col("p_nationkey"),
               "left"))
    ts = F.col("ts").cast("timestamp")
    null_ts = F.lit(None).cast("timestamp")
    out = j.select(
        F.col("event_id").cast("string").alias("booking_id"),
        F.lit("completed").alias("trip_status"),
        ts.alias("pickup_due_ts"),
        null_ts.alias("time_dispatched_ts"),
        null_ts.alias("time_vehicle_arrived_ts"),
        ts.alias("time_picked_up_ts"),
        _add_seconds(ts, F.round(F.col("value") * 60)).alias("completed_ts"),
        F.col("user_id").cast("string").alias("driver"),
        F.lit(None).cast("string").alias("vehicle"),
        F.col("event_type").alias("payment_type"),
        F.lit(None).cast("int").alias("priority"),
        F.lit(None).cast("string").alias("capabilities"),
        F.lit("app").alias("booking_source"),
        F.col("value").alias("price"),
        (F.col("value") * F.lit(0.25)).alias("distance"),
        F.col("p_zone").alias("pickup_zone"),
        F.lit(None).cast("string").alias("destination_zone"),
        F.col("c_acctbal").alias("pickup_latitude"),
        (F.col("c_custkey").cast("double") * F.lit(-0.001)).alias("pickup_longitude"),
        F.lit(None).cast("double").alias("destination_latitude"),
        F.lit(None).cast("double").alias("destination_longitude"),
        F.lit(None).cast("string").alias("booked_by"),
    )
    return out.select(*SILVER_COLUMNS)


def weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather text (all strings, source headers), one reading per lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    descs = F.array(*[F.lit(d) for d in WEATHER_DESCS])
    cols = {
        "loc_id": F.col("l_suppkey").cast("string"),
        "date": F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"),
        "avgtempC": F.round(F.col("l_discount") * 100).cast("int").cast("string"),
        "totalprecipMM": F.col("l_tax").cast("string"),
        "windspeedKmph": (ln * 5).cast("string"),
        "humidity": F.floor(F.col("l_quantity") * 2.2).cast("int").cast("string"),
        "visibilityKm": (F.lit(10) - ln).cast("string"),
        "cloudcover": (ln * 16).cast("string"),
        "pressureMB": (F.lit(1000) + F.round(F.col("l_tax") * 100).cast("int")).cast("string"),
        "weatherDesc": F.element_at(descs, ln),
    }
    return li.select(*[cols[c].alias(c) for c in WEATHER_RAW_COLUMNS])


def bookings_bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw booking text built from the typed trips (FIXTURES 3.4): dd/MM/yyyy HH:mm times,
    prices with thousands separators, padded upper-case text, a blank payment type on every
    order whose key ends in 0."""
    t = trips_typed(spark, sf_dir)
    fmt = "dd/MM/yyyy HH:mm"

    def pad_upper(c: str) -> Column:
        return F.concat(F.lit(" "), F.upper(F.col(c)), F.lit("  "))

    blank_payment = F.split(F.col("booking_id"), "-").getItem(0).endswith("0")
    cols = {
        "Booking ID": F.col("booking_id"),
        "Source": pad_upper("trip_status"),
        "Pickup Due": F.date_format("pickup_due_ts", fmt),
        "Time Dispatched": F.date_format("time_dispatched_ts", fmt),
        "Time Vehicle Arrived": F.date_format("time_vehicle_arrived_ts", fmt),
        "Time Picked Up": F.date_format("time_picked_up_ts", fmt),
        "Completed": F.date_format("completed_ts", fmt),
        "Driver": F.col("driver"),
        "Vehicle": F.col("vehicle"),
        "Payment Type": F.when(blank_payment, F.lit("  ")).otherwise(pad_upper("payment_type")),
        "Priority": F.col("priority").cast("string"),
        "Capabilities": F.col("capabilities"),
        "Booking source": pad_upper("booking_source"),
        "Price": F.format_number("price", 2),
        "Distance": F.format_number("distance", 2),
        "Pickup Zone": pad_upper("pickup_zone"),
        "Destination Zone": pad_upper("destination_zone"),
        "Pickup Latitude": F.col("pickup_latitude").cast("string"),
        "Pickup Longitude": F.col("pickup_longitude").cast("string"),
        "Destination Latitude": F.col("destination_latitude").cast("string"),
        "Destination Longitude": F.col("destination_longitude").cast("string"),
        "Booked by": F.col("booked_by"),
    }
    return t.select(*[cols[c].alias(c) for c in BOOKING_RAW_COLUMNS])
