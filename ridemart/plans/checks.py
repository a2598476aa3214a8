"""Further registered queries with their SQL: ordered answers, all extracts read back, damaged input (NULLs,
text that does not parse, repeated and orphan keys) and model steps on fixed predictors.

The damage is a rule on keys of the given tables that both engines apply.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.functions import expr as X
from ridemart.operators import analytics as A
from ridemart.operators import features as FE
from ridemart.operators import model as M
from ridemart.operators import quality as Q
from ridemart.plans.catalog import DEMO_WEATHER_FILTER, QUERIES, WEATHER_MEASURES, rounded
from ridemart.plans.extra import _md5_number, _weather_deduped, bronze_batch, bronze_text, extracts
from ridemart.plans.warehouse import warehouse
from ridemart.session import scratch_path
from ridemart.sources import files, testdata

# ------------------------------------------------------------------------------ ordered answers

#: Registered question and its order; a leading "-" means descending. NULLs come last.
ORDERED = {
    "ORD1_monthly_revenue": ("AGG3_monthly_revenue", ["year", "month"]),
    "ORD1_trips_per_hour_weekday": ("AGG4_trips_per_hour_weekday", ["-num_trips", "pickup_hour", "day_name"]),
    "ORD1_revenue_by_zone_payment": ("AGG5_revenue_by_zone_payment", ["-revenue", "zone_code", "payment_type"]),
    "ORD1_weather_avg_daily_trips": ("AGG19_weather_avg_daily_trips", ["-avg_trips", "weather_desc"]),
    "ORD1_duration_by_weather": ("AGG22_duration_by_weather", ["-avg_duration", "weather_desc"]),
}


def _ordered(question: str, order: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    def answer(spark: SparkSession, sf: str) -> DataFrame:
        columns = [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in order]
        return A.with_position(QUERIES[question](spark, sf), *columns)
    return answer


# -------------------------------------------------------------------------------- damaged input

def damaged_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Booking text in which a hash of the booking id decides what is wrong: 0 a time that does not exist, 1 a
    price in words, 2 a priority in words, 3 no due time, 4 to 6 nothing."""
    raw = spark.read.parquet(bronze_text(spark, sf))
    kind = _md5_number(F.col("`Booking ID`")) % 7
    wrong = {"Completed": (0, "31/02/2026 10:00"), "Price": (1, "n/a"), "Priority": (2, "high"), "Pickup Due": (3, " ")}
    return raw.withColumns({c: F.when(kind == k, F.lit(v)).otherwise(F.col(f"`{c}`")) for c, (k, v) in wrong.items()})


def damaged_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with rows repeated (trip_key divisible by 10), zone keys that no zone has (by 7) and a date
    key that no date has (by 11), and no destination (by 4)."""
    fact, key = warehouse(spark, sf)["fact_trip"], F.col("trip_key")
    fact = fact.withColumns({
        "pickup_zone_key": F.when(key % 7 == 0, F.lit(999_999)).otherwise(F.col("pickup_zone_key")).cast(fact.schema["pickup_zone_key"].dataType),
        "trip_booked_for_date_key": F.when(key % 11 == 0, F.lit(18_000_101)).otherwise(F.col("trip_booked_for_date_key")).cast(fact.schema["trip_booked_for_date_key"].dataType),
        "destination_zone_key": F.when(key % 4 != 0, F.col("destination_zone_key"))})
    return fact.unionByName(fact.where(key % 10 == 0))


def damaged_features(spark: SparkSession, sf: str) -> DataFrame:
    """Model features (split) of trips without a distance (trip_key divisible by 5), a destination (by 7) or a
    waiting time (by 3), and with unknown arrival times (by 4)."""
    wh, key = warehouse(spark, sf), F.col("trip_key")
    view = FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])
    gone = {"distance": 5, "destination_latitude": 7, "expected_vs_actual_pickup_minutes_difference": 3, "dispatch_to_arrival_minutes": 4}
    return FE.with_split(FE.feature_table(view.withColumns({c: F.when(key % n != 0, F.col(c)) for c, n in gone.items()})))


def ingest_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4: rows of the batch bronze with an ingest time, and with the file of the landing folder they came from."""
    b = spark.read.parquet(bronze_batch(spark, sf))
    return b.agg(F.count("_ingest_timestamp").alias("with_time"), F.count_if(F.col("_source_file").rlike(r"\.csv(\.gz)?$")).alias("with_file"),
                 F.count_if(F.col("_source_file").isNull()).alias("without_file"))


def normalised_header(spark: SparkSession, sf: str) -> DataFrame:
    """SRC5 + FN2: weather with spaces in its column names, normalised, then one total per renamed column."""
    raw = testdata.weather_bronze(spark, sf).select("date", F.col("loc_id").alias("loc id"), F.col("windspeedKmph").alias("wind speed Kmph"))
    total = files.normalise_names(raw).agg(F.count("loc_id").alias("loc_id"), F.sum(F.col("wind_speed_Kmph").cast("long")).alias("wind_speed_Kmph"))
    return total.unpivot([], ["loc_id", "wind_speed_Kmph"], "column_name", "total")


def shown_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """FN20: monthly revenue as display text."""
    months = QUERIES["AGG3_monthly_revenue"](spark, sf)
    return months.select("year", "month", X.money("total_revenue").alias("shown"))


def replaced_schema(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3: a table overwritten with another schema is read back with the new columns only."""
    fact, path = warehouse(spark, sf)["fact_trip"], scratch_path(spark, "checks", uuid4().hex)
    files.overwrite(fact.select("trip_key", "fare_amount"), path)
    files.overwrite(fact.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trips")), path)
    return spark.read.parquet(path).select("*")


def fail_mode(spark: SparkSession, sf: str) -> DataFrame:
    """DQ1: the weather rules in fail mode: what breaks them, and whether the load is aborted."""
    readings, rules = _weather_deduped(spark, sf), [Q.Rule(r.name, r.condition, Q.FAIL) for r in Q.weather_rules()]
    try:
        Q.apply_rules(readings, rules)
        aborted = False
    except Q.ExpectationFailed:
        aborted = True
    return Q.report(readings, rules).withColumn("aborted", F.lit(aborted))


# ---------------------------------------------------------------------------------- model steps

FILLED = ["expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes", "journey_urgency"]


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    feats = damaged_features(spark, sf)
    train, test, _ = M.prepare(feats.where("split = 'train'"), feats.where("split = 'test'"))
    parts = [df.agg(*[F.round(F.avg(c), 4).alias(c) for c in FILLED]).unpivot([], FILLED, "column_name", "mean_filled")
             .withColumn("split", F.lit(name)) for name, df in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


def _mean_predictor(spark: SparkSession, sf: str) -> DataFrame:
    feats = damaged_features(spark, sf)
    train = feats.where("split = 'train'")
    means = train.groupBy("payment_type").agg(F.avg(FE.TARGET).alias("predicted"))
    pred = feats.where("split = 'test'").join(means, "payment_type").select(F.col(FE.TARGET).alias("actual"), "predicted")
    return rounded(M.regression_metrics(pred), {"mae": 4, "rmse": 4, "r2": 4})


def _line(spark: SparkSession, sf: str) -> DataFrame:
    train = VectorAssembler(inputCols=["distance"], outputCol="x").transform(damaged_features(spark, sf).where("split = 'train'"))
    fit = LinearRegression(featuresCol="x", labelCol=FE.TARGET, solver="normal").fit(train)
    return spark.createDataFrame([(round(float(fit.coefficients[0]), 4), round(float(fit.intercept), 4))], "slope double, intercept double")


def _capped_log(spark: SparkSession, sf: str) -> DataFrame:
    """FLT8 + FN19: with a cap inside the range of the data, the kept rows and the mean of log(1 + target)."""
    kept = damaged_features(spark, sf).where(F.col(FE.TARGET) <= 30)
    return kept.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.log1p(FE.TARGET)), 4).alias("mean_log"),
                                     F.round(F.avg(F.expm1(F.log1p(FE.TARGET))), 4).alias("mean_back"))


MORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _ordered(*spec) for name, spec in ORDERED.items()},
    "FLT11_hourly_weather_filtered": lambda s, sf: A.hourly_by_day(
        DEMO_WEATHER_FILTER.hourly(warehouse(s, sf)["hourly_trips"], warehouse(s, sf)["dim_date"])),
    "SRC6_extract_dim_date": lambda s, sf: rounded(files.read_extract(s, extracts(s, sf), "dim_date"), {c: 4 for c in WEATHER_MEASURES}),
    "SRC6_extract_zone_daily": lambda s, sf: rounded(files.read_extract(s, extracts(s, sf), "fact_zone_daily_agg"), {"total_revenue": 2}),
    "SRC6_extract_hourly": lambda s, sf: files.read_extract(s, extracts(s, sf), "trips_per_hour_by_day"),
    "SRC6_extract_trip_sample": lambda s, sf: files.read_extract(
        s, extracts(s, sf), "fact_trip_sample", warehouse(s, sf)["fact_trip"].schema),
    "DQ4_damaged_parse_report": lambda s, sf: Q.report(damaged_bookings(s, sf), Q.bronze_parse_rules()),
    "DQ6_damaged_key_checks": lambda s, sf: Q.key_checks(
        damaged_fact(s, sf), warehouse(s, sf)["dim_date"], warehouse(s, sf)["dim_zone"]),
    "DQ1_fail_mode": fail_mode,
    "SRC4_ingest_metadata": ingest_metadata,
    "SRC5_normalised_header": normalised_header,
    "FN20_shown_revenue": shown_revenue,
    "SNK3_replaced_schema": replaced_schema,
    "FLT7_damaged_features": lambda s, sf: damaged_features(s, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count("pickup_delay_signal").alias("with_wait"), F.count("journey_urgency").alias("with_urgency"),
        F.count_if(F.col("dispatch_to_arrival_minutes") == 0).alias("arrival_zero"), F.round(F.avg("distance"), 4).alias("avg_distance")),
    "ML4_filled_means": _filled,
    "ML7_one_feature_line": _line,
    "ML10_mean_predictor_metrics": _mean_predictor,
    "FLT8_capped_log_target": _capped_log,
}


def damaged_sql(features: str) -> str:
    """The CTEs up to ``parts``: the features of ``damaged_features`` with their split."""
    return features.replace("feat AS (", """dview AS (SELECT * REPLACE (
        CASE WHEN trip_key % 5 <> 0 THEN distance END AS distance,
        CASE WHEN trip_key % 7 <> 0 THEN destination_latitude END AS destination_latitude,
        CASE WHEN trip_key % 3 <> 0 THEN expected_vs_actual_pickup_minutes_difference END AS expected_vs_actual_pickup_minutes_difference,
        CASE WHEN trip_key % 4 <> 0 THEN dispatch_to_arrival_minutes END AS dispatch_to_arrival_minutes) FROM fview),
feat AS (""", 1).replace("FROM fview\n", "FROM dview\n", 1).rstrip() + """,
parts AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(coalesce(booking_id, '') || ':42'), 1, 8)) AS BIGINT) % 100 < 20
          THEN 'test' ELSE 'train' END AS split FROM feat)
"""


def more_sql(base: dict[str, str], extra: dict[str, str], with_star: Callable[[str], str], features: str,
             hourly_by_day: str) -> dict[str, str]:
    """SQL for MORE_QUERIES. base, extra: SQL of the queries they build on; features: the CTEs up to ``feat``."""
    out = {}
    for name, (question, order) in ORDERED.items():
        keys = ", ".join(f"{c[1:]} DESC NULLS LAST" if c[0] == "-" else f"{c} ASC NULLS LAST" for c in order)
        out[name] = f"SELECT *, CAST(row_number() OVER (ORDER BY {keys}) AS INTEGER) AS position FROM ({base[question]})"
    out["FLT11_hourly_weather_filtered"] = hourly_by_day
    out["SRC6_extract_dim_date"] = base["JN1_dim_date"]
    out["SRC6_extract_zone_daily"] = base["AGG23_zone_daily"]
    out["SRC6_extract_hourly"] = with_star("SELECT * FROM hourly_trips")
    out["SRC6_extract_trip_sample"] = extra["SNK9_trip_sample"]
    number = "CAST(('0x' || substr(md5(b), 1, 8)) AS BIGINT)"
    broken = {"completed_ts": 0, "price": 1, "priority": 2}
    rules = ["pickup_due_ts", "time_dispatched_ts", "time_vehicle_arrived_ts", "time_picked_up_ts", "completed_ts", "priority", "price",
             "distance", "pickup_latitude", "pickup_longitude", "destination_latitude", "destination_longitude"]
    bad = {c: f"count(*) FILTER (WHERE {number} % 7 = {broken[c]})" if c in broken else "CAST(0 AS BIGINT)" for c in rules}
    out["DQ4_damaged_parse_report"] = (
        "WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS b FROM lineitem) "
        + " UNION ALL ".join(f"SELECT '{c}_parses' AS rule, 'expect' AS mode, count(*) AS rows_checked, count(*) - {n} AS passed, "
                             f"{n} AS failed FROM l" for c, n in bad.items()))
    out["DQ1_fail_mode"] = (f"WITH q AS ({extra['DQ4_weather_quality_report']}) SELECT * REPLACE ('fail' AS mode), "
                            "(SELECT sum(failed) FROM q) > 0 AS aborted FROM q")
    out["SRC4_ingest_metadata"] = ("SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS with_time, "
                                   "(SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS with_file, CAST(0 AS BIGINT) AS without_file")
    out["SRC5_normalised_header"] = ("SELECT 'loc_id' AS column_name, count(l_suppkey) AS total FROM lineitem UNION ALL "
                                     "SELECT 'wind_speed_Kmph', CAST(sum(l_linenumber * 5) AS BIGINT) FROM lineitem")
    out["FN20_shown_revenue"] = f"SELECT year, month, '£' || format('{{:,.2f}}', total_revenue) AS shown FROM ({base['AGG3_monthly_revenue']})"
    out["SNK3_replaced_schema"] = with_star("SELECT payment_type, count(*) AS trips FROM fact_trip GROUP BY 1")
    twice = "CASE WHEN trip_key % 10 = 0 THEN 2 ELSE 1 END"
    two = "CAST(coalesce(sum(2) FILTER (WHERE trip_key % 10 = 0{}), 0) AS BIGINT)"
    gone = "CAST(coalesce(sum({}) FILTER (WHERE {}), 0) AS BIGINT)"
    counts = {
        "fact_trip.trip_key unique": two.format(""), "fact_trip.booking_id unique": two.format(" AND booking_id IS NOT NULL"),
        "dim_date.date_key unique": "count(*) FILTER (WHERE false)", "dim_zone.zone_key unique": "count(*) FILTER (WHERE false)", "dim_zone.zone_code unique": "count(*) FILTER (WHERE false)",
        "fact_trip.trip_booked_for_date_key resolves": gone.format(twice, "trip_key % 11 = 0"),
        "fact_trip.pickup_zone_key resolves": gone.format(twice, "trip_key % 7 = 0"),
        "fact_trip.destination_zone_key resolves": "count(*) FILTER (WHERE false)"}
    out["DQ6_damaged_key_checks"] = with_star(" UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", {n} AS violations FROM fact_trip" for c, n in counts.items()))
    damaged = damaged_sql(features)
    out["FLT7_damaged_features"] = damaged + (
        "SELECT split, count(*) AS rows, count(pickup_delay_signal) AS with_wait, count(journey_urgency) AS with_urgency, "
        "count(*) FILTER (WHERE dispatch_to_arrival_minutes = 0) AS arrival_zero, round(avg(distance), 4) AS avg_distance FROM parts GROUP BY split")
    out["ML4_filled_means"] = damaged + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM parts WHERE split = 'train'))), 4) "
        f"AS mean_filled, '{s}' AS split FROM parts WHERE split = '{s}'" for c in FILLED for s in ("train", "test"))
    out["ML7_one_feature_line"] = damaged + (
        "SELECT round(regr_slope(trip_duration_minutes, distance), 4) AS slope, round(regr_intercept(trip_duration_minutes, distance), 4) "
        "AS intercept FROM parts WHERE split = 'train'")
    out["ML10_mean_predictor_metrics"] = damaged + (
        ", m AS (SELECT payment_type, avg(trip_duration_minutes) AS p FROM parts WHERE split = 'train' GROUP BY 1), "
        "t AS (SELECT CAST(trip_duration_minutes AS DOUBLE) AS y, p FROM parts JOIN m USING (payment_type) WHERE split = 'test') "
        "SELECT count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, "
        "round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2 FROM t")
    out["FLT8_capped_log_target"] = damaged + (
        "SELECT split, count(*) AS rows, round(avg(ln(1 + trip_duration_minutes)), 4) AS mean_log, "
        "round(avg(CAST(trip_duration_minutes AS DOUBLE)), 4) AS mean_back FROM parts WHERE trip_duration_minutes <= 30 GROUP BY split")
    return out
