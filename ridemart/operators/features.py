"""Trip-duration feature table (ML1-3), NULL profile (AGG25) and exact medians (AGG27).

Everything stays distributed: the reference collected the whole view to one pandas process;
here the view, the engineered columns, the filters and the split are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


TARGET = "trip_duration_minutes"

# Model inputs. The 16 numeric columns exclude the destination coordinates,
# which the feature list names but the model's transformer never used.
CATEGORICAL_FEATURES = ["priority_level", "status", "payment_type", "booking_source"]
NUMERIC_FEATURES = [
    "fare_amount", "distance", "expected_vs_actual_pickup_minutes_difference",
    "dispatch_to_arrival_minutes", "month", "quarter", "year", "weekend_flag",
    "pickup_latitude", "pickup_longitude", "fare_per_distance", "pickup_delay_signal",
    "journey_urgency", "lat_delta", "lon_delta", "location_distance_proxy",
]
FEATURE_COLUMNS = [
    "priority_level", "status", "payment_type", "booking_source", "fare_amount", "distance",
    "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes", "month",
    "quarter", "year", "weekend_flag", "pickup_latitude", "pickup_longitude",
    "destination_latitude", "destination_longitude", "fare_per_distance", "pickup_delay_signal",
    "journey_urgency", "lat_delta", "lon_delta", "location_distance_proxy",
]

VIEW_COLUMNS = [
    "trip_key", "booking_id", "status", "payment_type", "booking_source", "priority_level",
    "fare_amount", "distance", "dispatch_to_arrival_minutes",
    "expected_vs_actual_pickup_minutes_difference", "trip_duration_minutes", "day", "month",
    "quarter", "year", "weekend_flag", "pickup_zone_code", "pickup_latitude", "pickup_longitude",
    "destination_zone_code", "destination_latitude", "destination_longitude",
]


def trip_features_view(fact: DataFrame, dim_date: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """JN7: fact LEFT JOIN dim_date, pickup zone, destination zone; trips with a duration."""
    d = (dim_date.select(F.col("date_key").alias("_dk"), "day", "month",
                                          "quarter", "year", "weekend_flag"))
    p = (dim_zone.select(F.col("zone_key").alias("_pk"),
                                          F.col("zone_code").alias("pickup_zone_code"),
                                          F.col("latitude").alias("pickup_latitude"),
                                          F.col("longitude").alias("pickup_longitude")))
    q = (dim_zone.select(F.col("zone_key").alias("_qk"),
                                          F.col("zone_code").alias("destination_zone_code"),
                                          F.col("latitude").alias("destination_latitude"),
                                          F.col("longitude").alias("destination_longitude")))
    f = fact.where(F.col(TARGET).isNotNull())
    j = (f.join(d, f["trip_booked_for_date_key"] == d["_dk"], "left")
         .join(p, f["pickup_zone_key"] == p["_pk"], "left")
         .join(q, f["destination_zone_key"] == q["_qk"], "left"))
    return j.select(*VIEW_COLUMNS)


def engineer(view: DataFrame) -> DataFrame:
    """FN14-18 in the reference's order: derive, then fill, so journey_urgency stays NULL
    where the dispatch-to-arrival time was unknown."""
    lat_delta = F.abs(F.col("pickup_latitude") - F.col("destination_latitude"))
    lon_delta = F.abs(F.col("pickup_longitude") - F.col("destination_longitude"))
    return view.select(
        *[c for c in VIEW_COLUMNS if c != "dispatch_to_arrival_minutes"],
        F.coalesce(F.col("dispatch_to_arrival_minutes"), F.lit(0.0))
        .alias("dispatch_to_arrival_minutes"),
        F.try_divide(F.col("fare_amount"), F.col("distance") + F.lit(1e-6)).alias("fare_per_distance"),
        F.col("expected_vs_actual_pickup_minutes_difference").alias("pickup_delay_signal"),
        (F.col("dispatch_to_arrival_minutes")
         + F.col("expected_vs_actual_pickup_minutes_difference")).alias("journey_urgency"),
        lat_delta.alias("lat_delta"),
        lon_delta.alias("lon_delta"),
        F.sqrt(lat_delta * lat_delta + lon_delta * lon_delta).alias("location_distance_proxy"),
    )


def in_range(c: str, lo: float, hi: float):
    """Exclusive range; NULL fails."""
    return F.coalesce((F.col(c) > lo) & (F.col(c) < hi), F.lit(False))


def feature_table(view: DataFrame) -> DataFrame:
    """ML1: engineer -> fill -> drop rows without destination coordinates -> outlier ranges."""
    e = engineer(view)
    e = e.where(F.col("destination_latitude").isNotNull() & F.col("destination_longitude").isNotNull())
    e = e.where(in_range(TARGET, 0, 120) & in_range("distance", 0, 200)
                & in_range("fare_amount", 0, 5000))
    return e.select("trip_key", "booking_id", *FEATURE_COLUMNS, TARGET)


def split_bucket(seed: int = 42):
    """0..99 from the first 32 bits of md5(booking_id:seed): a booking stays in its bucket whatever other
    trips arrive and however rows are partitioned. A NULL booking id counts as empty text."""
    digest = F.md5(F.concat(F.coalesce(F.col("booking_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(100)).cast("int")


def with_split(features: DataFrame, test_pct: int = 20, seed: int = 42) -> DataFrame:
    """ML3: 'test' for buckets below test_pct, 'train' otherwise."""
    return features.withColumn(
        "split", F.when(split_bucket(seed) < test_pct, F.lit("test")).otherwise(F.lit("train")))


def null_profile(df: DataFrame) -> DataFrame:
    """AGG25: NULL count per column, one pass, unpivoted to (column_name, null_count)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def exact_medians(df: DataFrame, columns: list[str], most: int = 100_000) -> DataFrame:
    """AGG27: exact median per column (mean of the two middle values for an even count), one row for
    each column that has values.

    One aggregate over all columns gives approximate quantiles close around the middle; a second one
    counts exactly what lies below and inside that bracket. A bracket that misses a middle rank is
    drawn wider, one with more than ``most`` different values narrower, until each is small. Only the
    values inside the brackets are then counted by value and ranked. Nothing is sorted as a whole.
    """
    spark, eps = df.sparkSession, dict.fromkeys(range(len(columns)), 2e-4)
    vals = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def counted(cols, cond):
        """(below, inside, different values inside) of each column, in one pass."""
        row = vals.agg(*[e for i in cols for e in (
            F.count_if(F.col(f"c{i}") < cond[i][0]), F.count_if(F.col(f"c{i}").between(*cond[i])),
            F.approx_count_distinct(F.when(F.col(f"c{i}").between(*cond[i]), F.col(f"c{i}"))))]).first()
        return {i: tuple(row[3 * j:3 * j + 3]) for j, i in enumerate(cols)}

    ends = vals.agg(*[e for i in range(len(columns)) for e in (F.min(f"c{i}"), F.max(f"c{i}"))]).first()
    bracket = {i: (ends[2 * i], ends[2 * i + 1]) for i in range(len(columns)) if ends[2 * i] is not None}
    if not bracket:
        return spark.createDataFrame([], "column_name string, median double")
    held = counted(list(bracket), bracket)
    ranks = {i: ((held[i][1] - 1) // 2, held[i][1] // 2) for i in bracket}
    wide = [i for i in bracket if held[i][2] > most]
    while wide:
        shares = {i: [min(1.0, max(0.0, (r - held[i][0] + side) / held[i][1] + sign * eps[i]))
                      for r, side, sign in zip(ranks[i], (0, 1), (-1, 1))] for i in wide}
        row = vals.agg(*[F.percentile_approx(F.when(F.col(f"c{i}").between(*bracket[i]), F.col(f"c{i}")), shares[i], 10_000)
                         for i in wide]).first()
        tried = {i: tuple(q) for i, q in zip(wide, row)}
        got, again = counted(wide, tried), []
        for i in wide:
            below, inside, different = got[i]
            if below <= ranks[i][0] and ranks[i][1] < below + inside:
                narrower = tried[i] != bracket[i]
                bracket[i], held[i] = tried[i], got[i]
                if different > most and narrower:
                    again.append(i)
            else:
                eps[i] *= 4
                again.append(i)
        wide = again
    inside = vals.select(F.explode(F.array(*[
        F.when(F.col(f"c{i}").between(*b), F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("value")))
        for i, b in bracket.items()])).alias("x")).where("x is not null").select("x.*")
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("value"))
    counts = inside.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    wanted = spark.createDataFrame([(i, columns[i], r - held[i][0]) for i in bracket for r in ranks[i]],
                                   "i int, column_name string, r long")  # two rows a column
    return (counts.join(F.broadcast(wanted), "i").where("r >= upto - n and r < upto")
            .groupBy("column_name").agg(F.avg("value").alias("median")))
