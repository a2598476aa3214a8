"""Registered queries for ingest, streaming, quality, vector search and models.

Each one stages its inputs from the driver's tables into the shared checkpoint folder (CSV
landing files, time-ordered event slices), then runs the operator the way a deployment would:
files -> bronze -> silver, stream -> tile, silver -> quality report, and so on.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import quality as Q
from ridemart.operators import silver as S
from ridemart.operators import vector as V
from ridemart.operators import weather as W
from ridemart.plans import sql_views
from ridemart.plans.warehouse import AS_OF, warehouse
from ridemart.session import scratch_path
from ridemart.sources import files, testdata
from ridemart.sources.schemas import BOOKING_RAW_COLUMNS, CORRUPT_COLUMN, SILVER_SPEC
from ridemart.streaming import ingest, live

#: Compression of landed CSV files, and their names.
LANDED, LANDED_GLOB = "gzip", "*.csv.gz"

_LOCK = threading.RLock()
_STAGED: dict[tuple, str] = {}


def _tag(sf: str) -> str:
    return sf.rstrip("/").replace("/", "_").strip("_")


def _once(spark: SparkSession, key: str, sf: str, fn: Callable[[str], None]) -> str:
    """Run ``fn(path)`` once per session for (key, sf) and return the path."""
    k = (spark.sparkContext.applicationId, key, sf)
    with _LOCK:
        if k not in _STAGED:
            path = scratch_path(spark, "staging", _tag(sf), key)
            fn(path)
            _STAGED[k] = path
        return _STAGED[k]


def landing_bookings(spark: SparkSession, sf: str) -> str:
    """A landing folder of booking CSV files (22 columns) plus CSV files of another shape
    (3 columns), whose lines are malformed for the booking header; all gzipped, as raw files are kept. The booking text is
    staged on the way only where another query has done so."""
    def stage(path: str) -> None:
        held = _STAGED.get((spark.sparkContext.applicationId, "bronze_text", sf))
        files.export_csv(spark.read.parquet(held) if held else testdata.bookings_bronze_text(spark, sf), path, LANDED)
        files.export_csv(testdata.table(spark, sf, "events").select("event_id", "event_type", "value"), path, LANDED, "append")
    return _once(spark, "landing_bookings", sf, stage)


def bronze_text(spark: SparkSession, sf: str) -> str:
    """The raw booking text as a bronze Parquet table (all strings), staged once per session."""
    def stage(path: str) -> None:
        files.overwrite(testdata.bookings_bronze_text(spark, sf), path)
    return _once(spark, "bronze_text", sf, stage)


def bronze_batch(spark: SparkSession, sf: str) -> str:
    """SRC1 + SRC4 + SNK1: CSV landing -> bronze Parquet (created once, reruns are no-ops)."""
    def stage(path: str) -> None:
        landing = landing_bookings(spark, sf)
        raw = files.add_ingest_metadata(files.read_csv(spark, landing, BOOKING_RAW_COLUMNS))
        files.write_if_absent(raw, path)
    return _once(spark, "bronze_batch", sf, stage)


def bronze_stream_table(spark: SparkSession, sf: str) -> str:
    """SRC2 + SNK4: the same landing folder ingested as a file stream (availableNow)."""
    def stage(path: str) -> None:
        landing = landing_bookings(spark, sf)
        stream = ingest.bronze_stream(spark, landing, BOOKING_RAW_COLUMNS + [CORRUPT_COLUMN],
                                      glob=LANDED_GLOB)
        ingest.ingest_available(stream, f"{path}/table", f"{path}/_checkpoint")
    return _once(spark, "bronze_stream", sf, stage) + "/table"


def _good(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return files.split_malformed(ingest.read_bronze(spark, path))


def _md5_number(text) -> Column:
    """The first 32 bits of md5, which other SQL engines compute alike."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _mixed_bookings(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Bookings of two landing folders: one in the usual shape, one with its columns in reverse, a
    column more, and integers written with decimals. Bookings are dealt by a hash of their id."""
    raw = spark.read.parquet(bronze_text(spark, sf))
    late = _md5_number(F.col("`Booking ID`")) % 2 == 1
    whole = [raw_name for _, raw_name, kind in SILVER_SPEC if kind == "int"]
    odd = raw.where(late).select(*[
        F.when(F.col(f"`{c}`").rlike("^-?[0-9]+$"), F.concat(F.col(f"`{c}`"), F.lit(".0"))).otherwise(F.col(f"`{c}`")).alias(c)
        if c in whole else F.col(f"`{c}`") for c in reversed(raw.columns)], F.lit("call, first").alias("Driver Notes"))
    return {"first": raw.where(~late), "second": odd}


def landing_mixed(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The two landing folders of ``_mixed_bookings`` as CSV files."""
    def stage(path: str) -> None:
        for name, rows in _mixed_bookings(spark, sf).items():
            files.export_csv(rows, f"{path}/{name}", LANDED)
    path = _once(spark, "landing_mixed", sf, stage)
    return f"{path}/first", f"{path}/second"


def bronze_mixed(spark: SparkSession, sf: str) -> str:
    """SRC1: both folders as one batch."""
    def stage(path: str) -> None:
        raw = files.read_csv(spark, list(landing_mixed(spark, sf)), BOOKING_RAW_COLUMNS, glob=LANDED_GLOB)
        files.overwrite(files.add_ingest_metadata(raw), path)
    return _once(spark, "bronze_mixed", sf, stage)


def two_landings(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2 + SNK4: two files' worth of bookings landing one after the other, then a run that finds nothing
    new: rows appended by each run, and rows in the table."""
    def stage(path: str) -> None:
        landings, runs = _mixed_bookings(spark, sf), []
        for step in ("first", "second", None):
            if step is not None:  # lands where the stream looks, written once
                files.export_csv(landings[step], f"{path}/land/{step}")
            runs.append(ingest.ingest_available(ingest.bronze_stream(spark, f"{path}/land/*", BOOKING_RAW_COLUMNS, glob="*.csv"),
                                                f"{path}/table", f"{path}/_checkpoint"))
        spark.createDataFrame([(f"run_{i + 1}", n) for i, n in enumerate(runs)], "step string, rows long").write.parquet(f"{path}/runs")
    path = _once(spark, "two_landings", sf, stage)
    held = ingest.read_bronze(spark, f"{path}/table").agg(F.count(F.lit(1)).alias("rows"))
    return spark.read.parquet(f"{path}/runs").unionByName(held.select(F.lit("table").alias("step"), "rows"))


def appended_twice(spark: SparkSession, sf: str) -> DataFrame:
    """DQ7: a batch with repeated and NULL keys appended twice; rows before and after each run."""
    b = spark.read.parquet(bronze_text(spark, sf)).select(
        F.when(_md5_number(F.col("`Booking ID`")) % 7 != 0, F.col("`Booking ID`")).alias("booking_id"),
        F.col("Price").alias("price"), (_md5_number(F.concat(F.col("`Booking ID`"), F.lit(":held"))) % 2 == 0).alias("early"))
    held = b.where("early")
    base = files.append_new(held.limit(0), held, ["booking_id"])
    once = base.unionByName(files.append_new(base, b, ["booking_id"]))
    twice = files.append_new(once, b, ["booking_id"])
    parts = [("base", base), ("after_first", once), ("added_by_second", twice)]
    out = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("step"), "rows") for n, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def event_slices(spark: SparkSession, sf: str) -> str:
    """Events as a folder of Parquet files, each a range of event time: what the stream replays."""
    def stage(path: str) -> None:
        ev = testdata.table(spark, sf, "events").select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
        ev.repartitionByRange("ts", "event_id").write.mode("overwrite").parquet(path)
    return _once(spark, "event_slices", sf, stage)


def live_tile(spark: SparkSession, sf: str) -> DataFrame:
    """STR1: replay the events into the windowed tile."""
    src = event_slices(spark, sf)

    def run(path: str) -> None:
        schema = spark.read.parquet(src).schema
        stream = spark.readStream.schema(schema).parquet(src)
        live.run_tile(live.windowed_counts(stream), f"{path}/out", f"{path}/_checkpoint")
        live.compact_tile(spark, f"{path}/out", ["window_start", "event_type"])

    path = _once(spark, "tile", sf, run)
    tile = live.latest_tile(spark, f"{path}/out", ["window_start", "event_type"])
    return tile.select("window_start", "window_end", "event_type", "trips",
                       F.round("revenue", 2).alias("revenue"))


def late_tile(spark: SparkSession, sf: str) -> DataFrame:
    """STR1: four landings, an eighth of the events one landing late; what is counted and what came too late."""
    keys = ["window_start", "event_type"]

    def run(path: str) -> None:
        events = spark.read.parquet(event_slices(spark, sf))
        landing = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) + (F.col("event_id") % 8 == 0).cast("int")
        for n in range(4):
            events.where(landing == n).write.mode("append").parquet(f"{path}/src")
            stream = spark.readStream.schema(events.schema).parquet(f"{path}/src")
            live.run_counted_tile(stream, f"{path}/out", f"{path}/late", f"{path}/_checkpoint")
            if n == 1:
                live.compact_tile(spark, f"{path}/out", keys, live.summed_tile)

    path = _once(spark, "late_tile", sf, run)
    late = live.late_rows(spark, f"{path}/late").select(
        F.window("ts", "1 hour").start.alias("window_start"), "event_type", F.lit(0).alias("trips"),
        F.lit(0.0).alias("revenue"), F.lit(1).alias("late_rows"), F.col("value").alias("late_revenue"))
    tile = live.summed_tile(spark, f"{path}/out", keys).select(
        *keys, "trips", "revenue", F.lit(0).alias("late_rows"), F.lit(0.0).alias("late_revenue"))
    return tile.unionByName(late).groupBy(*keys).agg(
        F.sum("trips").alias("trips"), F.round(F.sum("revenue"), 2).alias("revenue"),
        F.sum("late_rows").alias("late_rows"), F.round(F.sum("late_revenue"), 2).alias("late_revenue"))


def _weather_deduped(spark: SparkSession, sf: str) -> DataFrame:
    return W.dedup_readings(W.parse_weather(testdata.weather_bronze(spark, sf)))


def _fact_year(spark: SparkSession, sf: str, year: int) -> DataFrame:
    wh = warehouse(spark, sf)
    d = wh["dim_date"].where(F.col("year") == year).select("date_key")
    f = wh["fact_trip"]
    return f.join(F.broadcast(d), f["trip_booked_for_date_key"] == d["date_key"], "left_semi")


PROFILE_COLUMNS = ["fare_amount", "distance", "trip_duration_minutes",
                   "expected_vs_actual_pickup_minutes_difference", "dispatch_to_arrival_minutes"]


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


def _model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    from ridemart.operators import features as FE
    from ridemart.operators import model as M
    wh = warehouse(spark, sf)
    feats = FE.with_split(FE.feature_table(
        FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])))
    train = feats.where(F.col("split") == "train")
    test = feats.where(F.col("split") == "test")
    return M.compare_models(train, test, runs_path=scratch_path(spark, "model_runs"))


def extracts(spark: SparkSession, sf: str) -> str:
    """SNK9: dashboard extracts of the orders warehouse, written once per session."""
    def stage(path: str) -> None:
        wh = warehouse(spark, sf)
        files.write_dashboard_extracts({t: wh[t] for t in wh.tables}, path)
    return _once(spark, "extracts", sf, stage)


def train_test_csv(spark: SparkSession, sf: str) -> str:
    """SNK6: train and test feature sets exported as header CSV folders."""
    from ridemart.operators import features as FE

    def stage(path: str) -> None:
        wh = warehouse(spark, sf)
        feats = FE.with_split(FE.feature_table(
            FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])))
        for part in ("train", "test"):
            files.export_csv(feats.where(F.col("split") == part).drop("split"), f"{path}/{part}")
    return _once(spark, "train_test_csv", sf, stage)


def _read_train_test(spark: SparkSession, sf: str) -> DataFrame:
    """SRC7: both CSV sets read back with the feature table's schema."""
    from ridemart.operators import features as FE
    wh = warehouse(spark, sf)
    schema = FE.feature_table(FE.trip_features_view(
        wh["fact_trip"], wh["dim_date"], wh["dim_zone"])).schema
    path = train_test_csv(spark, sf)
    parts = [spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
             .csv(f"{path}/{p}").withColumn("split", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


def landing_weather(spark: SparkSession, sf: str) -> str:
    """A landing folder of raw weather CSV files."""
    def stage(path: str) -> None:
        files.export_csv(testdata.weather_bronze(spark, sf), path, LANDED)
    return _once(spark, "landing_weather", sf, stage)


_FILE_WH: dict[tuple, object] = {}


def files_warehouse(spark: SparkSession, sf: str):
    """SNK5: the whole build from the two CSV landing folders (once per session)."""
    from ridemart.plans.build import build_from_files
    key = (spark.sparkContext.applicationId, sf)
    with _LOCK:
        if key not in _FILE_WH:
            root = scratch_path(spark, "staging", _tag(sf), "files_warehouse")
            _FILE_WH[key] = build_from_files(spark, landing_bookings(spark, sf),
                                             landing_weather(spark, sf), root, AS_OF["orders"])
        return _FILE_WH[key]


def _sql_question(name: str):
    source = "events" if name == "trips_per_hour_weekday" else "orders"
    return lambda s, sf: sql_views.saved_question(warehouse(s, sf, source), name)


EXTRA_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "PRJ1_bronze_text_to_silver": lambda s, sf: S.silver_taxi(
        s.read.parquet(bronze_text(s, sf)), AS_OF["orders"]),
    "SNK5_fact_from_files": lambda s, sf: files_warehouse(s, sf)["fact_trip"],
    "SNK7_feature_view_sql": lambda s, sf: sql_views.feature_view(warehouse(s, sf)),
    "DQ4_bronze_parse_report": lambda s, sf: Q.report(
        s.read.parquet(bronze_text(s, sf)), Q.bronze_parse_rules()),
    "AGG3_monthly_revenue_sql": _sql_question("monthly_revenue"),
    "AGG4_trips_per_hour_weekday_sql": _sql_question("trips_per_hour_weekday"),
    "AGG5_revenue_by_zone_payment_sql": _sql_question("revenue_by_zone_payment"),
    "AGG6_top_zones_sql": _sql_question("top_zones"),
    "AGG7_wait_by_weekday_sql": _sql_question("wait_by_weekday"),
    "SRC6_extract_daily_kpis": lambda s, sf: _r(
        files.read_extract(s, extracts(s, sf), "gold_daily_kpis"), {"total_revenue": 2}),
    "SRC6_extract_dim_zone": lambda s, sf: files.read_extract(s, extracts(s, sf), "dim_zone"),
    "SNK6_train_test_csv_roundtrip": lambda s, sf: _read_train_test(s, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("trip_duration_minutes"), 4).alias("avg_target")),
    "SRC1_csv_batch_to_silver": lambda s, sf: S.silver_taxi(
        _good(s, bronze_batch(s, sf))[0], AS_OF["orders"]),
    "DQ3_ingest_malformed_counts": lambda s, sf: s.read.parquet(bronze_batch(s, sf)).agg(
        F.count_if(F.col(CORRUPT_COLUMN).isNull()).alias("good_rows"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("malformed_rows")),
    "SRC2_stream_ingest_to_silver": lambda s, sf: S.silver_taxi(
        _good(s, bronze_stream_table(s, sf))[0], AS_OF["orders"]),
    "SRC1_mixed_headers_to_silver": lambda s, sf: S.silver_taxi(
        _good(s, bronze_mixed(s, sf))[0], AS_OF["orders"]),
    "SRC2_two_landings": two_landings,
    "DQ7_append_twice": appended_twice,
    "SNK8_build_summary": lambda s, sf: warehouse(s, sf).summary(),
    "DQ4_weather_quality_report": lambda s, sf: Q.report(_weather_deduped(s, sf), Q.weather_rules()),
    "DQ3_weather_quarantine": lambda s, sf: Q.apply_rules(
        _weather_deduped(s, sf), Q.weather_rules())[1],
    "DQ4_trip_quality_report": lambda s, sf: Q.report(
        warehouse(s, sf)["silver_taxi"], Q.silver_trip_rules()),
    "DQ5_fact_profile_drift": lambda s, sf: _r(Q.drift(
        Q.profile(_fact_year(s, sf, 1996), PROFILE_COLUMNS),
        Q.profile(_fact_year(s, sf, 1997), PROFILE_COLUMNS)),
        {"mean_before": 4, "mean_after": 4, "mean_shift_sd": 4, "null_rate_change": 6}),
    "DQ6_key_checks": lambda s, sf: Q.key_checks(
        warehouse(s, sf)["fact_trip"], warehouse(s, sf)["dim_date"], warehouse(s, sf)["dim_zone"]),
    "STR1_live_trip_tile": live_tile,
    "STR1_late_rows": late_tile,
    "VEC1_label_centroid_top10": lambda s, sf: _r(V.top_k(
        testdata.table(s, sf, "embeddings"), V.centroids(testdata.table(s, sf, "embeddings")), k=10),
        {"similarity": 4}),
    "SNK9_trip_sample": lambda s, sf: files.sample_by_hash(
        warehouse(s, sf)["fact_trip"], "booking_id", 10),
    "ML11_model_comparison": _model_comparison,
}
