"""Bronze ingest (batch + stream), metadata, sinks and the live tile."""

import os
import tempfile

from conftest import SF001, booking_row
from pyspark.sql import functions as F

from ridemart.operators.silver import parse_bronze
from ridemart.sources import files
from ridemart.sources.schemas import BOOKING_RAW_COLUMNS, CORRUPT_COLUMN, WEATHER_RAW_COLUMNS
from ridemart.streaming import ingest, live


def _tmp():
    return tempfile.mkdtemp(prefix="ridemart-test-", dir="/tmp")


def _write_csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for ln in lines:
            fh.write(ln + "\n")


def _line(row):
    return ",".join('"' + v + '"' if v is not None and "," in v else (v or "") for v in row)


def test_csv_batch_malformed_rows_are_quarantined(spark):
    d = _tmp()
    _write_csv(f"{d}/land/taxi_data.csv", BOOKING_RAW_COLUMNS,
               [_line(booking_row(**{"Booking ID": "B1", "Price": "1,234.50"})),
                "only,three,fields", _line(booking_row(**{"Booking ID": "B2"}))])
    raw = files.add_ingest_metadata(files.read_csv(spark, f"{d}/land", BOOKING_RAW_COLUMNS))
    assert files.write_if_absent(raw, f"{d}/bronze")
    assert not files.write_if_absent(raw, f"{d}/bronze")  # rerun is a no-op
    good, bad = files.split_malformed(spark.read.parquet(f"{d}/bronze"))
    assert sorted(r["Booking ID"] for r in good.collect()) == ["B1", "B2"]
    assert [r["raw_line"] for r in bad.collect()] == ["only,three,fields"]
    meta = spark.read.parquet(f"{d}/bronze").select("_ingest_timestamp", "_source_file").first()
    assert meta["_ingest_timestamp"] is not None and meta["_source_file"].endswith("taxi_data.csv")
    assert good.where(F.col("Price") == "1,234.50").count() == 1


def test_stream_ingest_equals_batch_and_second_run_adds_nothing(spark):
    d = _tmp()
    _write_csv(f"{d}/land/taxi_data.csv", BOOKING_RAW_COLUMNS,
               [_line(booking_row(**{"Booking ID": f"B{i}"})) for i in range(20)])
    _write_csv(f"{d}/land/other.txt", ["x"], ["ignored by the glob"])
    cols = BOOKING_RAW_COLUMNS + [CORRUPT_COLUMN]
    n1 = ingest.ingest_available(ingest.bronze_stream(spark, f"{d}/land", cols, glob="*.csv"),
                                 f"{d}/bronze", f"{d}/ckpt")
    n2 = ingest.ingest_available(ingest.bronze_stream(spark, f"{d}/land", cols, glob="*.csv"),
                                 f"{d}/bronze", f"{d}/ckpt")
    assert (n1, n2) == (20, 0)
    streamed = spark.read.parquet(f"{d}/bronze")
    batch = files.read_csv(spark, f"{d}/land", BOOKING_RAW_COLUMNS, glob="*.csv")
    key = ["Booking ID", "Price"]
    assert sorted(streamed.select(*key).collect()) == sorted(batch.select(*key).collect())


def test_columns_are_taken_by_header_name(spark):
    d = _tmp()
    row = dict(zip(BOOKING_RAW_COLUMNS, booking_row(**{"Booking ID": "B1", "Priority": "3.0", "Price": "7.5"})))
    _write_csv(f"{d}/land/a.csv", BOOKING_RAW_COLUMNS, [_line(booking_row(**{"Booking ID": "B0"}))])
    back = list(reversed(BOOKING_RAW_COLUMNS))
    _write_csv(f"{d}/land/b.csv", [*back, "Driver Notes"], [_line([*[row[c] for c in back], "late"]), "x,y"])
    _write_csv(f"{d}/land/c.csv", ["x", "y"], ["1,2", "3,4"])
    raw = files.read_csv(spark, f"{d}/land", BOOKING_RAW_COLUMNS)
    assert raw.columns[:len(BOOKING_RAW_COLUMNS)] == BOOKING_RAW_COLUMNS and "Driver Notes" in raw.columns
    files.overwrite(raw, f"{d}/bronze")
    good, bad = files.split_malformed(spark.read.parquet(f"{d}/bronze"))
    got = {r["Booking ID"]: r for r in good.collect()}
    assert set(got) == {"B0", "B1"} and got["B1"]["Price"] == "7.5"
    assert (got["B0"]["Driver Notes"], got["B1"]["Driver Notes"]) == (None, "late")
    assert sorted(r.raw_line for r in bad.collect()) == ["1,2", "3,4", "x,y"]
    silver = parse_bronze(good).where("booking_id = 'B1'").first()
    assert silver.priority == 3 and silver.price == 7.5


def test_weather_with_a_wider_file_loses_nothing(spark):
    d = _tmp()
    cols = WEATHER_RAW_COLUMNS
    line = {c: "10" for c in cols} | {cols[0]: "2025-01-01"}
    _write_csv(f"{d}/land/w.csv", [*cols, "station name"], [",".join([*(line[c] for c in cols), "north"])] * 2)
    files.overwrite(files.read_csv(spark, f"{d}/land", cols), f"{d}/bronze")
    good, bad = files.split_malformed(spark.read.parquet(f"{d}/bronze"))
    assert good.count() == 2 and bad.count() == 0 and {r["station name"] for r in good.collect()} == {"north"}


def test_second_landing_is_appended(spark):
    d = _tmp()
    for i, name in enumerate(["a", "b"]):
        _write_csv(f"{d}/land/{name}.csv", BOOKING_RAW_COLUMNS + ["extra"] * i,
                   [_line(booking_row(**{"Booking ID": f"{name}{k}"})) + ",e" * i for k in range(3)])
        land = ingest.bronze_stream(spark, f"{d}/land", BOOKING_RAW_COLUMNS)
        assert ingest.ingest_available(land, f"{d}/bronze", f"{d}/ckpt") == 3
    assert ingest.read_bronze(spark, f"{d}/bronze").count() == 6


def test_append_new_with_null_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c"), (None, "n"), (None, "m")], "k int, v string")
    added = files.append_new(old, new, ["k"])
    assert sorted(map(str, added.collect())) == sorted(["Row(k=2, v='c')", "Row(k=None, v='m')"])
    assert files.append_new(old.union(added), new, ["k"]).count() == 0


def test_normalise_names_and_append_new(spark):
    df = spark.createDataFrame([(1, "a")], "`loc id` int, `weather Desc` string")
    assert files.normalise_names(df).columns == ["loc_id", "weather_Desc"]
    old = spark.createDataFrame([(1,), (2,)], "k int")
    new = spark.createDataFrame([(2,), (3,)], "k int")
    assert [r.k for r in files.append_new(old, new, ["k"]).collect()] == [3]


def test_sample_by_hash_is_repeatable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = files.sample_by_hash(df, "k", 10)
    b = files.sample_by_hash(df.repartition(5), "k", 10)
    assert sorted(a.collect()) == sorted(b.collect())
    assert 100 < a.count() < 320


def test_live_tile_equals_batch_windows(spark):
    d = _tmp()
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    ordered = ev.orderBy("ts").collect()
    chunk = (len(ordered) + 3) // 4
    for i in range(4):
        part = ordered[i * chunk:(i + 1) * chunk]
        spark.createDataFrame(part, ev.schema).coalesce(1).write.mode("append").parquet(f"{d}/src")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/src")
    live.run_tile(live.windowed_counts(stream), f"{d}/out", f"{d}/ckpt")
    tile = live.latest_tile(spark, f"{d}/out", ["window_start", "event_type"])
    batch = ev.groupBy(F.window("ts", "1 hour").start.alias("window_start"), "event_type").agg(
        F.count("*").alias("trips"))
    got = sorted((r.window_start, r.event_type, r.trips) for r in tile.collect())
    want = sorted((r.window_start, r.event_type, r.trips) for r in batch.collect())
    assert got == want


def test_live_tile_drops_events_behind_the_watermark(spark):
    import datetime as dt
    d = _tmp()
    schema = "event_id long, ts timestamp, event_type string, value double"
    t0 = dt.datetime(2024, 1, 1, 0, 10)
    first = [(i, t0 + dt.timedelta(hours=i), "click", 1.0) for i in range(6)]  # up to 05:10
    fresh1 = [(101, t0 + dt.timedelta(hours=6), "click", 2.0)]
    late = [(100, t0, "click", 5.0)]                                            # 7 h behind
    fresh2 = [(102, t0 + dt.timedelta(hours=7), "click", 3.0)]
    # Spark filters late rows with the watermark of the previous micro-batch, so the late row
    # comes two batches after the ones that moved the watermark past its window.
    for rows in (first, fresh1, late + fresh2):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{d}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/src")
    live.run_tile(live.windowed_counts(stream, watermark="2 hours"), f"{d}/out", f"{d}/ckpt")
    tile = {r.window_start: (r.trips, r.revenue)
            for r in live.latest_tile(spark, f"{d}/out", ["window_start", "event_type"]).collect()}
    assert tile[dt.datetime(2024, 1, 1, 0, 0)] == (1, 1.0)   # the late event was not counted
    assert tile[dt.datetime(2024, 1, 1, 6, 0)] == (1, 2.0)
    assert tile[dt.datetime(2024, 1, 1, 7, 0)] == (1, 3.0)
    assert len(tile) == 8


def test_counted_tile_keeps_late_rows_in_a_side_table(spark):
    import datetime as dt
    d = _tmp()
    schema = "event_id long, ts timestamp, event_type string, value double"
    t0, keys = dt.datetime(2024, 1, 1, 0, 10), ["window_start", "event_type"]

    def at(hours):
        return t0 + dt.timedelta(hours=hours)

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{d}/src")
        live.run_counted_tile(stream, f"{d}/out", f"{d}/late", f"{d}/ckpt")

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{d}/src")
        run()

    def tile():
        return {(r.window_start.hour, r.event_type): (r.trips, r.revenue)
                for r in live.summed_tile(spark, f"{d}/out", keys).collect()}

    def late():
        return sorted((r.event_id, r.batch_id) for r in live.late_rows(spark, f"{d}/late").collect())

    land([(1, at(0), "a", 1.0), (2, at(5), "a", 2.0), (3, None, "a", 9.0), (4, at(0), None, None)])
    assert late() == [(3, 0)]  # no event time: no window
    assert tile() == {(0, "a"): (1, 1.0), (5, "a"): (1, 2.0), (0, None): (1, None)}
    live.compact_tile(spark, f"{d}/out", keys, live.summed_tile)
    # the mark is 05:10 less 2 h: the window 02:00 to 03:00 is over, 03:00 to 04:00 is open
    land([(5, at(2), "a", 4.0), (6, at(3), "a", 8.0), (7, at(5), "a", 16.0), (8, at(9), "b", 32.0)])
    want = {(0, "a"): (1, 1.0), (5, "a"): (2, 18.0), (0, None): (1, None), (3, "a"): (1, 8.0), (9, "b"): (1, 32.0)}
    assert late() == [(3, 0), (5, 1)] and tile() == want
    run()  # nothing new
    assert late() == [(3, 0), (5, 1)] and tile() == want
    live.compact_tile(spark, f"{d}/out", keys, live.summed_tile)
    assert tile() == want
    land([(9, at(5), "a", 64.0)])  # 05:00 to 06:00 is over now; a batch with late rows only
    assert late() == [(3, 0), (5, 1), (9, 2)] and tile() == want
    seen = sum(t for t, _ in tile().values()) + len(late())
    assert seen == 9  # every row is counted or in the side table


def test_counted_tile_replays_a_batch_with_the_same_result(spark):
    import datetime as dt
    d = _tmp()
    schema = "event_id long, ts timestamp, event_type string, value double"
    keys = ["window_start", "event_type"]

    def land(i, hour):
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1, hour, 30), "a", 1.0)], schema).coalesce(1).write.mode(
            "append").parquet(f"{d}/src")

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/src")
        live.run_counted_tile(stream, f"{d}/out", f"{d}/late", checkpoint)

    def state():
        return (sorted((r.window_start.hour, r.trips) for r in live.summed_tile(spark, f"{d}/out", keys).collect()),
                sorted(r.event_id for r in live.late_rows(spark, f"{d}/late").collect()))

    for i, hour in enumerate((10, 2, 11)):
        land(i, hour)
        run(f"{d}/ckpt")
    assert state() == ([(10, 1), (11, 1)], [1])
    run(f"{d}/lost")  # the checkpoint is gone: all batches come again
    assert state() == ([(10, 1), (11, 1)], [1])
