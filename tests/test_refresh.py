"""Refresh by date, checked writes, keyed appends and page selection on crafted data."""

import contextlib
import glob
import io
import os
import re
import tempfile

import pytest
from conftest import booking_row, bronze_df
from pyspark.sql import functions as F

from ridemart.operators import analytics as A
from ridemart.operators import quality as Q
from ridemart.operators import silver as S
from ridemart.operators import weather as W
from ridemart.plans import refresh as R
from ridemart.sources import files
from ridemart.sources.schemas import WEATHER_RAW_COLUMNS

AS_OF = "2026-01-01 00:00:00"


def _tmp():
    return tempfile.mkdtemp(prefix="ridemart-test-", dir="/tmp")


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def trip(bid, day, price="10.00", done="09:17", zone="Air37", **more):
    at = (lambda hm: f"{day}/08/2025 {hm}") if day else (lambda hm: "")
    return booking_row(**{"Booking ID": bid, "Price": price, "Pickup Due": at("09:00"), "Time Dispatched": at("08:50"), "Time Vehicle Arrived": at("08:58"),
                          "Time Picked Up": at("09:05"), "Completed": at(done), "Pickup Zone": zone, **more})


def typed(spark, rows):
    return S.parse_bronze(bronze_df(spark, rows))


@pytest.fixture(scope="module")
def weather(spark):
    raw = spark.createDataFrame([tuple({"date": "2025-08-16", "weatherDesc": "Sunny"}.get(c, "10") for c in WEATHER_RAW_COLUMNS)],
                                ", ".join(f"`{c}` string" for c in WEATHER_RAW_COLUMNS))
    return W.weather_daily(W.silver_weather(raw))


def stamps(root, name):
    return {f.split(f"/{name}/")[1]: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/{name}/{R.DATE}=*/*.parquet")}


def touched(before, after):
    return {f.split("/")[0].split("=")[1] for f, _ in set(before.items()) ^ set(after.items())}


def in_natural_keys(wh):
    zones = wh["dim_zone"]
    fact = wh["fact_trip"].join(zones.select(F.col("zone_key").alias("pickup_zone_key"), "zone_code"), "pickup_zone_key", "left")
    return {
        "fact": sorted(map(str, fact.select("booking_id", R.DATE, "zone_code", "fare_amount", "trip_key").collect())),
        "daily": sorted(map(str, wh["daily_kpis"].select("full_date", "day_name", "total_revenue", "total_trips").collect())),
        "zone": sorted(map(str, wh["zone_daily"].join(zones, F.col("pickup_zone_key") == F.col("zone_key"), "left")
                           .select(R.DATE, "zone_code", "total_revenue", "total_trips").collect())),
        "hourly": sorted(map(str, wh["hourly_trips"].select("trip_date", "hour_of_day", "trip_count").collect())),
        "dates": sorted(map(str, wh["dim_date"].select("date_key", "full_date", "day_name", "weather_desc").collect())),
        "zones": sorted(map(str, zones.select("zone_code", "latitude", "longitude").collect())),
    }


FIRST = [trip(f"A{i}", 10 + i % 5) for i in range(15)] + [trip("N1", None), trip("M1", 11), trip("L1", 20, price="7.00")]
SECOND = [trip("A0", 10, price="99.00", done="09:30"),   # a later version at the same date
          trip("A1", 11, price="1.00", done="09:10"),     # an earlier one, which changes nothing
          trip("M1", 12, done="10:00"),                   # moves from the 11th to the 12th
          trip("L1", 21, price="8.00", done="10:00"),     # the 20th loses its only trip
          trip("B1", 25, zone="Zzz9"), trip("N2", None)]


def test_a_second_batch_rewrites_only_its_dates(spark, weather):
    both = R.RefreshedWarehouse(spark, _tmp() + "/wh", weather)
    both.refresh(typed(spark, FIRST), AS_OF)
    held = {n: stamps(both.root, n) for n in R.PARTITIONED}
    keys = {r.booking_id: r.trip_key for r in both["fact_trip"].collect()}
    dates = both.refresh(typed(spark, SECOND), AS_OF)
    want = {None, 20250810, 20250811, 20250812, 20250820, 20250821, 20250825}
    assert set(dates) == want and len(dates) == len(want)
    for name in R.PARTITIONED:
        moved = touched(held[name], stamps(both.root, name))
        assert moved <= {"__HIVE_DEFAULT_PARTITION__" if d is None else str(d) for d in want}, name
        assert {"20250810", "20250812", "20250820", "20250825"} <= moved
    assert not glob.glob(f"{both.root}/*/{R.DATE}=20250820")  # its last trip has gone
    assert {b: k for b, k in keys.items() if b in ("A3", "A4", "A8")} == {
        r.booking_id: r.trip_key for r in both["fact_trip"].where("booking_id in ('A3', 'A4', 'A8')").collect()}
    full = R.RefreshedWarehouse(spark, _tmp() + "/wh", weather)
    full.refresh(typed(spark, FIRST + SECOND), AS_OF)
    assert in_natural_keys(both) == in_natural_keys(full)
    assert both["fact_trip"].select("trip_key").distinct().count() == both["fact_trip"].count()
    assert both.refresh(typed(spark, []), AS_OF) == []
    # the same batch again changes no row
    state = in_natural_keys(both)
    both.refresh(typed(spark, SECOND), AS_OF)
    assert in_natural_keys(both) == state


def test_a_refresh_that_breaks_a_rule_changes_nothing(spark, weather):
    wh = R.RefreshedWarehouse(spark, _tmp() + "/wh", weather)
    wh.refresh(typed(spark, FIRST), AS_OF)
    before = {n: stamps(wh.root, n) for n in R.PARTITIONED}
    with pytest.raises(Q.ExpectationFailed, match="fare_not_negative"):
        wh.refresh(typed(spark, [trip("X", 10, price="-1.00")]), AS_OF)
    assert {n: stamps(wh.root, n) for n in R.PARTITIONED} == before
    assert not glob.glob(f"{wh.root}/_staged/*")


def test_affected_dates_read_ids_and_dates_only(spark, weather):
    wh = R.RefreshedWarehouse(spark, _tmp() + "/wh", weather)
    wh.refresh(typed(spark, FIRST), AS_OF)
    held = wh["trips_latest"].where(R.on_dates([20250810, None]))
    assert re.search(r"PartitionFilters: \[[^\]]*20250810", plan_of(held, "formatted"))
    assert {r[0] for r in held.select(R.DATE).distinct().collect()} == {20250810, None}


def test_checked_write(spark):
    d, rules = _tmp(), [Q.Rule("k_present", F.col("k").isNotNull(), Q.FAIL), Q.Rule("v_small", F.col("v") < 10, Q.DROP),
                        Q.Rule("v_even", F.col("v") % 2 == 0)]
    rows = spark.createDataFrame([(1, 2), (2, 3), (3, 50), (4, None)], "k int, v int")
    counts = Q.checked_write(rows, f"{d}/t", rules, f"{d}/bad")
    assert counts == {"rows": 4, "k_present": 0, "v_small": 2, "v_even": 2}
    assert sorted(map(tuple, spark.read.parquet(f"{d}/t").collect())) == [(1, 2), (2, 3)]
    assert sorted((r.k, r.reasons) for r in spark.read.parquet(f"{d}/bad").collect()) == [(3, "v_small"), (4, "v_small,v_even")]
    kept = sorted(os.listdir(f"{d}/t"))
    with pytest.raises(Q.ExpectationFailed, match="'k_present': 1"):
        Q.checked_write(rows.union(spark.createDataFrame([(None, 1)], rows.schema)), f"{d}/t", rules, f"{d}/bad")
    assert sorted(os.listdir(f"{d}/t")) == kept and sorted(os.listdir(d)) == ["bad", "t"]  # nothing half-written is left
    assert Q.checked_write(rows.limit(0), f"{d}/t", rules, f"{d}/bad")["rows"] == 0
    assert spark.read.parquet(f"{d}/t").count() == spark.read.parquet(f"{d}/bad").count() == 0


def test_a_job_that_fails_while_writing_leaves_the_table(spark):
    d = _tmp()
    Q.checked_write(spark.range(5).toDF("k"), f"{d}/t", [])
    with pytest.raises(Exception, match="broken"):
        Q.checked_write(spark.range(50).select(F.when(F.col("id") < 40, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("k")), f"{d}/t", [])
    assert spark.read.parquet(f"{d}/t").count() == 5


def test_keyed_append_meets_the_held_table_where_it_is(spark):
    d, table = _tmp(), "keyed_" + os.urandom(6).hex()
    old = spark.createDataFrame([(i, "a", float(i)) for i in range(200)] + [(None, "a", 0.0), (7, None, 0.0)], "k int, s string, v double")
    new = spark.createDataFrame([(i, "a", -1.0) for i in range(150, 260)] + [(None, "a", 5.0), (7, None, 5.0), (None, None, 1.0), (None, None, 2.0),
                                                                             (300, "b", 1.0), (300, "b", 2.0)], old.schema)
    assert files.append_keyed(spark, table, f"{d}/t", old, ["k", "s"], 4) == 202
    assert files.append_keyed(spark, table, f"{d}/t", new, ["k", "s"], 4) == 62
    assert files.append_keyed(spark, table, f"{d}/t", new, ["k", "s"], 4) == 0
    got = spark.table(table)
    assert got.count() == 264 and got.where("v = -1.0").count() == 60 and got.where("k = 300").first().v == 1.0
    lines = plan_of(files._unheld(spark.table(table), new, ["k", "s"])).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above, joined = depth(lines[at]), False
    for line in reversed(lines[:at]):  # from the held scan up to the join
        if depth(line) < above and not joined:
            above, joined = depth(line), "SortMergeJoin" in line
            assert "Exchange" not in line
    assert joined


def test_a_page_in_the_middle_of_a_hot_date_reads_one_range(spark):
    n = 100_000
    d = _tmp()
    rows = spark.range(n).select(F.lit("2025-08-16").cast("date").alias("full_date"), (F.col("id") * 3 + 1_000_000_007).alias("trip_key"),
                                 *[F.col("id").cast("string").alias(c) for c in A.DETAIL_COLUMNS if c != "full_date"])
    more = spark.range(30).select(F.lit(None).cast("date").alias("full_date"), F.col("id").alias("trip_key"),
                                  *[F.col("id").cast("string").alias(c) for c in A.DETAIL_COLUMNS if c != "full_date"])
    rows.unionByName(more).repartitionByRange(8, "trip_key").write.parquet(f"{d}/t")
    details = spark.read.parquet(f"{d}/t")
    got = [int(r.booking_id) for r in A.page(details, 1001, 50).collect()]
    assert got == list(range(50_000, 50_050))
    part, skip = A.select_places(details.where("full_date = date'2025-08-16'"), "trip_key", 50_000, 50)
    assert part.count() <= 10_000 and skip < 10_000
    assert "GreaterThanOrEqual(trip_key" in plan_of(part, "formatted")
    # the last page crosses into the rows without a date
    assert [(r.full_date is None, int(r.booking_id)) for r in A.page(details, 2001, 50).collect()] == [(True, i) for i in range(30)]
    both = A.page(details, 1, 7).collect() + A.page(details, 10 ** 9, 7).collect()
    assert [int(r.booking_id) for r in both[:7]] == list(range(7)) and both[-1].page == both[-1].total_pages


def test_places_of_crowded_keys(spark):
    """All rows at one end of a wide key space: ranges are narrowed again and again."""
    keys = spark.range(3000).select(F.when(F.col("id") < 2990, F.col("id")).otherwise(F.col("id") + 10 ** 15).alias("trip_key"))
    for skip in (0, 1500, 2985, 2999):
        part, ahead = A.select_places(keys, "trip_key", skip, 5, most=50, ranges=16)
        want = [r[0] for r in keys.orderBy("trip_key").offset(skip).limit(5).collect()]
        assert [r[0] for r in part.orderBy("trip_key").offset(ahead).limit(5).collect()] == want
        assert part.count() <= 400
