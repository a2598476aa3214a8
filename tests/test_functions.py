"""Scalar functions and small ordering operators."""

import datetime as dt

from pyspark.sql import functions as F

from ridemart.functions import expr as X
from ridemart.operators import analytics as A


def test_money_and_safe_divide(spark):
    df = spark.createDataFrame([(1234.5, 10, 0)], "x double, n long, z long")
    r = df.select(X.money("x").alias("m"), X.safe_divide("x", "z").alias("a"),
                  X.safe_divide("x", "n").alias("b")).first()
    assert r["m"] == "£1,234.50"
    assert r["a"] == 1234.5 and r["b"] == 123.45


def test_weekday_index_and_parsers(spark):
    df = spark.createDataFrame([("Monday", "16/08/2025 09:05", "1,234.50"),
                                ("Funday", "31/02/2026 10:00", "n/a")], "d string, t string, p string")
    rows = df.select(X.weekday_index("d").alias("i"), X.parse_ts("t").alias("ts"),
                     X.parse_number("p").alias("n")).collect()
    assert (rows[0]["i"], rows[0]["ts"], rows[0]["n"]) == (1, dt.datetime(2025, 8, 16, 9, 5), 1234.5)
    assert (rows[1]["i"], rows[1]["ts"], rows[1]["n"]) == (None, None, None)


def test_page_is_clamped_and_ordered(spark):
    rows = [(f"B{i}", dt.date(2025, 1, 1 + i % 28), "Monday", "Z1", "C", "cash", float(i), 1.0,
             2.0, "app", 1, i) for i in range(120)]
    schema = ("booking_id string, full_date date, day_name string, pickup_zone string, "
              "status string, payment_type string, fare_amount double, distance double, "
              "trip_duration_minutes double, booking_source string, priority_level int, trip_key long")
    details = spark.createDataFrame(rows, schema)
    last = A.page(details, page_no=99, page_size=50).collect()
    assert len(last) == 20 and last[0]["page"] == 3 and last[0]["total_pages"] == 3
    first = A.page(details, page_no=0, page_size=50).collect()
    assert first[0]["page"] == 1
    dates = [r["full_date"] for r in first]
    assert dates == sorted(dates, reverse=True)


def test_empty_filter_selection_is_no_filter(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 6), 20250106, 1, "cash", 3.0)],
                               "full_date date, date_key int, pickup_zone_key int, "
                               "payment_type string, fare_amount double")
    fact = df.select(F.col("date_key").alias("trip_booked_for_date_key"), "pickup_zone_key",
                     "payment_type", "fare_amount")
    dim_date = df.select("date_key", "full_date", F.lit("Monday").alias("day_name"))
    dim_zone = spark.createDataFrame([(1, "Z1")], "zone_key int, zone_code string")
    assert A.TripFilter().trips(fact, dim_date, dim_zone).count() == 1
    assert A.TripFilter(zones=("Z2",)).trips(fact, dim_date, dim_zone).count() == 0
    assert A.TripFilter(start="2025-01-07").trips(fact, dim_date, dim_zone).count() == 0


def test_pages_cut_the_newest_first_order(spark):
    rows = [(f"B{i}", None if i % 50 == 49 else dt.date(2025, 1, 1 + i % 28), "Monday", "Z1", "C", "cash", float(i), 1.0,
             2.0, "app", 1, i) for i in range(500)]
    schema = ("booking_id string, full_date date, day_name string, pickup_zone string, "
              "status string, payment_type string, fare_amount double, distance double, "
              "trip_duration_minutes double, booking_source string, priority_level int, trip_key long")
    details = spark.createDataFrame(rows, schema).repartition(4)
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or dt.date(1970, 1, 1)).toordinal(), r[-1]))]
    for page_no, held in ((1, 1), (4, 4), (10, 10), (99, 10), (-3, 1)):
        got = A.page(details, page_no, 50).collect()
        assert sorted(r.booking_id for r in got) == sorted(order[(held - 1) * 50:held * 50])
        assert {(r.page, r.total_pages) for r in got} == {(held, 10)}
    assert A.page(details.limit(0)).count() == 0
