"""Analytical queries on the star schema.

* saved SQL questions (AGG3-7), written against the final gold schema: the booked-for date key
  joins dim_date, and "wait time" is expected_vs_actual_pickup_minutes_difference (picked up
  minus due), the only wait measure the fact has;
* dashboard aggregates (AGG8-22, FLT9-14, ORD2-5) with a ``TripFilter`` that applies each
  selection only where the dashboard applies it (FLT13);
* named business questions (BQ1-7).

pandas-origin operators keep pandas semantics explicitly: NULL group keys are dropped and a
sum over nothing is 0. Orderings that feed a limit or a rank carry a tie-breaker. Where an
order is part of the answer (weekday or weather-group order), it is returned as an index column
so it survives writing and comparison.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.functions import expr as X


# ---------------------------------------------------------------------------- filters (FLT9-13)

@dataclass(frozen=True)
class TripFilter:
    """Dashboard selections. An empty selection means "no filter" (FLT10)."""

    start: dt.date | str | None = None
    end: dt.date | str | None = None
    days: tuple[str, ...] = ()
    zones: tuple[str, ...] = ()
    payment_types: tuple[str, ...] = ()
    hours: tuple[int, ...] = ()
    weather: tuple[str, ...] = ()

    def _dates(self, c):
        cond = F.lit(True)
        if self.start is not None:
            cond = cond & (c >= F.lit(str(self.start)).cast("date"))
        if self.end is not None:
            cond = cond & (c <= F.lit(str(self.end)).cast("date"))
        return cond

    def key_range(self, key: str = "trip_booked_for_date_key"):
        """The date range as a predicate on a yyyyMMdd key column of the fact. Equivalent to the
        full_date range (the key is monotonic in the date) but it reaches the fact's Parquet
        scan, where date-clustered files are skipped by their statistics."""
        cond = F.lit(True)
        if self.start is not None:
            cond = cond & (F.col(key) >= X.date_key(F.lit(str(self.start)).cast("date")))
        if self.end is not None:
            cond = cond & (F.col(key) <= X.date_key(F.lit(str(self.end)).cast("date")))
        return cond

    def trips(self, fact: DataFrame, dim_date: DataFrame, dim_zone: DataFrame) -> DataFrame:
        """Trips with full_date/day_name; date, day, zone and payment selections (FLT9-10)."""
        d = dim_date.select("date_key", "full_date", "day_name")
        fact = fact.where(self.key_range())
        t = fact.join(d, fact["trip_booked_for_date_key"] == d["date_key"], "inner").drop("date_key")
        t = t.where(self._dates(F.col("full_date")))
        if self.days:
            t = t.where(F.col("day_name").isin(list(self.days)))
        if self.zones:
            t = t.join(_zone_keys(dim_zone, self.zones, "pickup_zone_key"), "pickup_zone_key",
                       "left_semi")
        if self.payment_types:
            t = t.where(F.col("payment_type").isin(list(self.payment_types)))
        return t

    def zone_days(self, zone_daily: DataFrame, dim_date: DataFrame, dim_zone: DataFrame) -> DataFrame:
        """Zone-daily rows; date, day and zone selections (no payment: the mart has none)."""
        d = dim_date.select("date_key", "full_date", "day_name")
        z = zone_daily.join(d, zone_daily["trip_booked_for_date_key"] == d["date_key"], "inner")
        z = z.where(self._dates(F.col("full_date")))
        if self.days:
            z = z.where(F.col("day_name").isin(list(self.days)))
        if self.zones:
            z = z.join(_zone_keys(dim_zone, self.zones, "pickup_zone_key"), "pickup_zone_key",
                       "left_semi")
        return z

    def hourly(self, hourly_trips: DataFrame, dim_date: DataFrame) -> DataFrame:
        """Hourly rows; date, day, hour and weather selections (weather through dim_date, FLT11)."""
        h = hourly_trips.where(self._dates(F.col("trip_date")))
        if self.days:
            h = h.where(F.col("day_name").isin(list(self.days)))
        if self.hours:
            h = h.where(F.col("hour_of_day").isin(list(self.hours)))
        if self.weather:
            wd = (dim_date.where(F.col("weather_desc").isin(list(self.weather)))
                                   .select(F.col("full_date").alias("trip_date")))
            h = h.join(wd, "trip_date", "left_semi")
        return h

    def weather_days(self, daily_kpis: DataFrame, dim_date: DataFrame) -> DataFrame:
        """Daily KPIs with the day's weather; days without weather dropped (JN8)."""
        w = (dim_date.select(
            "full_date", "avg_temp_c", "total_precip_mm", "avg_wind_speed_kmph", "avg_humidity",
            "weather_desc"))
        k = daily_kpis.join(w, "full_date", "inner").where(F.col("avg_temp_c").isNotNull())
        k = k.where(self._dates(F.col("full_date")))
        if self.days:
            k = k.where(F.col("day_name").isin(list(self.days)))
        if self.weather:
            k = k.where(F.col("weather_desc").isin(list(self.weather)))
        return k


def _zone_keys(dim_zone: DataFrame, zones, key_name: str) -> DataFrame:
    return (dim_zone.where(F.col("zone_code").isin(list(zones)))
                             .select(F.col("zone_key").alias(key_name)))


def _zone_lookup(dim_zone: DataFrame) -> DataFrame:
    return (dim_zone.select(F.col("zone_key").alias("pickup_zone_key"),
                                             "zone_code"))


def _sum0(c: str) -> F.Column:
    """pandas sum: NULLs skipped, nothing to add gives 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


# ------------------------------------------------------------------- saved SQL questions (AGG3-7)

def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AGG3: revenue and trips per (year, month_name, month); pre-aggregated on the date key."""
    per_key = fact.groupBy("trip_booked_for_date_key").agg(
        F.sum("fare_amount").alias("rev"), F.count("trip_key").alias("n"))
    d = dim_date.select("date_key", "year", "month_name", "month")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return j.groupBy("year", "month_name", "month").agg(
        F.sum("rev").alias("total_revenue"), F.sum("n").alias("total_trips"))


def trips_per_hour_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AGG4: number of trips per (pickup hour, day_name)."""
    per_key = fact.groupBy("trip_booked_for_date_key",
                           F.hour("pickup_due_timestamp").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("n"))
    d = dim_date.select("date_key", "day_name")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return j.groupBy("pickup_hour", "day_name").agg(F.sum("n").alias("num_trips"))


def revenue_by_zone_payment(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """AGG5: revenue per (pickup zone_code, payment_type)."""
    per_key = fact.groupBy("pickup_zone_key", "payment_type").agg(
        F.sum("fare_amount").alias("revenue"))
    j = per_key.join(_zone_lookup(dim_zone), "pickup_zone_key", "inner")
    return j.groupBy("zone_code", "payment_type").agg(F.sum("revenue").alias("revenue"))


def top_zones(fact: DataFrame, dim_zone: DataFrame, k: int = 15) -> DataFrame:
    """AGG6: trips and revenue per pickup zone, top k by revenue (ties by zone code)."""
    per_key = fact.groupBy("pickup_zone_key").agg(
        F.count("trip_key").alias("trips"), F.sum("fare_amount").alias("revenue"))
    j = per_key.join(_zone_lookup(dim_zone), "pickup_zone_key", "inner")
    agg = j.groupBy(F.col("zone_code").alias("pickup_zone")).agg(
        F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"))
    return agg.orderBy(F.col("revenue").desc_nulls_last(), F.col("pickup_zone")).limit(k)


def wait_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AGG7: avg wait (picked up - due) and avg duration per day_name, where wait is known."""
    w = fact.where(F.col("expected_vs_actual_pickup_minutes_difference").isNotNull())
    per_key = w.groupBy("trip_booked_for_date_key").agg(
        F.sum("expected_vs_actual_pickup_minutes_difference").alias("ws"),
        F.count("expected_vs_actual_pickup_minutes_difference").alias("wn"),
        F.sum("trip_duration_minutes").alias("ds"),
        F.count("trip_duration_minutes").alias("dn"))
    d = dim_date.select("date_key", "day_name")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return j.groupBy("day_name").agg(
        F.round(F.sum("ws") / F.sum("wn"), 2).alias("avg_wait_min"),
        F.round(F.sum("ds") / F.sum("dn"), 2).alias("avg_trip_duration"))


# ----------------------------------------------------------------- dashboard (AGG8-22, FLT14, ORD5)

def kpi_cards(trips: DataFrame) -> DataFrame:
    """AGG8: revenue (0 when empty), trips, mean duration and distance (NULL when empty)."""
    return trips.agg(
        _sum0("fare_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("trip_duration_minutes").alias("avg_duration_min"),
        F.avg("distance").alias("avg_distance_km"),
    )


def monthly_revenue_trend(trips: DataFrame) -> DataFrame:
    """AGG9: revenue per calendar month, years merged."""
    return trips.groupBy(F.month("full_date").alias("month_num"),
                         X.month_name("full_date").alias("month_name")).agg(
        _sum0("fare_amount").alias("revenue"))


def top_zones_by_revenue(trips: DataFrame, dim_zone: DataFrame, k: int = 15) -> DataFrame:
    """AGG10: top k pickup zones by revenue of the filtered trips (ties by zone code)."""
    per_key = trips.groupBy("pickup_zone_key").agg(F.sum("fare_amount").alias("r"))
    j = per_key.join(_zone_lookup(dim_zone), "pickup_zone_key", "inner")
    agg = j.groupBy("zone_code").agg(_sum0("r").alias("revenue"))
    return agg.orderBy(F.col("revenue").desc(), F.col("zone_code")).limit(k)


def duration_by_weekday(trips: DataFrame) -> DataFrame:
    """AGG11: mean trip duration per weekday, with the calendar position (ORD3)."""
    return trips.where(F.col("day_name").isNotNull()).groupBy("day_name").agg(
        F.avg("trip_duration_minutes").alias("avg_duration_min")
    ).withColumn("day_index", X.weekday_index("day_name"))


def revenue_zone_payment_top(trips: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    """AGG12: revenue per (zone, payment type), only for the k zones with the highest total."""
    per_key = (trips.where(F.col("payment_type").isNotNull())
               .groupBy("pickup_zone_key", "payment_type").agg(F.sum("fare_amount").alias("r")))
    j = per_key.join(_zone_lookup(dim_zone), "pickup_zone_key", "inner")
    by_pair = j.groupBy("zone_code", "payment_type").agg(_sum0("r").alias("revenue"))
    top = (by_pair.groupBy("zone_code").agg(F.sum("revenue").alias("t"))
           .orderBy(F.col("t").desc(), F.col("zone_code")).limit(k).select("zone_code"))
    return by_pair.join(F.broadcast(top), "zone_code", "left_semi")


def zone_revenue_map(zone_days: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """AGG13-14: revenue, trips and revenue per trip (0 trips counted as 1) per pickup zone."""
    per_key = zone_days.where(F.col("pickup_zone_key").isNotNull()).groupBy("pickup_zone_key").agg(
        _sum0("total_revenue").alias("total_revenue"),
        F.sum("total_trips").alias("total_trips"))
    z = (dim_zone.select(F.col("zone_key").alias("pickup_zone_key"),
                                          "zone_code", "latitude", "longitude"))
    j = per_key.join(z, "pickup_zone_key", "inner")
    return j.select("pickup_zone_key", "zone_code", "latitude", "longitude", "total_revenue",
                    "total_trips",
                    X.safe_divide("total_revenue", "total_trips").alias("revenue_per_trip"))


def zone_revenue_summary(zone_map: DataFrame) -> DataFrame:
    """AGG15: zone and revenue, highest first."""
    return zone_map.select("zone_code", "total_revenue").orderBy(
        F.col("total_revenue").desc(), F.col("zone_code"))


def hourly_by_day(hourly: DataFrame) -> DataFrame:
    """AGG16: trips per (hour, weekday) summed over dates."""
    return hourly.groupBy("hour_of_day", "day_name").agg(
        F.sum("trip_count").alias("trip_count")
    ).withColumn("day_index", X.weekday_index("day_name"))


def _heatmap(hourly: DataFrame, fn) -> DataFrame:
    piv = hourly.groupBy("day_name").pivot("hour_of_day", list(range(24))).agg(fn("trip_count"))
    return piv.select("day_name", X.weekday_index("day_name").alias("day_index"),
                      *[F.col(str(h)).cast("double").alias(f"h{h:02d}") for h in range(24)])


def avg_trips_heatmap(hourly: DataFrame) -> DataFrame:
    """AGG17: mean trips per (weekday, hour) over the dates that had trips in that hour."""
    return _heatmap(hourly, F.avg)


def total_trips_heatmap(hourly: DataFrame) -> DataFrame:
    """AGG18: total trips per (weekday, hour)."""
    return _heatmap(hourly, F.sum)


def weather_avg_daily_trips(weather_days: DataFrame, min_days: int = 3) -> DataFrame:
    """AGG19: mean daily trips and day count per weather description, >= min_days days."""
    return (weather_days.where(F.col("weather_desc").isNotNull()).groupBy("weather_desc")
            .agg(F.avg("total_trips").alias("avg_trips"),
                 F.count("total_trips").alias("count_days"))
            .where(F.col("count_days") >= min_days))


def trips_by_day_weather_group(weather_days: DataFrame) -> DataFrame:
    """AGG20: total trips per (weekday, weather group)."""
    g = weather_days.withColumn("weather_group", X.weather_group("weather_desc"))
    return (g.groupBy("day_name", "weather_group").agg(F.sum("total_trips").alias("total_trips"))
            .withColumn("day_index", X.weekday_index("day_name"))
            .withColumn("group_index", X.weather_group_index("weather_group")))


def revenue_by_weather_group(weather_days: DataFrame) -> DataFrame:
    """AGG21: mean daily revenue per weather group."""
    g = weather_days.withColumn("weather_group", X.weather_group("weather_desc"))
    return (g.groupBy("weather_group").agg(F.avg("total_revenue").alias("avg_daily_revenue"))
            .withColumn("group_index", X.weather_group_index("weather_group")))


def duration_by_weather(weather_days: DataFrame, min_days: int = 3) -> DataFrame:
    """AGG22: unweighted mean of the daily average durations per description, >= min_days
    days with a known average."""
    return (weather_days.where(F.col("weather_desc").isNotNull()).groupBy("weather_desc")
            .agg(F.avg("avg_trip_duration_min").alias("avg_duration"),
                 F.count("avg_trip_duration_min").alias("count_days"))
            .where(F.col("count_days") >= min_days))


def date_range(dim_date: DataFrame) -> DataFrame:
    """AGG26: first and last calendar date."""
    return dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def filter_options(dim_date: DataFrame, dim_zone: DataFrame, fact: DataFrame) -> DataFrame:
    """FLT14: the dashboard's option lists as (option, value, position) rows, weekdays from Monday and all
    others in the order of their values; NULLs dropped."""
    spark = fact.sparkSession

    def opts(df: DataFrame, c: str, name: str) -> DataFrame:
        return (df.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("value"))
                .distinct().withColumn("option", F.lit(name)))

    hours = spark.range(24).select(F.format_string("%02d:00", F.col("id")).alias("value"),
                                   F.lit("hour").alias("option"))
    days = spark.createDataFrame([(d,) for d in X.WEEKDAYS], "value string").withColumn(
        "option", F.lit("day"))
    bounds = date_range(dim_date)
    dates = bounds.select(F.col("min_date").cast("string").alias("value"),
                          F.lit("min_date").alias("option")).unionByName(
        bounds.select(F.col("max_date").cast("string").alias("value"),
                      F.lit("max_date").alias("option")))
    allopts = (opts(dim_zone, "zone_code", "zone").unionByName(opts(fact, "payment_type", "payment"))
               .unionByName(opts(dim_date, "weather_desc", "weather")).unionByName(hours)
               .unionByName(days).unionByName(dates))
    weekday = F.array_position(F.array(*[F.lit(d) for d in X.WEEKDAYS]), F.col("value"))
    order = Window.partitionBy("option").orderBy(F.when(F.col("option") == "day", weekday), "value")
    return allopts.select("option", "value", F.row_number().over(order).alias("position"))


def with_position(answer: DataFrame, *order: Column) -> DataFrame:
    """ORD1: a question's answer (a few rows per key) with each row's place in its order, from 1."""
    return answer.withColumn("position", F.row_number().over(Window.orderBy(*order)))


DETAIL_COLUMNS = ["booking_id", "full_date", "day_name", "pickup_zone", "status", "payment_type",
                  "fare_amount", "distance", "trip_duration_minutes", "booking_source",
                  "priority_level"]


def trip_details(trips: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """BQ7: the 11-column filtered trip table (newest first when ordered by ``page``)."""
    j = trips.join(_zone_lookup(dim_zone), "pickup_zone_key", "left")
    return j.select(*[F.col("zone_code").alias("pickup_zone") if c == "pickup_zone" else F.col(c)
                      for c in DETAIL_COLUMNS] + ["trip_key"])


def select_places(rows: DataFrame, key: str, skip: int, take: int, most: int = 10_000, ranges: int = 1024) -> tuple[DataFrame, int]:
    """Rows that hold the places ``skip`` to ``skip + take - 1`` in the order of an integer ``key``, and how many rows of
    them come before. Ranges of equal width are counted (at most ``ranges`` small rows) and only those with the wanted places
    are kept, again and again until at most ``most`` rows are left, so nothing is sorted as a whole; the kept range is
    a filter on ``key`` that reaches the scan."""
    while True:
        low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        if n <= most or low == high:
            return rows, skip
        width = -(-(high - low + 1) // ranges)
        place = ((F.col(key) - F.lit(low)) / width).cast("long")
        counts = sorted((r[0], r[1]) for r in rows.groupBy(place.alias("range")).count().collect())
        before, kept, passed = 0, [], 0
        for at, held in counts:
            if passed + held <= skip:
                before = passed + held
            elif passed < skip + take:
                kept.append(at)
            passed += held
        narrower = rows.where(F.col(key).between(low + kept[0] * width, low + (kept[-1] + 1) * width - 1)) if kept else rows
        if not kept or len(kept) == len(counts):
            return narrower, skip - before
        rows, skip = narrower, skip - before


def page(details: DataFrame, page_no: int = 1, page_size: int = 50) -> DataFrame:
    """ORD5: one page of the detail table, newest first, ties by trip_key; the page number is
    clamped to [1, total_pages].

    Row counts by date (one small row per date) tell which dates the page lies in, and counts of key ranges which rows of a
    date; only these are ordered, so the work does not grow with the depth of the page or the size of a date.
    """
    by_date = details.groupBy("full_date").count().orderBy(F.col("full_date").desc_nulls_last()).collect()
    total = sum(r["count"] for r in by_date)
    total_pages = max(1, (total + page_size - 1) // page_size)
    p = min(max(1, page_no), total_pages)
    start, before, parts, skip = (p - 1) * page_size, 0, [], 0
    for day, n in by_date:
        first, last = max(0, start - before), min(n, start + page_size - before)
        if first < last:
            own = details.where(F.col("full_date").isNull() if day is None else F.col("full_date") == F.lit(day))
            part, ahead = select_places(own, "trip_key", first, last - first)
            parts.append(part)
            skip += ahead  # only the first date of a page has rows before it
        before += n
    out = (reduce(DataFrame.unionByName, parts) if parts else details.limit(0))
    out = out.orderBy(F.col("full_date").desc_nulls_last(), F.col("trip_key").asc()).offset(skip).limit(page_size)
    return out.select(*DETAIL_COLUMNS, F.lit(p).alias("page"),
                      F.lit(total_pages).alias("total_pages"))


# ------------------------------------------------------------------- business questions (BQ1-6)

def revenue_last_week(fact: DataFrame, dim_date: DataFrame, as_of) -> DataFrame:
    """BQ1: revenue and trips over the seven days before ``as_of``'s date."""
    end = F.to_date(F.lit(str(as_of)).cast("timestamp"))
    d = (dim_date.where((F.col("full_date") >= F.date_sub(end, 7))
                                         & (F.col("full_date") < end)).select("date_key"))
    k = F.col("trip_booked_for_date_key")  # same range on the fact's key: reaches its scan
    f = fact.where((k >= X.date_key(F.date_sub(end, 7))) & (k < X.date_key(end)))
    t = f.join(d, f["trip_booked_for_date_key"] == d["date_key"], "left_semi")
    return t.agg(_sum0("fare_amount").alias("total_revenue"),
                 F.count(F.lit(1)).alias("total_trips")).select(
        F.date_sub(end, 7).alias("week_start"), F.date_sub(end, 1).alias("week_end"),
        "total_revenue", "total_trips")


def zones_most_trips(fact: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    """BQ2: pickup zones with the most trips (ties by zone code)."""
    per_key = fact.groupBy("pickup_zone_key").agg(F.count(F.lit(1)).alias("trips"),
                                                  F.sum("fare_amount").alias("revenue"))
    j = per_key.join(_zone_lookup(dim_zone), "pickup_zone_key", "inner")
    return (j.select(F.col("zone_code").alias("pickup_zone"), "trips", "revenue")
            .orderBy(F.col("trips").desc(), F.col("pickup_zone")).limit(k))


def weather_duration_effect(fact: DataFrame, dim_date: DataFrame, daily_kpis: DataFrame) -> DataFrame:
    """BQ3: per weather description, the mean of daily average durations (AGG22 semantics)
    next to the trip-weighted mean duration."""
    per_key = fact.groupBy("trip_booked_for_date_key").agg(
        F.sum("trip_duration_minutes").alias("ds"), F.count("trip_duration_minutes").alias("dn"))
    d = (dim_date.where(F.col("weather_desc").isNotNull())
                          .select("date_key", "full_date", "weather_desc"))
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    j = j.join(daily_kpis.select("full_date", "avg_trip_duration_min"), "full_date", "inner")
    return j.groupBy("weather_desc").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("dn").alias("trips_with_duration"),
        F.avg("avg_trip_duration_min").alias("mean_of_daily_avg_duration"),
        (F.sum("ds") / F.sum("dn")).alias("trip_weighted_avg_duration"))


def avg_fare_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """BQ4: mean fare per weekday."""
    per_key = fact.groupBy("trip_booked_for_date_key").agg(
        F.sum("fare_amount").alias("s"), F.count("fare_amount").alias("n"))
    d = dim_date.select("date_key", "day_name")
    j = per_key.join(d, per_key["trip_booked_for_date_key"] == d["date_key"], "inner")
    return (j.groupBy("day_name").agg((F.sum("s") / F.sum("n")).alias("avg_fare"))
            .withColumn("day_index", X.weekday_index("day_name")))


def busiest_hour_per_weekday(per_hour_day: DataFrame) -> DataFrame:
    """BQ5: for each weekday, the hour with the most trips (ties: earliest hour)."""
    w = Window.partitionBy("day_name").orderBy(F.col("num_trips").desc(), F.col("pickup_hour"))
    return (per_hour_day.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .drop("_rn").withColumn("day_index", X.weekday_index("day_name")))


def busiest_hour_overall(per_hour_day: DataFrame) -> DataFrame:
    """BQ5 (first form): the hour of the day with the most trips over all weekdays (ties:
    earliest hour). The input is AGG4's (hour, weekday) counts: at most 168 rows."""
    per_hour = per_hour_day.groupBy("pickup_hour").agg(F.sum("num_trips").alias("num_trips"))
    return per_hour.orderBy(F.col("num_trips").desc(), F.col("pickup_hour")).limit(1)


def revenue_rainy_vs_dry(weather_days: DataFrame) -> DataFrame:
    """BQ6: daily revenue on rainy (light or heavy rain group) versus all other days."""
    g = X.weather_group("weather_desc")
    label = F.when(g.isin("Light Rain", "Heavy Rain"), F.lit("Rainy")).otherwise(F.lit("Dry"))
    return weather_days.groupBy(label.alias("day_type")).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("total_revenue").alias("avg_daily_revenue"),
        F.sum("total_revenue").alias("total_revenue"))
