"""SNK5, refresh of what changed: a new batch rewrites only the dates that it touches.

Tables are partitioned by the booked-for date key:

* ``trips_latest``: cleaned bookings, the latest version of each, not yet conformed, so that versions of a
  later batch compete with them exactly as in a full build,
* ``fact_trip`` and the marts ``daily_kpis``, ``zone_daily``, ``hourly_trips``.

A batch affects the dates of its rows and the dates at which its bookings are held (a booking may move). Only
these partitions are read, deduplicated together with the batch, and written by dynamic partition overwrite; a date
that loses its last trip loses its partition. New zones get the next keys, held ones keep theirs. A trip_key
is its date key times 10^10 plus its place by booking_id within the date, so other dates' keys never move.

The new rows are staged and checked against the fact's rules first: a load that breaks one leaves every table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.functions import expr as X
from ridemart.operators import marts, quality as Q, silver as S, star
from ridemart.operators.keys import dense_key
from ridemart.sources import storage
from ridemart.sources.schemas import FACT_TRIP_COLUMNS, SILVER_COLUMNS

DATE = "trip_booked_for_date_key"
KEY_SPACE = 10_000_000_000
PARTITIONED = ("trips_latest", "fact_trip", "daily_kpis", "zone_daily", "hourly_trips")


def on_dates(dates: list[int | None]) -> Column:
    """Rows of these dates, as a filter that prunes partitions; None stands for trips without a date."""
    known = F.col(DATE).isin([d for d in dates if d is not None])
    return known | F.col(DATE).isNull() if None in dates else known


def _write_dates(df: DataFrame, path: str) -> None:
    """One file per date where it is small, several where it is large: AQE splits and merges the partitions."""
    (df.hint("rebalance", DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path))


def _folder(date: int | None) -> str:
    return f"{DATE}={'__HIVE_DEFAULT_PARTITION__' if date is None else date}"


def _dates(df: DataFrame) -> list[int | None]:
    """One value per date."""
    return [r[0] for r in df.select(DATE).distinct().collect()]


class RefreshedWarehouse:
    """Partitioned tables under ``root`` that batches of typed bookings are merged into."""

    def __init__(self, spark: SparkSession, root: str, weather_daily: DataFrame, rules: list[Q.Rule] | None = None):
        self.spark, self.root, self.weather = spark, root.rstrip("/"), weather_daily
        self.rules = Q.fact_rules() if rules is None else rules

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return storage.exists(self.spark, self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def affected(self, batch: DataFrame) -> list[int | None]:
        """Dates of the batch, and dates at which its bookings are held: ids and dates of the held table are read, nothing else."""
        found = set(_dates(batch))
        if self.has("trips_latest"):
            held = self["trips_latest"].select(F.col("booking_id").alias("held_id"), DATE)
            ids = batch.select("booking_id").distinct()
            found |= set(_dates(held.join(ids, F.col("held_id").eqNullSafe(F.col("booking_id")), "left_semi")))
        return sorted(found, key=lambda d: (d is not None, d or 0))

    def refresh(self, typed: DataFrame, as_of=None) -> list[int | None]:
        """Merge a batch of typed bookings; returns the date keys whose partitions were rewritten."""
        run = self.path(f"_staged/{uuid.uuid4().hex}")
        clean = S.clean(typed, as_of).withColumn(DATE, X.date_key(F.to_date("pickup_due_ts")))
        clean.write.parquet(f"{run}/batch")
        batch = self.spark.read.parquet(f"{run}/batch")
        dates = self.affected(batch)
        if not dates:
            storage.remove(self.spark, run)
            return []
        if self.has("trips_latest"):
            batch = batch.unionByName(self["trips_latest"].where(on_dates(dates)))
        S.dedup_latest(batch).select(*SILVER_COLUMNS, DATE).write.parquet(f"{run}/latest")
        latest = self.spark.read.parquet(f"{run}/latest")
        silver = S.conform(latest)
        left = _dates(latest)
        gone = [d for d in dates if d not in left]

        days = self._dim_date(silver, gone)
        days.write.parquet(f"{run}/dim_date")
        self._dim_zone(silver).write.parquet(f"{run}/dim_zone")
        dim_date, dim_zone = (self.spark.read.parquet(f"{run}/{d}") for d in ("dim_date", "dim_zone"))
        fact = self._keyed(star.fact_trip(silver, dim_date, dim_zone, with_trip_key=False))
        try:
            Q.checked_write(fact, f"{run}/fact", self.rules)
        except Q.ExpectationFailed:
            storage.remove(self.spark, run)
            raise
        fact = self.spark.read.parquet(f"{run}/fact")

        _write_dates(latest, self.path("trips_latest"))
        for name in ("dim_date", "dim_zone"):
            storage.replace(self.spark, f"{run}/{name}", self.path(name))
        dim_date = self["dim_date"]
        _write_dates(fact, self.path("fact_trip"))
        _write_dates(marts.daily_kpis(fact, dim_date).withColumn(DATE, X.date_key(F.col("full_date"))), self.path("daily_kpis"))
        _write_dates(marts.zone_daily(fact), self.path("zone_daily"))
        _write_dates(marts.hourly_trips(fact, dim_date).withColumn(DATE, X.date_key(F.col("trip_date"))), self.path("hourly_trips"))
        for name in PARTITIONED:
            for date in gone:
                storage.remove(self.spark, f"{self.path(name)}/{_folder(date)}")
            self.spark.catalog.refreshByPath(self.path(name))
        storage.remove(self.spark, run)
        return dates

    def _dim_date(self, silver: DataFrame, gone: list[int | None]) -> DataFrame:
        """Calendar of the dates held before, less those that have no trip now, and the refreshed ones."""
        days = silver.select("pickup_due_ts")
        if self.has("dim_date"):
            kept = self["dim_date"].where(~F.col("date_key").isin([d for d in gone if d is not None]))
            days = days.unionByName(kept.select(F.col("full_date").cast("timestamp").alias("pickup_due_ts")))
        return star.dim_date(days, self.weather)

    def _dim_zone(self, silver: DataFrame) -> DataFrame:
        """Held zones with their keys; places become the lower of held and new ones; new zones follow in code order."""
        seen = star.dim_zone(silver).select("zone_code", "latitude", "longitude")
        if not self.has("dim_zone"):
            return star.dim_zone(silver)
        held = self["dim_zone"]
        places = S.keep_first(held.select("zone_code", "latitude", "longitude").unionByName(seen), ["zone_code"],
                              [F.col("latitude").asc_nulls_first(), F.col("longitude").asc_nulls_first()])
        start = (held.agg(F.max("zone_key")).first()[0] or 0) + 1 if not held.isEmpty() else 0
        new = dense_key(seen.join(held, "zone_code", "left_anti").select("zone_code"), [F.col("zone_code").asc()], "zone_key", start=start)
        keys = held.select("zone_code", "zone_key").unionByName(new.select("zone_code", F.col("zone_key").cast("int").alias("zone_key")))
        return keys.join(places, "zone_code").select(*held.columns)

    def _keyed(self, fact: DataFrame) -> DataFrame:
        """trip_key: the date key's own space, then the place by booking_id; numbered by ranges, so a hot date is spread."""
        placed = dense_key(fact, [F.col(DATE).asc_nulls_first(), F.col("booking_id").asc_nulls_first()], "place")
        first = placed.groupBy(F.col(DATE).alias("_date")).agg(F.min("place").alias("_first"))
        key = F.coalesce(F.col(DATE).cast("long"), F.lit(0)) * KEY_SPACE + F.col("place") - F.col("_first")
        return (placed.join(first, F.col(DATE).eqNullSafe(F.col("_date"))).withColumn("trip_key", key).select(*FACT_TRIP_COLUMNS))
