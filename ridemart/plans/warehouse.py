"""Ordered table build: bronze/typed feeds -> silver -> star -> marts (SNK2/SNK3/SNK5).

Each table is a plain function of upstream DataFrames (``ridemart.operators``); this module
runs them in dependency order and writes each result as Parquet under one root folder.
Downstream steps read the written tables back, which cuts lineage (a lost executor re-reads a
file instead of recomputing the chain) and gives the planner real file sizes, so dimension
broadcasts are decided on checked sizes.

Within a session the same (source, sf_dir) is built once and reused by every query.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import marts, quality as Q, silver as silver_ops, star, weather as weather_ops
from ridemart.session import scratch_path
from ridemart.sources import files, testdata

# Fixed "now" per feed, so that the future-pickup rule is deterministic: order dates run
# 1995-01-01 .. 2001-08-01, event times 2024-01-01 .. 2024-01-30.
AS_OF = {
    "orders": "2001-06-30 00:00:00",
    "events": "2024-01-28 00:00:00",
}

_LOCK = threading.RLock()
_CACHE: dict[tuple, "Warehouse"] = {}


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    tables: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    checks: dict[str, dict[str, int]] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, sort_by: list[str] | None = None, rules: list[Q.Rule] | None = None) -> DataFrame:
        """Overwrite table ``name`` (schema replaced) and return a DataFrame reading it. With ``rules``, rows are counted
        while they are written, and a load that breaks a fail-mode rule leaves the held table as it was (DQ2)."""
        path = f"{self.root}/{name}"
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
        if rules is None:
            out.write.mode("overwrite").option("compression", files.CODEC).parquet(path)
        else:
            self.checks[name] = Q.checked_write(out, path, rules)
        self.tables[name] = path
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.tables[name])

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(name)

    def peek(self, name: str, n: int = 5, columns: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
        """ORD4/SNK8 inspection: the first ``n`` rows (optionally a column subset, optionally in an order) of a table."""
        df = self.read(name).orderBy(*order_by) if order_by else self.read(name)
        return (df.select(*columns) if columns else df).limit(n)

    def summary(self) -> DataFrame:
        """SNK8: one row per built table with its row and column counts."""
        rows = []
        for name in self.tables:
            df = self.read(name)
            rows.append((name, df.count(), len(df.columns)))
        return self.spark.createDataFrame(rows, "table string, rows long, columns int")


#: Types whose least and largest value Spark takes from Parquet footers.
_FOOTER_TYPES = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date"}


_FOOTER_ROW = "table string, column_name string, type string, rows long, non_null long, min double, max double"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own with the two settings that push counts and extremes into Parquet scans."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def column_profile(df: DataFrame, extremes: set[str]) -> DataFrame:
    """One row per column of ``df``, from one aggregate; least and largest values of the columns in ``extremes``."""
    aggs, parts = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(df.schema.fields):
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        aggs.append(F.count(c).alias(f"n{i}"))
        low = high = F.lit(None).cast("double")
        if f.name in extremes:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            low, high = ((F.unix_date(x) if kind == "date" else F.col(x)).cast("double") + F.lit(0.0) for x in (f"lo{i}", f"hi{i}"))
        parts.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(kind).alias("type"), F.col("_rows").alias("rows"),
                              F.col(f"n{i}").alias("non_null"), low.alias("min"), high.alias("max")))
    return df.agg(*aggs).select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def footer_profile(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """SNK8: (table, column_name, type, rows, non_null, min, max) of written tables from the footers of their files: counts
    and extremes are pushed into the scan, so no column data is read. Extremes are doubles (dates: days since
    1970; footers write a least zero as -0.0, which becomes 0.0), NULL for types whose footers hold none and for columns
    without a value. A table with a row group whose footer lacks an extreme (a column all NULL there, or with
    a NaN) is read in the usual way."""
    own, rows = footer_session(spark), []
    for name, path in tables.items():
        table = own.read.parquet(path)
        some = {r.column_name for r in column_profile(table, set()).collect() if r.non_null and r.type in _FOOTER_TYPES}
        try:
            found = column_profile(table, some).collect()  # one row a column
        except Py4JJavaError as e:
            if "No min/max found" not in str(e):
                raise
            found = column_profile(spark.read.parquet(path), some).collect()
        rows += [(name, *r) for r in found]
    return spark.createDataFrame(rows, _FOOTER_ROW)


def build_weather(wh: Warehouse, weather_bronze: DataFrame) -> None:
    sw = wh.write("silver_weather", weather_ops.silver_weather(weather_bronze))
    wh.write("weather_daily", weather_ops.weather_daily(sw))


def build_star(wh: Warehouse, typed_trips: DataFrame, as_of: str, within: tuple[str, ...] = ()) -> None:
    """silver_taxi -> dim_date, dim_zone -> fact_trip -> marts; ``within``: see ``silver.dedup_latest``."""
    silver = wh.write("silver_taxi", silver_ops.silver_from_typed(typed_trips, as_of, within), sort_by=["pickup_due_ts", "booked_by"])
    dd = wh.write("dim_date", star.dim_date(silver, wh["weather_daily"]))
    dz = wh.write("dim_zone", star.dim_zone(silver))
    fact = wh.write("fact_trip", star.fact_trip(silver, dd, dz), rules=Q.fact_rules())
    wh.write("daily_kpis", marts.daily_kpis(fact, dd))
    wh.write("zone_daily", marts.zone_daily(fact))
    wh.write("hourly_trips", marts.hourly_trips(fact, dd))


def weather_tables(spark: SparkSession, sf_dir: str) -> Warehouse:
    """silver_weather and weather_daily alone, for what reads no bookings (memoized per session, shared by both feeds)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "_weather")
    with _LOCK:
        if key not in _CACHE:
            tag = sf_dir.rstrip("/").replace("/", "_").strip("_")
            wh = Warehouse(spark, scratch_path(spark, "warehouse", tag, "weather"))
            build_weather(wh, testdata.weather_bronze(spark, sf_dir))
            _CACHE[key] = wh
        return _CACHE[key]


def warehouse(spark: SparkSession, sf_dir: str, source: str = "orders") -> Warehouse:
    """The built warehouse for one feed of the driver's tables (memoized per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), source)
    with _LOCK:
        if key in _CACHE:
            return _CACHE[key]
        tag = sf_dir.rstrip("/").replace("/", "_").strip("_")
        wh = Warehouse(spark, scratch_path(spark, "warehouse", tag, source))
        wh.tables.update(weather_tables(spark, sf_dir).tables)  # both feeds share one weather build
        within = (testdata.ORDER_OR_LINE,) if source == "orders" else ()
        typed = (testdata.trips_typed(spark, sf_dir, within) if source == "orders"
                 else testdata.event_trips_typed(spark, sf_dir))
        build_star(wh, typed, AS_OF[source], within)
        _CACHE[key] = wh
        return wh


def as_of_col(source: str = "orders"):
    return F.lit(AS_OF[source]).cast("timestamp")
