"""Registered queries that answer from what is kept beside the rows: sketches per date, footers of files, cells of vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import sketches as K
from ridemart.operators import vector as V
from ridemart.plans.catalog import rounded
from ridemart.plans.extra import PROFILE_COLUMNS, _fact_year, _once
from ridemart.plans.warehouse import footer_profile, warehouse
from ridemart.session import scratch_path
from ridemart.sources import testdata

YEARS = (1996, 1997)
#: Columns of the inspected tables with their types, as the footers give them.
FOOTER_COLUMNS = {
    "fact_trip": "trip_key:bigint booking_id:string trip_booked_for_date_key:int pickup_zone_key:int destination_zone_key:int "
                 "status:string payment_type:string booking_source:string driver_id:string vehicle_id:string priority_level:int "
                 "capabilities:string dispatcher_id:string fare_amount:double dispatch_timestamp:timestamp "
                 "pickup_due_timestamp:timestamp distance:double expected_vs_actual_pickup_minutes_difference:double "
                 "dispatch_to_arrival_minutes:double trip_duration_minutes:double",
    "dim_date": "date_key:int full_date:date day:int day_name:string week:int month:int month_name:string quarter:int year:int "
                "weekend_flag:boolean avg_temp_c:double total_precip_mm:double avg_wind_speed_kmph:double avg_humidity:double "
                "avg_visibility_km:double avg_cloud_cover:double avg_pressure_mb:double weather_desc:string",
    "dim_zone": "zone_key:int zone_code:string latitude:double longitude:double",
    "daily_kpis": "full_date:date day_name:string total_revenue:double avg_trip_duration_min:double total_trips:bigint "
                  "avg_distance_km:double",
}


def fact_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's sketches by booking date, written once."""
    def stage(path: str) -> None:
        K.date_sketches(warehouse(spark, sf)["fact_trip"], "trip_booked_for_date_key", PROFILE_COLUMNS).write.parquet(path)
    return spark.read.parquet(_once(spark, "fact_sketches", sf, stage))


def year_drift(spark: SparkSession, sf: str) -> DataFrame:
    """DQ5: two years compared from the sketches alone."""
    days = warehouse(spark, sf)["dim_date"].select(F.col("date_key").alias("date"), "year")
    dated = fact_sketches(spark, sf).join(days, "date")
    before, after = (K.merged(dated.where(F.col("year") == y)) for y in YEARS)
    return K.drift(before, after)


def _exact(spark: SparkSession, sf: str, year: int, side: str) -> DataFrame:
    """Exact number of different values, from the fact itself."""
    facts = _fact_year(spark, sf, year).select(*[F.col(c).cast("double").alias(c) for c in PROFILE_COLUMNS])
    values = facts.unpivot([], PROFILE_COLUMNS, "column_name", "x")
    return values.groupBy("column_name", "x").count().groupBy("column_name").agg(F.count("x").alias(f"exact_{side}"))


def _median_ranks(spark: SparkSession, sf: str, year: int, side: str, drift: DataFrame) -> DataFrame:
    """Shares of the fact's values below, and up to, the sketch's median."""
    facts = _fact_year(spark, sf, year).select(*[F.col(c).cast("double").alias(c) for c in PROFILE_COLUMNS])
    values = facts.unpivot([], PROFILE_COLUMNS, "column_name", "x").where("x IS NOT NULL")
    # one median a column
    at = values.join(F.broadcast(drift.select("column_name", F.col(f"median_{side}").alias("m"))), "column_name")
    return at.groupBy("column_name").agg((F.avg((F.col("x") < F.col("m")).cast("double")) <= 0.5 + K.RANK_ERROR).alias(f"low_{side}"),
                                         (F.avg((F.col("x") <= F.col("m")).cast("double")) >= 0.5 - K.RANK_ERROR).alias(f"high_{side}"))


def checked_year_drift(spark: SparkSession, sf: str) -> DataFrame:
    """``year_drift`` with counts and extremes as they are, and for the estimates whether the fact's own values lie within
    the stated errors."""
    drift = year_drift(spark, sf)
    out = drift
    for year, side in zip(YEARS, ("before", "after")):
        out = out.join(_exact(spark, sf, year, side), "column_name").join(_median_ranks(spark, sf, year, side, drift), "column_name")

    def near(side: str):
        """A sketch of few values is exact but for rounding."""
        return F.abs(F.col(f"distinct_{side}") - F.col(f"exact_{side}")) <= F.greatest(F.lit(1.0), K.DISTINCT_ERROR * F.col(f"exact_{side}"))

    exact = [F.round(F.col(f"{c}_{side}"), 4).alias(f"{c}_{side}") if c in ("min", "max") else F.col(f"{c}_{side}")
             for side in ("before", "after") for c in ("rows", "nulls", "min", "max")]
    return out.select("column_name", *exact, (near("before") & near("after")).alias("distinct_within"),
                      (F.col("low_before") & F.col("high_before") & F.col("low_after") & F.col("high_after")).alias("median_within"),
                      F.col("distance").between(0, 1).alias("distance_given"))


def celled_top10(spark: SparkSession, sf: str) -> DataFrame:
    """VEC1 from cells: the answer of the full search."""
    corpus = testdata.table(spark, sf, "embeddings")
    made: dict[str, V.Cells] = {}

    def stage(path: str) -> None:
        made["cells"] = V.build_cells(corpus, path, n_cells=16)

    path = _once(spark, "vector_cells", sf, stage)
    cells = made.get("cells") or _CELLS[path]
    _CELLS[path] = cells
    return rounded(V.search_cells(spark, cells, V.centroids(corpus), k=10, probes=2)[0], {"similarity": 4})


#: Centres and radii of the indexes written in this process, by path.
_CELLS: dict[str, V.Cells] = {}


def footers(spark: SparkSession, sf: str) -> DataFrame:
    tables = warehouse(spark, sf).tables
    return rounded(footer_profile(spark, {t: tables[t] for t in FOOTER_COLUMNS}), {"min": 4, "max": 4})


PROFILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "DQ5_sketch_drift": checked_year_drift,
    "SNK8_footer_profile": footers,
    "VEC1_celled_top10": celled_top10,
}


def profile_sql(extra: dict[str, str], with_star: Callable[..., str]) -> dict[str, str]:
    """SQL for PROFILE_QUERIES."""
    def year(c: str, y: int) -> str:
        x = f"CAST(f.{c} AS DOUBLE)"
        return (f"(SELECT count(*) AS rows, count(*) FILTER (WHERE f.{c} IS NULL) AS nulls, round(min({x}), 4) AS lo, round(max({x}), 4) AS hi "
                f"FROM fact_trip f JOIN dim_date d ON f.trip_booked_for_date_key = d.date_key WHERE d.year = {y})")

    drift = [f"SELECT '{c}' AS column_name, b.rows AS rows_before, b.nulls AS nulls_before, b.lo AS min_before, b.hi AS max_before, "
             "a.rows AS rows_after, a.nulls AS nulls_after, a.lo AS min_after, a.hi AS max_after, "
             "true AS distinct_within, true AS median_within, true AS distance_given "
             f"FROM {year(c, YEARS[0])} b, {year(c, YEARS[1])} a" for c in PROFILE_COLUMNS]

    def extreme(f: str, c: str, kind: str) -> str:
        if kind in ("string", "timestamp"):
            return "CAST(NULL AS DOUBLE)"
        x = f"date_diff('day', DATE '1970-01-01', {c})" if kind == "date" else f"CAST({c} AS INTEGER)" if kind == "boolean" else c
        return f"round(CAST({f}({x}) AS DOUBLE) + 0.0, 4)"

    rows = [f"SELECT '{t}' AS \"table\", '{c}' AS column_name, '{kind}' AS type, count(*) AS rows, count({c}) AS non_null, "
            f"{extreme('min', c, kind)} AS min, {extreme('max', c, kind)} AS max FROM {t}"
            for t, columns in FOOTER_COLUMNS.items() for c, kind in (x.split(":") for x in columns.split())]
    return {"DQ5_sketch_drift": with_star("\nUNION ALL\n".join(drift)),
            "SNK8_footer_profile": with_star("\nUNION ALL\n".join(rows)),
            "VEC1_celled_top10": extra["VEC1_label_centroid_top10"]}
