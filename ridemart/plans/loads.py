"""Registered queries for loads: constraints inside the write, refresh by date, keyed appends, and model steps run by
the library's own pipeline."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import features as FE
from ridemart.operators import model as M
from ridemart.operators import quality as Q
from ridemart.plans.catalog import rounded
from ridemart.plans.checks import FILLED, damaged_features
from ridemart.plans.extra import _md5_number, _once, bronze_text
from ridemart.plans.refresh import RefreshedWarehouse
from ridemart.plans.warehouse import AS_OF, warehouse, weather_tables
from ridemart.session import scratch_path
from ridemart.sources import files, testdata

def load_rules() -> list[Q.Rule]:
    return [Q.Rule("booking_id_present", F.col("booking_id").isNotNull(), Q.FAIL), Q.Rule("price_positive", F.col("price") > 0, Q.FAIL),
            Q.Rule("distance_at_most_45", F.col("distance") <= 45, Q.DROP), Q.Rule("paid_by_card", F.col("capabilities") == "Z")]


def checked_loads(spark: SparkSession, sf: str) -> DataFrame:
    """DQ1-2: three loads of one table, each with its rules counted inside the write: bookings of priority 1 to 3, then a
    bad load (all bookings, prices negative at priority 7), then priority 4 and more. After each: whether it was
    published, rows that failed, and what the table and its rejects hold."""
    root = scratch_path(spark, "loads", uuid4().hex)
    typed = testdata.trips_typed(spark, sf)
    bad = typed.withColumn("price", F.when(F.col("priority") == 7, -F.col("price")).otherwise(F.col("price")))
    out = None
    for step, load in (("first", typed.where("priority <= 3")), ("bad", bad), ("second", typed.where("priority > 3"))):
        try:
            done = Q.checked_write(load, f"{root}/t", load_rules(), f"{root}/rejects")
            published, far, other = True, done["distance_at_most_45"], done["rows"] - done["paid_by_card"]
        except Q.ExpectationFailed:
            published, far, other = False, None, None
        table = spark.read.parquet(f"{root}/t").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 2).alias("revenue")).first()
        row = spark.range(1).select(F.lit(step).alias("step"), F.lit(published).alias("published"), F.lit(far).cast("long").alias("too_far"),
                                    F.lit(other).cast("long").alias("by_card"), F.lit(table["rows"]).cast("long").alias("rows"), F.lit(table["revenue"]).alias("revenue"),
                                    F.lit(spark.read.parquet(f"{root}/rejects").count()).cast("long").alias("rejected"))
        out = row if out is None else out.unionByName(row)
    return out


def refreshed(spark: SparkSession, sf: str) -> RefreshedWarehouse:
    """SNK5: event bookings in two batches; the second one holds half of the rows of the last days only."""
    def stage(path: str) -> None:
        wh = RefreshedWarehouse(spark, path, weather_tables(spark, sf)["weather_daily"])
        typed = testdata.event_trips_typed(spark, sf)
        late = F.coalesce((F.dayofmonth("pickup_due_ts") > 20) & (_md5_number(F.col("booking_id")) % 2 == 0), F.lit(False))
        wh.refresh(typed.where(~late), AS_OF["events"])
        wh.refresh(typed.where(late), AS_OF["events"])
    return RefreshedWarehouse(spark, _once(spark, "refreshed", sf, stage), weather_tables(spark, sf)["weather_daily"])


def _refreshed_zone_daily(spark: SparkSession, sf: str) -> DataFrame:
    wh = refreshed(spark, sf)
    zones = wh["dim_zone"].select(F.col("zone_key").alias("pickup_zone_key"), "zone_code")
    daily = wh["zone_daily"].join(zones, "pickup_zone_key", "left")
    return rounded(daily.select(F.col("trip_booked_for_date_key").cast("int").alias("trip_booked_for_date_key"), "zone_code", "total_revenue", "total_trips"),
                   {"total_revenue": 2})


def keyed_append(spark: SparkSession, sf: str) -> DataFrame:
    """DQ7 on a bucketed table: the batch of ``DQ7_append_twice``."""
    b = spark.read.parquet(bronze_text(spark, sf)).select(
        F.when(_md5_number(F.col("`Booking ID`")) % 7 != 0, F.col("`Booking ID`")).alias("booking_id"),
        F.col("Price").alias("price"), (_md5_number(F.concat(F.col("`Booking ID`"), F.lit(":held"))) % 2 == 0).alias("early"))
    run = uuid4().hex
    table, path = f"keyed_{run}", scratch_path(spark, "keyed", run)
    base = files.append_keyed(spark, table, path, b.where("early"), ["booking_id"], 8)
    first = files.append_keyed(spark, table, path, b, ["booking_id"], 8)
    second = files.append_keyed(spark, table, path, b, ["booking_id"], 8)
    return spark.createDataFrame([("base", base), ("after_first", base + first), ("added_by_second", second)], "step string, rows long")


def _prepared(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    feats = damaged_features(spark, sf)
    train, test, _ = M.prepare(feats.where("split = 'train'"), feats.where("split = 'test'"))
    return train, test


def scaled_means(spark: SparkSession, sf: str) -> DataFrame:
    """ML5: means of the test split's scaled columns, from the library's own preprocessing fitted on the training split."""
    train, test = _prepared(spark, sf)
    fitted = Pipeline(stages=M.preprocessor_stages()).fit(train)
    values = fitted.transform(test).select(F.posexplode(vector_to_array("_num_scaled")).alias("at", "x"))
    names = F.array(*[F.lit(c) for c in FE.NUMERIC_FEATURES])
    return (values.groupBy(F.element_at(names, F.col("at") + 1).alias("column_name")).agg(F.round(F.avg("x"), 4).alias("mean_scaled"))
            .where(F.col("column_name").isin(FILLED)))


def one_hot_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ML6: ones per place of each encoded categorical input over the test split; an unseen category has none."""
    train, test = _prepared(spark, sf)
    fitted = Pipeline(stages=M.preprocessor_stages()).fit(train.where("payment_type <> '5-low'"))
    coded = fitted.transform(test)
    out = None
    for c in FE.CATEGORICAL_FEATURES:
        ones = (coded.select(F.posexplode(vector_to_array(f"_{c}_oh")).alias("place", "one")).where("one <> 0").groupBy("place")
                .agg(F.sum("one").cast("long").alias("ones")).select(F.lit(c).alias("column_name"), "place", "ones"))
        out = ones if out is None else out.unionByName(ones)
    return out.where("column_name = 'payment_type'")


def capped_log_fit(spark: SparkSession, sf: str) -> DataFrame:
    """FLT8, FN19, ML7 through ``fit_predict``: a line fitted to log(1 + target) with a cap inside the data, predicted on the rows
    that it was fitted on. Least squares keeps the mean, so the mean log of the predictions is that of the targets."""
    train, _ = _prepared(spark, sf)
    _, pred = M.fit_predict(M.ModelSpec("capped", "linear", log_target=True, cap=30.0), train, train)
    return pred.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.log1p("predicted")), 3).alias("mean_log"),
                    F.max("actual").alias("largest"))


def reloaded_model(spark: SparkSession, sf: str) -> DataFrame:
    """ML8, ML9, ML12: models fitted, logged under a run id and saved; reloaded, they give the metrics of the log."""
    root = scratch_path(spark, "models", uuid4().hex)
    feats = damaged_features(spark, sf).checkpoint()  # both runs and the reload start from it
    train, test = feats.where("split = 'train'"), feats.where("split = 'test'")
    specs = [M.ModelSpec("line", "linear"), M.ModelSpec("forest", "forest", {"numTrees": 3, "maxDepth": 4, "seed": 42}),
             M.ModelSpec("forest log cap", "forest", {"numTrees": 3, "maxDepth": 4, "seed": 42}, log_target=True, cap=60.0)]
    for _ in range(2):  # a repeated run id is written once
        M.compare_models(train, test, specs, runs_path=f"{root}/runs", run_id="run-1", models_path=f"{root}/models")
    runs = spark.read.parquet(f"{root}/runs")
    _, prepared, _ = M.prepare(train, test)
    out = None
    for spec in specs:
        pred = M.predict(PipelineModel.load(M.model_path(f"{root}/models", "run-1", spec)), spec, prepared)
        again = M.regression_metrics(pred).select(F.lit(spec.name).alias("model"), F.col("n").alias("n_again"), F.col("rmse").alias("rmse_again"))
        out = again if out is None else out.unionByName(again)
    joined = runs.join(out, "model")
    return joined.select("model", "run_id", "n_test", (F.abs(F.col("rmse") - F.col("rmse_again")) < 1e-9).alias("same_rmse"),
                         (F.col("n_test") == F.col("n_again")).alias("same_rows"))


LOAD_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "DQ2_checked_loads": checked_loads,
    "SNK5_refreshed_daily_kpis": lambda s, sf: rounded(refreshed(s, sf)["daily_kpis"].drop("trip_booked_for_date_key"), {"total_revenue": 2}),
    "SNK5_refreshed_zone_daily": _refreshed_zone_daily,
    "DQ7_keyed_append": keyed_append,
    "ORD4_peek_zones": lambda s, sf: warehouse(s, sf).peek("dim_zone", 5, ["zone_code", "zone_key"], ["zone_code"]),
    "ML5_scaled_means": scaled_means,
    "ML6_one_hot_counts": one_hot_counts,
    "FN19_capped_log_fit": capped_log_fit,
    "ML12_reloaded_models": reloaded_model,
}


def load_sql(extra: dict[str, str], with_star: Callable[..., str], damaged: str) -> dict[str, str]:
    """SQL for LOAD_QUERIES; ``damaged``: the CTEs up to ``parts``, the damaged features with their split."""
    def load(step: str, rows: str, table: str) -> str:
        counts = ("true, count(*) FILTER (WHERE l_quantity > 45), count(*) FILTER (WHERE l_returnflag = 'R')"
                  if rows else "false, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
        return (f"SELECT '{step}', {counts}, count(*) FILTER (WHERE l_quantity <= 45), "
                f"round(sum(l_extendedprice) FILTER (WHERE l_quantity <= 45), 2), count(*) FILTER (WHERE l_quantity > 45) FROM lineitem WHERE {table}")

    median = "(SELECT median(CAST({0} AS DOUBLE)) FROM parts WHERE split = 'train')"
    filled = "coalesce(CAST({0} AS DOUBLE), " + median + ")"
    scaled = ("(SELECT {2}(" + filled + ") FROM parts WHERE split = '{1}')")
    return {
        "DQ2_checked_loads": "SELECT * FROM (" + " UNION ALL ".join([
            load("first", "x", "l_linenumber <= 3"), load("bad", "", "l_linenumber <= 3"), load("second", "x", "l_linenumber > 3")
        ]) + ") t(step, published, too_far, by_card, rows, revenue, rejected)",
        "SNK5_refreshed_daily_kpis": with_star(
            "SELECT full_date, day_name, round(total_revenue, 2) AS total_revenue, avg_trip_duration_min, total_trips, avg_distance_km FROM daily_kpis",
            "events"),
        "SNK5_refreshed_zone_daily": with_star(
            "SELECT z.trip_booked_for_date_key, d.zone_code, round(z.total_revenue, 2) AS total_revenue, z.total_trips "
            "FROM zone_daily z LEFT JOIN dim_zone d ON z.pickup_zone_key = d.zone_key", "events"),
        "DQ7_keyed_append": extra["DQ7_append_twice"],
        "ORD4_peek_zones": with_star("SELECT zone_code, zone_key FROM dim_zone ORDER BY zone_code LIMIT 5"),
        "ML5_scaled_means": damaged + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(({scaled.format(c, 'test', 'avg')} - {scaled.format(c, 'train', 'avg')}) / "
            f"{scaled.format(c, 'train', 'stddev_samp')}, 4) AS mean_scaled" for c in FILLED),
        "ML6_one_hot_counts": damaged + (
            ", k AS (SELECT coalesce(payment_type, '__null__') AS p, split FROM parts), "
            "c AS (SELECT p, CAST(row_number() OVER (ORDER BY p) - 1 AS INTEGER) AS place FROM (SELECT DISTINCT p FROM k WHERE split = 'train' AND p <> '5-low')) "
            "SELECT 'payment_type' AS column_name, place, count(*) AS ones FROM k JOIN c USING (p) WHERE split = 'test' GROUP BY place"),
        "FN19_capped_log_fit": damaged + (
            "SELECT count(*) AS rows, round(avg(ln(1 + trip_duration_minutes)), 3) AS mean_log, CAST(max(trip_duration_minutes) AS DOUBLE) AS largest "
            "FROM parts WHERE split = 'train' AND trip_duration_minutes <= 30"),
        "ML12_reloaded_models": damaged + (
            "SELECT model, 'run-1' AS run_id, count(*) FILTER (WHERE trip_duration_minutes <= cap) AS n_test, true AS same_rmse, true AS same_rows "
            "FROM parts, (VALUES ('line', 1e9), ('forest', 1e9), ('forest log cap', 60)) m(model, cap) WHERE split = 'test' GROUP BY model"),
    }
