"""Live tile (STR1): event-time windowed trips and revenue over a stream.

Watermark + tumbling window + groupBy; state older than the watermark is dropped, so the
state size is bounded by the watermark delay, not by the stream's length. Each micro-batch
writes the windows it updated under its batch id (a replayed batch overwrites its own
folder: idempotent), and the tile is the latest version of every window. ``compact_tile`` folds the
updates into one folder, so that reading the tile does not grow with the stream's age.

``run_counted_tile`` is the form without a state store that loses no row from sight: each micro-batch adds its own
counts per window, which sum to the tile, and rows behind the watermark land in a side table.

Late data in ``run_tile``: a row is dropped when its window ended before the watermark of the previous
micro-batch (Spark applies the late-event watermark one batch behind the eviction watermark).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.sources import storage


def windowed_counts(stream: DataFrame, ts: str = "ts", key: str = "event_type",
                    value: str = "value", window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("trips"), F.sum(value).alias("revenue"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    F.col(key), "trips", "revenue"))


def run_tile(agg: DataFrame, out_path: str, checkpoint: str) -> None:
    """Update-mode micro-batches, each written as its own batch folder, until caught up."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def _numbers(spark: SparkSession, out_path: str, prefix: str) -> list[int]:
    """Numbers of the written folders ``prefix=number``, in order."""
    if not storage.exists(spark, out_path):
        return []
    return sorted(int(n.split("=")[1]) for n in storage.names(spark, out_path) if n.startswith(f"{prefix}=")
                  and storage.exists(spark, f"{out_path}/{n}/_SUCCESS"))


def compact_tile(spark: SparkSession, out_path: str, keys: list[str],
                 read: Callable[[SparkSession, str, list[str]], DataFrame] | None = None) -> None:
    """Fold all updates so far into one folder ``tile=<last batch>`` with one row per window and key, then remove what it
    replaces. A folder counts once it is whole, so a failure at any point leaves the tile as it was; call it
    between runs of the stream. ``read``: ``latest_tile`` (the default) or ``summed_tile``."""
    batches, tiles = _numbers(spark, out_path, "batch_id"), _numbers(spark, out_path, "tile")
    last = tiles[-1] if tiles else -1
    if batches and batches[-1] > last:
        tile = (read or latest_tile)(spark, out_path, keys)
        tile.withColumn("batch_id", F.lit(batches[-1]).cast("long")).write.mode("overwrite").parquet(f"{out_path}/tile={batches[-1]}")
        last = batches[-1]
    for prefix, numbers, kept in (("batch_id", batches, last + 1), ("tile", tiles, last)):
        for n in numbers:
            if n < kept:
                storage.remove(spark, f"{out_path}/{prefix}={n}")


def _folders(spark: SparkSession, out_path: str, below: int | None = None) -> list[str]:
    """The compacted tile, if any, and the updates after it, of batches below ``below``."""
    tiles = _numbers(spark, out_path, "tile")
    last = tiles[-1] if tiles else -1
    return [f"{out_path}/tile={last}"] * bool(tiles) + [
        f"{out_path}/batch_id={n}" for n in _numbers(spark, out_path, "batch_id")
        if n > last and (below is None or n < below)]


def latest_tile(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """The newest emitted row per window and key: the compacted tile, if any, and the updates after it."""
    updates = spark.read.parquet(*_folders(spark, out_path))
    rest = [c for c in updates.columns if c not in keys and c != "batch_id"]
    latest = updates.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col("batch_id")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])


def run_counted_tile(stream: DataFrame, out_path: str, late_path: str, checkpoint: str, ts: str = "ts",
                     key: str = "event_type", value: str = "value", window: str = "1 hour",
                     watermark: str = "2 hours") -> None:
    """Windowed trips and revenue of a stream of raw events, until caught up; nothing is dropped unseen.

    The watermark of a micro-batch is the largest event time of all batches before it, less the delay. Rows whose
    window ended by then, and rows without an event time, go unchanged to ``late_path``; the others are
    counted per window and key, and the counts of all batches are added up by ``summed_tile``. No state is
    held between batches: the largest event time is read from the counts written so far. A replayed batch overwrites its
    own folders with the same rows; one that a compacted tile holds already is left out."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tiles = _numbers(spark, out_path, "tile")
        if tiles and tiles[-1] >= batch_id:
            return
        held = _folders(spark, out_path, batch_id)
        mark = spark.read.parquet(*held).agg(F.unix_micros(F.max("last_ts"))).first()[0] if held else None
        end = F.window(ts, window).getField("end")
        late = F.col(ts).isNull()
        if mark is not None:
            late = late | (end <= F.timestamp_micros(F.lit(mark)) - F.expr(f"INTERVAL {watermark}"))
        late = F.coalesce(late, F.lit(True))
        (batch.where(late).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}"))
        counts = (batch.where(~late).groupBy(F.window(ts, window).alias("w"), F.col(key))
                  .agg(F.count(F.lit(1)).alias("trips"), F.sum(value).alias("revenue"), F.max(ts).alias("last_ts")))
        (counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "trips",
                       "revenue", "last_ts", F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def summed_tile(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """One row per window and key from the counts of all batches that ``run_counted_tile`` wrote."""
    counts = spark.read.parquet(*_folders(spark, out_path))
    return counts.groupBy(*keys).agg(
        F.max("window_end").alias("window_end"), F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"),
        F.max("last_ts").alias("last_ts"))


def late_rows(spark: SparkSession, late_path: str) -> DataFrame:
    """The rows that came behind the watermark, with the micro-batch they came in."""
    return spark.read.option("basePath", late_path).parquet(
        *[f"{late_path}/batch_id={n}" for n in _numbers(spark, late_path, "batch_id")])
