"""File sources and sinks: CSV batch bronze (SRC1, SRC4, SRC5), table writes (SNK1-3, SNK6, SNK9)."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridemart.sources.schemas import CORRUPT_COLUMN, all_string_schema

SOURCE_FILE_COLUMN = "_source_file"
#: Tables are read more often than written, and hold repeated texts.
CODEC = "zstd"


def landed_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> list[str]:
    """The files of a landing folder, listed without reading them: the content column is pruned."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return [unquote(r.file) for r in reader.load(path).select(F.col("_metadata.file_path").alias("file")).orderBy("file").collect()]


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, read from its start through the file system that Spark reads it with; compressed
    files by their suffix, as the readers do. None for an empty file."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        content = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
    finally:
        stream.close()


def file_headers(spark: SparkSession, files: list[str], at_once: int = 16) -> dict[str, list[str]]:
    """Files by their header line. Only the start of each file is read, a few files at a time, like a listing."""
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(at_once) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if header is not None:
                found.setdefault(header, []).append(file)
    return found


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], glob: str | None = None,
             required: list[str] | None = None, listed: list[str] | None = None) -> DataFrame:
    """SRC1: header CSV files as text columns, mapped by each file's own header.

    The result has ``columns``, then every other column that some file has, the raw text of lines
    that do not fit their header in ``_corrupt_record``, and the file in ``_source_file``. Files may
    order their columns differently. A file without a ``required`` column (default: all ``columns``)
    is rejected line by line, never mapped by position. No schema inference. ``listed``: the files, where a stream
    has listed them already.
    """
    needed, parts = set(columns if required is None else required), []
    landed = landed_files(spark, path, glob) if listed is None else listed
    for header, group in file_headers(spark, landed).items():
        names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]), [])]
        usable = needed <= set(names) and len(set(names)) == len(names)
        if usable:
            raw = (spark.read.schema(all_string_schema(names, with_corrupt=True))
                   .option("header", True).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("enforceSchema", True).csv(group))
            named = [F.col(f"`{n}`") for n in names] + [F.col(CORRUPT_COLUMN)]
        else:
            raw = spark.read.text(group).where((F.trim("value") != "") & (F.col("value") != header))
            named = [F.col("value").alias(CORRUPT_COLUMN)]
        parts.append(raw.select(*named, F.col("_metadata.file_path").alias(SOURCE_FILE_COLUMN)))
    empty = StructType([StructField(c, StringType()) for c in (*columns, CORRUPT_COLUMN, SOURCE_FILE_COLUMN)])
    out = spark.createDataFrame([], empty)
    for part in parts:
        out = out.unionByName(part, allowMissingColumns=True)
    extra = [c for c in out.columns if c not in empty.fieldNames()]
    return out.select(*[F.col(f"`{c}`") for c in (*columns, *extra, CORRUPT_COLUMN, SOURCE_FILE_COLUMN)])


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, malformed rows as raw text)."""
    good = raw.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = raw.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("raw_line"))
    return good, bad


def add_ingest_metadata(df: DataFrame, source_file: str | None = None,
                        ts_col: str = "_ingest_timestamp", file_col: str = "_source_file") -> DataFrame:
    """SRC4: ingest time and source file (a literal, or the file that ``read_csv`` noted)."""
    out = df.drop(SOURCE_FILE_COLUMN) if source_file else df
    src = F.lit(source_file) if source_file else F.col(SOURCE_FILE_COLUMN)
    return out.withColumn(ts_col, F.current_timestamp()).withColumn(file_col, src).select(
        *[F.col(f"`{c}`") for c in out.columns if c != SOURCE_FILE_COLUMN], ts_col, file_col)


def normalise_names(df: DataFrame) -> DataFrame:
    """SRC5: spaces in column names become underscores (one projection, no rename loop)."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """A catalog table name, or a folder holding a Parquet table."""
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target).schema  # lists the folder; fails when it does not exist
        return True
    except AnalysisException:
        return False


def write_if_absent(df: DataFrame, target: str) -> bool:
    """SNK1: create the table only if it does not exist yet (a rerun is a no-op). ``target`` is
    a catalog table name or a folder."""
    if table_exists(df.sparkSession, target):
        return False
    w = df.write.mode("errorifexists").option("compression", CODEC)
    if _is_path(target):
        w.parquet(target)
    else:
        w.saveAsTable(target)
    return True


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK2/SNK3: full overwrite; Parquet replaces the schema with the new one."""
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_new(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """DQ7 (batch form): of the incoming rows, the first per key whose key is not already present. NULL
    keys compare as equal, so a rerun appends nothing; which of several rows of a key stays depends
    on all columns, not on their order."""
    order = [F.col(f"`{c}`").asc_nulls_last() for c in incoming.columns if c not in key]
    fresh = incoming.withColumn("_nth", F.row_number().over(
        Window.partitionBy(*key).orderBy(*(order or [F.lit(1)])))).where("_nth = 1").drop("_nth")
    held = existing.select(*[F.col(k).alias(f"_held_{k}") for k in key]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in key])
    return fresh.join(held, same, "left_anti")


def append_keyed(spark: SparkSession, table: str, path: str, incoming: DataFrame, key: list[str], buckets: int = 32) -> int:
    """DQ7 for a held table of any size: like ``append_new``, on a table stored in ``buckets`` by its key; returns the rows
    appended. The incoming rows are dealt to the same buckets and meet the held keys there, so the
    held table is neither shuffled nor sorted as a whole. Keys with a NULL are few groups of their own and compared apart."""
    seen = Observation()
    if not spark.catalog.tableExists(table):
        fresh = append_new(incoming.limit(0), incoming, key)
    else:
        fresh = _unheld(spark.table(table), incoming, key)
    (fresh.repartition(buckets, *key).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
     .bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(table))
    return seen.get["rows"]


def _unheld(held: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Of the incoming rows, the first per key whose key the bucketed table ``held`` lacks."""
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    fresh = append_new(incoming.limit(0), incoming, key)
    known = held.select(*key).hint("merge")  # the bucketed side stays where it is
    return (fresh.where(~some_null).join(known, key, "left_anti")
            .unionByName(append_new(held.where(some_null), fresh.where(some_null), key)))


#: Most rows of a file of a compressed export, which one task reads as a whole.
FILE_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite") -> None:
    """SNK6/SNK9: header CSV export (one folder of part files per table), plain or compressed (``.csv.gz``) in files of bounded size."""
    w = df.write.mode(mode).option("header", True)
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
    w.csv(path)


def sample_by_hash(df: DataFrame, key: str, one_in: int, seed: int = 42) -> DataFrame:
    """SNK9 trip sample: keep rows whose key hashes into bucket 0 of ``one_in`` -- the first 32
    bits of md5(key:seed). Repeatable, partition-independent (unlike sample()), and the same
    bits are computable in SQL engines other than Spark."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.where(F.pmod(bucket, F.lit(one_in)) == 0)


# ------------------------------------------------------------------ dashboard extracts (SNK9/SRC6)

EXTRACT_SCHEMAS = {
    "dim_zone": "zone_code string, latitude double, longitude double, zone_key int",
    "dim_date": ("date_key int, full_date date, day int, day_name string, week int, month int, "
                 "month_name string, quarter int, year int, weekend_flag boolean, avg_temp_c double, "
                 "total_precip_mm double, avg_wind_speed_kmph double, avg_humidity double, "
                 "avg_visibility_km double, avg_cloud_cover double, avg_pressure_mb double, "
                 "weather_desc string"),
    "gold_daily_kpis": ("full_date date, day_name string, total_revenue double, "
                        "avg_trip_duration_min double, total_trips long, avg_distance_km double"),
    "fact_zone_daily_agg": ("trip_booked_for_date_key int, pickup_zone_key int, "
                            "total_revenue double, total_trips long"),
    "fact_trip_sample": None,  # the fact's own schema, see read_extract
    "trips_per_hour_by_day": "trip_date date, day_name string, hour_of_day int, trip_count long",
}


def write_dashboard_extracts(tables: dict[str, DataFrame], path: str, sample_one_in: int = 10) -> dict[str, str]:
    """SNK9: the dashboard's CSV extracts from the gold tables, plus a repeatable trip sample."""
    out = {
        "dim_zone": tables["dim_zone"].select("zone_code", "latitude", "longitude", "zone_key"),
        "dim_date": tables["dim_date"],
        "gold_daily_kpis": tables["daily_kpis"],
        "fact_zone_daily_agg": tables["zone_daily"],
        "trips_per_hour_by_day": tables["hourly_trips"],
        "fact_trip_sample": sample_by_hash(tables["fact_trip"], "booking_id", sample_one_in),
    }
    paths = {}
    for name, df in out.items():
        paths[name] = f"{path}/{name}"
        export_csv(df, paths[name])
    return paths


def read_extract(spark: SparkSession, path: str, name: str, schema: StructType | None = None) -> DataFrame:
    """SRC6: an extract read with its explicit schema (dates parsed as dates, no inference). The trip
    sample has the fact table's ``schema``, which the caller gives."""
    known = EXTRACT_SCHEMAS[name] or schema
    if known is None:
        raise ValueError(f"{name} needs the schema of the table it was taken from")
    return (spark.read.schema(known).option("header", True)
            .option("mode", "FAILFAST").csv(f"{path}/{name}"))
