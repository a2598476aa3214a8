"""Data quality (DQ1-6): counted rules in expect / drop / fail modes, quarantine with reasons,
one-pass reports, profiles with drift, key checks.

A rule is a boolean Column that must hold; NULL counts as a failure. All counting happens in a
single aggregate pass per table (``count_if`` per rule), never one job per rule.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ridemart.sources import storage
from ridemart.sources.files import CODEC

EXPECT, DROP, FAIL = "expect", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column
    mode: str = EXPECT   # expect: count only; drop: quarantine the row; fail: abort the load

    def passed(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))


class ExpectationFailed(Exception):
    pass


def _failed_names(rules: list[Rule], modes: tuple[str, ...]) -> Column:
    return F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules
                                     if r.mode in modes]))


def annotate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """DQ3: add ``_failed_rules`` (every failing rule) and ``_quarantine`` (a drop/fail rule failed)."""
    return (df.withColumn("_failed_rules", _failed_names(rules, (EXPECT, DROP, FAIL)))
            .withColumn("_quarantine", F.size(_failed_names(rules, (DROP, FAIL))) > 0))


def apply_rules(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """DQ1-3: (clean rows, quarantined rows with their reasons). Raises when a fail-mode rule
    fails (DQ2 constraints) -- checked with one aggregate before anything is written."""
    fail_rules = [r for r in rules if r.mode == FAIL]
    if fail_rules:
        counts = df.agg(*[F.count_if(~r.passed()).alias(r.name) for r in fail_rules]).first()
        broken = {r.name: counts[r.name] for r in fail_rules if counts[r.name]}
        if broken:
            raise ExpectationFailed(f"constraint violations: {broken}")
    a = annotate(df, rules)
    clean = a.where(~F.col("_quarantine")).drop("_failed_rules", "_quarantine")
    quarantined = (a.where(F.col("_quarantine")).drop("_quarantine")
                   .withColumn("reasons", F.array_join("_failed_rules", ","))
                   .drop("_failed_rules"))
    return clean, quarantined


def checked_write(df: DataFrame, target: str, rules: list[Rule], rejects: str | None = None) -> dict[str, int]:
    """DQ1-2 inside the write: rows, and rows that fail each rule, counted by the tasks that write them.

    One pass: rows go to a staged folder beside ``target``, kept and quarantined ones apart, while ``observe``
    counts them (a table is written by the last stage, whose tasks count once even if they are run again). Only
    when no fail-mode rule has failed do the folders take the place of ``target`` and ``rejects``;
    otherwise the staged rows go, the held table stays as it was, and ExpectationFailed tells the counts."""
    spark = df.sparkSession
    staged = f"{target.rstrip('/')}__staged-{uuid.uuid4().hex}"
    names = {f"f{i}": r.name for i, r in enumerate(rules)}
    counters = [F.count_if(~r.passed()).alias(f"f{i}") for i, r in enumerate(rules)]
    seen = Observation()
    marked = annotate(df, rules).observe(seen, F.count(F.lit(1)).alias("rows"), *counters)
    apart = any(r.mode == DROP for r in rules)
    if apart:  # quarantined rows in folders named by their reasons, kept ones in the folder without any
        reasons = F.when(F.col("_quarantine"), F.array_join("_failed_rules", ","))
        marked.withColumn("reasons", reasons).drop("_failed_rules", "_quarantine").write.option("compression", CODEC).partitionBy("reasons").parquet(staged)
    else:
        marked.drop("_failed_rules", "_quarantine").write.option("compression", CODEC).parquet(staged)
    counts = {"rows": seen.get["rows"], **{name: seen.get[k] for k, name in names.items()}}
    broken = {r.name: counts[r.name] for r in rules if r.mode == FAIL and counts[r.name]}
    if broken:
        storage.remove(spark, staged)
        raise ExpectationFailed(f"constraint violations: {broken}")
    if not apart:
        storage.replace(spark, staged, target)
        return counts
    kept = f"{staged}/reasons=__HIVE_DEFAULT_PARTITION__"
    if not storage.exists(spark, kept):
        df.limit(0).write.parquet(kept)
    storage.replace(spark, kept, target)
    if rejects is None:
        storage.remove(spark, staged)
        return counts
    if not any(f.startswith("reasons=") for f in storage.names(spark, staged)):
        df.limit(0).withColumn("reasons", F.lit("")).write.mode("overwrite").parquet(staged)
    storage.replace(spark, staged, rejects)
    return counts


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """DQ4: per rule -- mode, rows checked, passed, failed -- from one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(~r.passed()).alias(f"_f{i}"))
    row = df.agg(*aggs)
    stacked = ", ".join(f"'{r.name}', '{r.mode}', _f{i}" for i, r in enumerate(rules))
    out = row.selectExpr("_rows", f"stack({len(rules)}, {stacked}) AS (rule, mode, failed)")
    return out.select("rule", "mode", F.col("_rows").alias("rows_checked"),
                      (F.col("_rows") - F.col("failed")).alias("passed"), "failed")


# ------------------------------------------------------------------------------- rule sets

def weather_rules() -> list[Rule]:
    """The silver weather validation (FLT3-4) as counted drop rules."""
    return [
        Rule("humidity_in_range", F.col("humidity").between(0, 100), DROP),
        Rule("cloud_cover_in_range", F.col("cloud_cover").between(0, 100), DROP),
        Rule("temperature_present", F.col("avg_temp_c").isNotNull(), DROP),
        Rule("date_present", F.col("date").isNotNull(), DROP),
    ]


def fact_rules() -> list[Rule]:
    """DQ2 constraints of the fact: a key that is missing or repeated must never be published."""
    return [Rule("trip_key_present", F.col("trip_key").isNotNull(), FAIL),
            Rule("fare_not_negative", F.coalesce(F.col("fare_amount") >= 0, F.lit(True)), FAIL),
            Rule("booked_for_date_known", F.col("trip_booked_for_date_key").isNotNull(), EXPECT)]


def silver_trip_rules() -> list[Rule]:
    """Silver booking constraints and expectations (DQ2)."""
    return [
        Rule("booking_id_present", F.col("booking_id").isNotNull(), DROP),
        Rule("pickup_due_present", F.col("pickup_due_ts").isNotNull(), EXPECT),
        Rule("price_non_negative", F.col("price") >= 0, DROP),
        Rule("distance_non_negative", F.col("distance") >= 0, DROP),
        Rule("completed_after_pickup", F.col("completed_ts") >= F.col("time_picked_up_ts"), EXPECT),
        Rule("pickup_zone_present", F.col("pickup_zone").isNotNull(), EXPECT),
        Rule("duration_under_cap",
             (F.unix_timestamp("completed_ts") - F.unix_timestamp("time_picked_up_ts")) <= 120 * 60,
             EXPECT),
    ]


def bronze_parse_rules() -> list[Rule]:
    """Row-level reject reasons for the silver parse: text that is present but does not parse
    (bad timestamp, bad number) is counted here instead of silently becoming NULL."""
    from ridemart.functions import expr as X
    from ridemart.sources.schemas import SILVER_SPEC

    rules = []
    for name, raw, kind in SILVER_SPEC:
        c = F.col(f"`{raw}`")
        blank = c.isNull() | (F.trim(c) == "")
        if kind == "ts":
            parsed = X.parse_ts(c)
        elif kind == "number":
            parsed = X.parse_number(c)
        elif kind == "int":
            parsed = X.parse_int(c)
        elif kind == "double":
            parsed = c.try_cast("double")
        else:
            continue
        rules.append(Rule(f"{name}_parses", blank | parsed.isNotNull(), EXPECT))
    return rules


# --------------------------------------------------------------------------- profiles, drift

def profile(df: DataFrame, columns: list[str], approx_distinct: bool = False) -> DataFrame:
    """DQ5: per column -- rows, nulls, min, max, mean, sample stddev (one aggregate pass)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.min(x).alias(f"mi{i}"),
                 F.max(x).alias(f"ma{i}"), F.avg(x).alias(f"me{i}"), F.stddev(x).alias(f"sd{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"ad{i}"))
    row = df.agg(*aggs)
    parts = []
    for i, c in enumerate(columns):
        fields = [F.lit(c).alias("column_name"), F.col("_rows").alias("rows"),
                  F.col(f"n{i}").alias("nulls"), F.col(f"mi{i}").alias("min"),
                  F.col(f"ma{i}").alias("max"), F.col(f"me{i}").alias("mean"),
                  F.col(f"sd{i}").alias("stddev")]
        if approx_distinct:
            fields.append(F.col(f"ad{i}").alias("approx_distinct"))
        parts.append(F.struct(*fields))
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """DQ5: two profiles side by side with mean shift in units of the earlier stddev and the
    change in null rate."""
    b = before.select("column_name", *[F.col(c).alias(f"{c}_before")
                                       for c in ("rows", "nulls", "mean", "stddev")])
    a = after.select("column_name", *[F.col(c).alias(f"{c}_after")
                                      for c in ("rows", "nulls", "mean", "stddev")])
    j = b.join(a, "column_name", "full")
    return j.select(
        "column_name", "rows_before", "rows_after", "mean_before", "mean_after",
        F.try_divide(F.col("mean_after") - F.col("mean_before"), F.col("stddev_before"))
        .alias("mean_shift_sd"),
        (F.try_divide(F.col("nulls_after"), F.col("rows_after"))
         - F.try_divide(F.col("nulls_before"), F.col("rows_before"))).alias("null_rate_change"))


# ------------------------------------------------------------------------------- key checks

def key_checks(fact: DataFrame, dim_date: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """DQ6: primary keys unique and foreign keys resolving, as (check, violations) rows.

    One scan of the fact looks up all foreign keys; each primary key is one count by key."""
    links = [("trip_booked_for_date_key", dim_date, "date_key"), ("pickup_zone_key", dim_zone, "zone_key"),
             ("destination_zone_key", dim_zone, "zone_key")]
    looked = fact.select(*[fk for fk, _, _ in links])
    for i, (fk, dim, pk) in enumerate(links):
        known = dim.select(F.col(pk).alias(f"_pk{i}")).distinct()
        looked = looked.join(known, F.col(fk) == F.col(f"_pk{i}"), "left")
    names = [f"fact_trip.{fk} resolves" for fk, _, _ in links]
    orphans = looked.agg(*[F.count_if(F.col(fk).isNotNull() & F.col(f"_pk{i}").isNull()).alias(name)
                           for i, ((fk, _, _), name) in enumerate(zip(links, names))])
    out = orphans.unpivot([], [F.col(f"`{n}`") for n in names], "check", "violations")

    for table, df, key in (("fact_trip", fact, "trip_key"), ("fact_trip", fact, "booking_id"), ("dim_date", dim_date, "date_key"),
                           ("dim_zone", dim_zone, "zone_key"), ("dim_zone", dim_zone, "zone_code")):
        repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)
        out = out.unionByName(repeated.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("violations"))
                              .select(F.lit(f"{table}.{key} unique").alias("check"), "violations"))
    return out
