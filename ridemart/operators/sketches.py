"""Mergeable sketches per date (DQ5): profiles and drift of any two ranges of dates without scanning the fact again.

``date_sketches`` keeps, per date and column, exact counts and extremes, a HyperLogLog sketch of the values and a KLL
sketch of their quantiles, from one pass with partial aggregation. ``merged`` adds up the dates of a range; ``drift`` sets two
ranges side by side, with the largest difference of their distribution functions beside counts and extremes.

Stated errors: distinct counts 5 % (sketches of 2**12 registers, three standard errors), ranks ``RANK_ERROR`` (KLL with k = 400),
distribution distance ``DISTANCE_ERROR``: twice the grid's spacing and two rank errors, rounded up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS, KLL_K = 12, 400
DISTINCT_ERROR, RANK_ERROR, DISTANCE_ERROR = 0.05, 0.01, 0.05
#: Ranks at which two distributions are compared.
GRID = [i / 100 for i in range(1, 100)]


def date_sketches(df: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """(date, column_name, rows, nulls, min, max, distinct_sketch, quantile_sketch), one row per date and column. NaN
    counts as null; rows without a date are a group of their own."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count_if(x.isNull()).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x)), F.lit(LG_REGISTERS)).alias(f"d{i}"),
                 F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"q{i}")]
    by_date = df.groupBy(F.col(date).alias("date")).agg(*aggs)
    per = F.array(*[F.struct(F.lit(c).alias("column_name"), "rows", F.col(f"n{i}").alias("nulls"), F.col(f"lo{i}").alias("min"),
                             F.col(f"hi{i}").alias("max"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch"))
                    for i, c in enumerate(columns)])
    return by_date.select("date", F.explode(per).alias("s")).select("date", "s.*")


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column over all dates of ``sketches``; ``median`` and ``distinct`` are NULL where there is no value."""
    some = F.col("rows") > F.col("nulls")
    total = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double(F.when(some, F.col("quantile_sketch"))).alias("quantile_sketch"))
    return total.withColumns({"distinct": F.when(some, F.hll_sketch_estimate("distinct_sketch")),
                              "median": F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5)))})


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two merged ranges side by side. ``distance``: the largest difference of the two distribution functions
    (Kolmogorov-Smirnov) at the quantiles of either; NULL where a side has no values."""
    names = [c for c in before.columns if c != "column_name"]
    b = before.select("column_name", *[F.col(c).alias(f"{c}_before") for c in names])
    a = after.select("column_name", *[F.col(c).alias(f"{c}_after") for c in names])
    ranks = F.array(*[F.lit(r) for r in GRID])
    both = ((F.col("rows_before") > F.col("nulls_before")) & (F.col("rows_after") > F.col("nulls_after")))
    joined = b.join(a, "column_name", "full")
    for side in ("before", "after"):
        joined = joined.withColumn(f"_q_{side}", F.when(both, F.kll_sketch_get_quantile_double(f"quantile_sketch_{side}", ranks)))

    def at_most(side: str, x):
        """Share of the values up to ``x``, to the grid's spacing."""
        return F.size(F.filter(F.col(f"_q_{side}"), lambda v: v <= x)) / F.lit(len(GRID) + 1)

    apart = F.transform(F.concat("_q_before", "_q_after"), lambda x: F.abs(at_most("before", x) - at_most("after", x)))
    out = joined.withColumn("distance", F.array_max(apart))
    return out.drop("_q_before", "_q_after", *[f"{c}_{side}" for c in ("distinct_sketch", "quantile_sketch") for side in ("before", "after")])
