"""Sketches per date, footers of files, cells of vectors, the compacted tile."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.operators import sketches as K
from ridemart.operators import vector as V
from ridemart.plans.warehouse import column_profile, footer_profile, footer_session
from ridemart.session import ensure_checkpoint_dir
from ridemart.streaming import live


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_sketches_merge_to_the_stated_errors(spark):
    r = np.random.default_rng(4)
    a, b = r.normal(0, 1, 6000), r.normal(0.7, 1.5, 5000)
    few = r.integers(0, 5, 11000)
    rows = [(i % 40 if i < 6000 else 40 + i % 30, float(x) if i % 9 else None, float(few[i]), None)
            for i, x in enumerate(np.r_[a, b])]
    df = spark.createDataFrame(rows, "d int, x double, few double, none double")
    sk = K.date_sketches(df, "d", ["x", "few", "none"])
    assert sk.count() == 70 * 3
    got = {x.column_name: x for x in K.drift(K.merged(sk.where("date < 40")), K.merged(sk.where("date >= 40"))).collect()}
    xa, xb = ([v for d, v, _, _ in rows if v is not None and (d < 40) == side] for side in (True, False))
    x = got["x"]
    assert (x.rows_before, x.rows_after) == (6000, 5000) and x.nulls_before == 6000 - len(xa)
    assert (x.min_before, x.max_after) == (min(xa), max(xb))
    assert abs(x.distinct_before - len(set(xa))) <= K.DISTINCT_ERROR * len(set(xa))
    assert abs(np.mean(np.array(xa) <= x.median_before) - 0.5) <= K.RANK_ERROR
    grid = np.sort(np.r_[xa, xb])
    true = np.abs(np.searchsorted(np.sort(xa), grid, "right") / len(xa) - np.searchsorted(np.sort(xb), grid, "right") / len(xb)).max()
    assert true > 0.2 and abs(x.distance - true) <= K.DISTANCE_ERROR
    assert got["few"].distinct_before == 5 and got["few"].distance <= 0.05
    assert got["none"].distance is None and got["none"].median_before is None and got["none"].nulls_after == 5000
    assert K.date_sketches(df.limit(0), "d", ["x"]).count() == 0


def test_footers_are_read_without_columns(spark, folder):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("flag"), F.when(F.col("id") > 9, F.col("id") / 4).alias("x"),
                                  F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                                  F.col("id").cast("string").alias("s"), F.lit(None).cast("int").alias("none"))
    df.repartition(3).write.parquet(f"{folder}/t")
    df.limit(0).write.parquet(f"{folder}/e")
    out = footer_profile(spark, {"t": f"{folder}/t", "e": f"{folder}/e"})
    got = {(r.table, r.column_name): (r.type, r.rows, r.non_null, r.min, r.max) for r in out.collect()}
    assert got["t", "id"] == ("bigint", 1000, 1000, 0.0, 999.0) and got["t", "x"] == ("double", 1000, 990, 2.5, 249.75)
    assert got["t", "day"] == ("date", 1000, 1000, 18262.0, 19261.0) and got["t", "flag"][3:] == (0.0, 1.0)
    assert got["t", "s"] == ("string", 1000, 1000, None, None) and got["t", "none"] == ("int", 1000, 0, None, None)
    assert got["e", "id"] == ("bigint", 0, 0, None, None)
    gap = spark.range(20, numPartitions=2).select(F.when(F.col("id") > 9, F.col("id")).alias("half"))
    gap.write.parquet(f"{folder}/g")  # one file without a value
    assert [tuple(r)[3:] for r in footer_profile(spark, {"g": f"{folder}/g"}).collect()] == [(20, 10, 10.0, 19.0)]
    df.drop("none").repartition(3).write.parquet(f"{folder}/u")
    plain = footer_profile(spark, {"u": f"{folder}/u"}).collect()
    assert {(r.column_name, r.rows, r.non_null, r.min, r.max) for r in plain} == {(c, *v[1:]) for (t, c), v in got.items() if t == "t" and c != "none"}
    plan = column_profile(footer_session(spark).read.parquet(f"{folder}/u"), {"id"})._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "BatchScan" in line]
    assert len(scans) == 1 and "PushedAggregation: [COUNT(*), COUNT(id), MIN(id)" in scans[0]


def _triples(df):
    """Rows of an answer; ranks follow from similarity and id, but for equal directions that differ in rounding."""
    return sorted((r.query_id, -1 if r.similarity is None else round(r.similarity, 9), r.id) for r in df.collect())


def test_cells_give_the_full_answer_from_few_rows(spark, folder):
    ensure_checkpoint_dir(spark)
    r = np.random.default_rng(5)
    centres = r.normal(0, 1, (40, 24))
    vectors = centres[r.integers(0, 40, 4000)] + r.normal(0, 0.05, (4000, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5001, [0.0] * 24), (5002, [1.0]), (5003, rows[7][1]), (5004, [float("nan")] * 24),
             (5005, [x * 1e200 for x in rows[7][1]])]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(i, [float(x) for x in c + 0.02]) for i, c in enumerate(centres[:12])] + [(90, rows[7][1])],
                                  "query_id long, query_vec array<double>")
    cells = V.build_cells(emb, f"{folder}/cells", n_cells=40, fit_rows=2000)
    assert sum(cells.rows.values()) == len(rows) and cells.rows[V.NO_CELL] == 4
    found, pairs = V.search_cells(spark, cells, asked, k=10, probes=2, shard_rows=150, block_rows=5)
    assert _triples(found) == _triples(V.top_k(emb, asked, k=10))
    looked = sum(cells.rows[p.cell] for p in pairs.collect())
    assert looked <= 0.25 * len(rows) * 13


def test_cells_with_nothing_to_find(spark, folder):
    ensure_checkpoint_dir(spark)
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 1.0]), (5, [2.0, 0.0]), (6, [1.0])],
                                "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(9, [1.0, 0.0]), (10, None), (11, [0.0, 0.0])], "query_id long, query_vec array<double>")
    cells = V.build_cells(emb, f"{folder}/a", n_cells=2)
    assert _triples(V.search_cells(spark, cells, asked, k=5, probes=1)[0]) == _triples(V.top_k(emb, asked, k=5))
    empty = V.build_cells(emb.limit(0), f"{folder}/b", n_cells=2)
    assert empty.rows == {} and V.search_cells(spark, empty, asked)[0].count() == 0
    lost = V.build_cells(emb.where("vec_id IN (2, 3)"), f"{folder}/c", n_cells=2)
    assert [x[2] for x in _triples(V.search_cells(spark, lost, asked.limit(1), k=5)[0])] == [2, 3]


def test_compacted_tile_reads_one_folder(spark, folder):
    out = f"{folder}/out"
    keys = ["w", "k"]

    def batch(n, rows):
        spark.createDataFrame(rows, "w int, k string, trips long").withColumn("batch_id", F.lit(n).cast("long")).write.parquet(f"{out}/batch_id={n}")

    def tile():
        return sorted(map(tuple, live.latest_tile(spark, out, keys).select("w", "k", "trips").collect()))

    batch(0, [(1, "a", 1), (1, "b", 2)])
    batch(1, [(1, "a", 5), (2, "a", 1)])
    want = [(1, "a", 5), (1, "b", 2), (2, "a", 1)]
    assert tile() == want
    live.compact_tile(spark, out, keys)
    assert tile() == want and len(live.latest_tile(spark, out, keys).inputFiles()) >= 1
    assert all("tile=1" in f for f in live.latest_tile(spark, out, keys).inputFiles())
    batch(2, [(2, "a", 7)])
    assert tile() == [(1, "a", 5), (1, "b", 2), (2, "a", 7)]
    live.compact_tile(spark, out, keys)
    live.compact_tile(spark, out, keys)  # nothing new: nothing changes
    assert tile() == [(1, "a", 5), (1, "b", 2), (2, "a", 7)]
    batch(1, [(1, "a", 99)])  # a folder left from before the tile is not read
    assert tile() == [(1, "a", 5), (1, "b", 2), (2, "a", 7)]
