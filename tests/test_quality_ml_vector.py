"""Quality rules, features, exact medians, models and vector search."""

import math

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from ridemart.operators import features as FE
from ridemart.operators import model as M
from ridemart.operators import quality as Q
from ridemart.operators import vector as V
from ridemart.plans.warehouse import warehouse


def test_rules_modes_and_report(spark):
    df = spark.createDataFrame([(1, 50), (2, 101), (3, None), (None, 20)], "id int, h int")
    rules = [Q.Rule("id_present", F.col("id").isNotNull(), Q.EXPECT),
             Q.Rule("h_in_range", F.col("h").between(0, 100), Q.DROP)]
    clean, quarantined = Q.apply_rules(df, rules)
    assert sorted(r.id for r in clean.collect() if r.id) == [1]
    assert clean.count() == 2  # expect-mode failure (NULL id) is kept
    reasons = {r.id: r.reasons for r in quarantined.collect()}
    assert reasons == {2: "h_in_range", 3: "h_in_range"}
    rep = {r.rule: (r.passed, r.failed) for r in Q.report(df, rules).collect()}
    assert rep == {"id_present": (3, 1), "h_in_range": (2, 2)}
    with pytest.raises(Q.ExpectationFailed):
        Q.apply_rules(df, [Q.Rule("h_present", F.col("h").isNotNull(), Q.FAIL)])


def test_profile_and_drift(spark):
    a = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    b = spark.createDataFrame([(3.0,), (4.0,), (None,)], "x double")
    d = Q.drift(Q.profile(a, ["x"]), Q.profile(b, ["x"])).first()
    assert d["mean_before"] == 2.0 and d["mean_after"] == 3.5
    assert math.isclose(d["mean_shift_sd"], 1.5)
    assert math.isclose(d["null_rate_change"], 1 / 3)


def test_exact_medians_against_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.integers(0, 50, size=1001).astype(float)
    rows = [(float(v), float(v) * 2 if i % 3 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double")
    med = {r.column_name: r.median for r in FE.exact_medians(df, ["a", "b"]).collect()}
    assert med["a"] == float(np.median(vals))
    bvals = [r[1] for r in rows if r[1] is not None]
    assert med["b"] == float(np.median(bvals))


def test_feature_rules(spark):
    wh = warehouse(spark, SF001)
    view = FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])
    feats = FE.feature_table(view)
    bad = feats.where("trip_duration_minutes <= 0 OR trip_duration_minutes >= 120 OR "
                      "distance <= 0 OR fare_amount >= 5000 OR destination_latitude IS NULL")
    assert bad.count() == 0
    assert feats.where("dispatch_to_arrival_minutes IS NULL").count() == 0
    split = FE.with_split(feats)
    a = {r.trip_key: r.split for r in split.collect()}
    b = {r.trip_key: r.split for r in FE.with_split(feats.repartition(3)).collect()}
    assert a == b


def test_models_and_metrics(spark):
    wh = warehouse(spark, SF001)
    feats = FE.with_split(FE.feature_table(
        FE.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"])))
    train, test = feats.where("split = 'train'"), feats.where("split = 'test'")
    specs = [M.ModelSpec("lr", "linear"),
             M.ModelSpec("rf", "forest", {"numTrees": 5, "maxDepth": 4, "seed": 42}),
             M.ModelSpec("rf_log", "forest", {"numTrees": 5, "maxDepth": 4, "seed": 42},
                         log_target=True, cap=120.0)]
    import tempfile
    runs = tempfile.mkdtemp(prefix="ridemart-runs-", dir="/tmp") + "/model_runs"
    out = {r.model: r for r in M.compare_models(train, test, specs, runs_path=runs).collect()}
    assert spark.read.parquet(runs).count() == 3  # ML12 run log
    assert set(out) == {"lr", "rf", "rf_log"}
    for r in out.values():
        assert r.n_test > 0 and r.mae >= 0 and r.rmse >= r.mae - 1e-9
    tr, te, _ = M.prepare(train, test)
    _, pred = M.fit_predict(specs[0], tr, te)
    p = [(r.actual, r.predicted) for r in pred.collect()]
    mae = sum(abs(a - b) for a, b in p) / len(p)
    assert math.isclose(M.regression_metrics(pred).first()["mae"], mae, rel_tol=1e-9)


def test_vector_top_k_against_brute_force(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = emb.collect()
    cents = V.centroids(emb)
    res = V.top_k(emb, cents, k=5, shard_rows=100, block_rows=1)  # several cells on purpose
    got = {}
    for r in res.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id))
    for c in cents.collect():
        q = np.array(c.query_vec)
        sims = []
        for e in rows:
            v = np.array(e.embedding, dtype=float)
            sims.append((-(v @ q) / (np.linalg.norm(v) * np.linalg.norm(q)), e.vec_id))
        want = [vid for _, vid in sorted(sims)[:5]]
        assert [i for _, i in sorted(got[c.query_id])] == want


def test_bronze_parse_rules_count_bad_text(spark):
    from conftest import booking_row, bronze_df
    df = bronze_df(spark, [booking_row(), booking_row(**{"Completed": "31/02/2026 10:00",
                                                         "Price": "n/a", "Priority": ""})])
    rep = {r.rule: r.failed for r in Q.report(df, Q.bronze_parse_rules()).collect()}
    assert rep["completed_ts_parses"] == 1 and rep["price_parses"] == 1
    assert rep["priority_parses"] == 0  # blank is missing, not malformed
    assert rep["pickup_due_ts_parses"] == 0


def test_exact_medians_narrow_to_a_bracket(spark):
    import random
    import statistics
    rnd = random.Random(5)
    cols = {"a": [rnd.gauss(0, 1) for _ in range(4001)], "b": [rnd.choice([1.0, 1.0, 2.0, 9.0]) for _ in range(4001)],
            "c": [None] * 4001, "d": [float(i % 2000) if i % 3 else None for i in range(4001)], "e": [rnd.random() * 10 ** rnd.randint(0, 9) for _ in range(4001)]}
    df = spark.createDataFrame([tuple(v[i] for v in cols.values()) for i in range(4001)], "a double, b double, c double, d double, e double")
    for most in (100_000, 20):
        got = {r.column_name: r.median for r in FE.exact_medians(df, list(cols), most=most).collect()}
        assert got == {k: statistics.median([x for x in v if x is not None]) for k, v in cols.items() if k != "c"}


def test_vector_top_k_odd_vectors(spark):
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 1.0]), (5, [2.0, 0.0]), (6, [1.0])],
                                "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, query_vec array<double>")
    got = sorted((r["rank"], r.id, r.similarity) for r in V.top_k(emb, q, k=5).collect())
    assert [g[1] for g in got] == [1, 5, 4, 2, 3] and got[3][2] is None
    plan = V.top_k(emb, q, k=5)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "posexplode" not in plan
