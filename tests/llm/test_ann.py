import numpy as np
import pytest

from ridemart.llm import ann

SF = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        v = np.array(v, float)
        s = [(-float(np.dot(np.array(x, float), v) / np.sqrt((np.array(x, float) ** 2).sum() * (v ** 2).sum())), i)
             for i, x in rows if i != q]
        out[q] = sorted(s)[:k]
    return out


def test_recall_and_scores_on_all_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = {}
    for r in ann.op3_rotated_bit_search(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, w in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        hits += len({m[1] for m in mine} & {i for _, i in w})
        assert mine[0][2] == pytest.approx(-w[0][0], abs=1e-12)
    assert hits >= 0.9 * 5 * len(want)


def test_shards_and_blocks_give_the_same(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    q = df.where("vec_id % 25 = 0")
    one = {tuple(r) for r in ann.search(df, q).select("query_id", "rank", "vec_id").collect()}
    many = {tuple(r) for r in ann.search(df, q, shard_rows=60, block_rows=7).select("query_id", "rank", "vec_id").collect()}
    assert len(one & many) >= 0.95 * len(one)


def test_error_bound_holds():
    r = np.random.default_rng(1)
    x = r.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    c, t = x.mean(0), ann.rotation(64)
    assert np.allclose(t @ t.T, np.eye(64))
    codes, length, inner = ann.encode(x, c, t)
    assert codes.shape == (400, 8)
    est, bound = ann.estimate(codes, length, inner, x[:50], x @ c, c, t)
    assert (np.abs(est - x @ x[:50].T) <= bound).mean() > 0.999


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [0.0, -1.0])]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, code string")
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(df, df.where("vec_id = 0")).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 2, 1.0), (0, 4, 10, 0.0)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    assert ann.search(df, df.limit(0)).count() == 0


def test_copies_of_one_vector(spark):
    """All rows are the centre: the nearest are the least ids, with cosine 1."""
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(8)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, df.where("vec_id in (0, 5)"), k=3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got == {0: {1: (1, 1.0), 2: (2, 1.0), 3: (3, 1.0)}, 5: {1: (0, 1.0), 2: (1, 1.0), 3: (2, 1.0)}}


def test_components_of_extreme_size(spark):
    rows = [(0, [1e200, 1e200]), (1, [1.0, 0.0]), (2, [1e-200, 0.0]), (3, [5e-324, 5e-324]), (4, [0.0, 1.7e308]), (5, [-1e300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.search(df, df, k=5).collect()}
    unit = {0: (0.5 ** 0.5, 0.5 ** 0.5), 1: (1, 0), 2: (1, 0), 3: (0.5 ** 0.5, 0.5 ** 0.5), 4: (0, 1), 5: (-1, 0)}
    assert len(got) == 30
    for (q, v), score in got.items():
        assert abs(score - sum(a * b for a, b in zip(unit[q], unit[v]))) < 1e-12, (q, v)
