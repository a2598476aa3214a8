"""Operator 3, approximate nearest neighbours with randomly rotated one-bit codes.

Vectors are normalised, so inner products are cosines. A code is the sign of each coordinate of the
rotated residual (vector less centre), packed into bytes, with two correction scalars: the residual's
length and its inner product with its own code. For a query the code gives an unbiased estimate of
the inner product and an error bound; only vectors whose upper bound reaches the k-th best lower
bound are reranked with the original vectors in double precision.

Queries meet all rows in blocks: rows are dealt to shards of bounded size, queries to blocks of bounded
size, and each (shard, block) cell is one group that returns at most k rows per query. The centre
comes from all vectors.

Defined results: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components take no part, as do rows with a null id; repeated rows are candidates each; ties
go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import read_table, stored

#: Vectors in one shard and queries in one block: what one group holds.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
#: Width of the error bound in standard deviations of the estimate.
EPSILON = 4.0


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """Packed bits, residual lengths and inner products of residual and code, of unit rows ``x``."""
    residual = (x - centre) @ turn
    length = np.linalg.norm(residual, axis=1)
    unit = residual / np.maximum(length, 1e-300)[:, None]
    return np.packbits(unit > 0, axis=1), length, np.abs(unit).sum(1) / np.sqrt(x.shape[1])


def estimate(codes: np.ndarray, length: np.ndarray, inner: np.ndarray, q: np.ndarray, offset: np.ndarray,
             centre: np.ndarray, turn: np.ndarray, epsilon: float = EPSILON):
    """Estimated cosines (rows by queries) and error bounds. offset: each row's inner product with the
    centre."""
    d = q.shape[1]
    rq = (q - centre) @ turn
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * np.float32(2) - np.float32(1)
    dot = (signs @ rq.T.astype(np.float32)).astype(np.float64) / np.sqrt(d)
    shift = offset[:, None] + (q @ centre)[None, :] - centre @ centre
    # a row that is the centre has residual and inner product 0: the shift is its cosine
    scale = np.divide(length, inner, out=np.zeros(len(length)), where=inner > 0)
    est = dot * scale[:, None] + shift
    spread = scale * np.sqrt(np.maximum(0.0, 1 - inner ** 2)) / np.sqrt(max(1, d - 1))
    return est, epsilon * spread[:, None] * np.linalg.norm(rq, axis=1)[None, :] + 1e-6


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) with the vectors that take part, as doubles."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = (F.col(id_col).isNotNull() & (F.size("v") > 0)
            & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0))
    found = df.select(F.col(id_col).cast("long").alias(id_col), v.alias("v")).where(fine)
    # cosines do not change when a vector is divided by its largest component, and no square leaves the range of a double;
    # by a power of two, so that the division is exact
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    power = F.least(F.greatest(F.floor(F.log2(largest)), F.lit(-1022)), F.lit(1022)).cast("double")
    scaled = F.transform("v", lambda x: x / F.pow(F.lit(2.0), power))
    return found.select(F.col(id_col).alias("vec_id"), scaled.alias("v"), F.size("v").alias("d"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
           vec_col: str = "embedding", epsilon: float = EPSILON, shard_rows: int = SHARD_ROWS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, without rows that have
    the query's own id."""
    base = stored(usable(vectors, id_col, vec_col), "ann-vectors")
    asked = usable(queries, id_col, vec_col)
    stats = base.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if stats is None:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = stats["d"], stats["count"]
    base, asked = base.where(F.col("d") == d), asked.where(F.col("d") == d)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    mean = base.select(F.posexplode(F.transform("v", lambda x: x / norm)).alias("i", "x")).groupBy("i").agg(
        F.avg("x").alias("x"))
    centre = np.zeros(d)
    for r in mean.collect():  # d rows
        centre[r.i] = r.x
    turn = rotation(d)
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))

    def index(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, d)
            codes, length, inner = encode(x / np.linalg.norm(x, axis=1)[:, None], centre, turn)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length),
                 pa.array(inner)], names=["vec_id", "v", "code", "length", "inner"])

    coded = base.select("vec_id", "v").mapInArrow(
        index, "vec_id long, v array<double>, code binary, length double, inner double")

    def every(n_values: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n_values - 1)))

    # places come from contents, so that a lost task gives the same shard again
    rows = coded.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn(
        "block", every(blocks))
    wanted = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"),
                          F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"),
                          every(shards).alias("shard"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if left.num_rows and right.num_rows:
            x = left["v"].combine_chunks().flatten().to_numpy().reshape(-1, d)
            q = right["qv"].combine_chunks().flatten().to_numpy().reshape(-1, d)
            ids, qids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            xn, qn = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
            codes = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(len(x), -1)
            offset = (x / xn[:, None]) @ centre
            for s in range(0, len(q), 128):
                est, bound = estimate(codes, left["length"].to_numpy(), left["inner"].to_numpy(),
                                      q[s:s + 128] / qn[s:s + 128, None], offset, centre, turn, epsilon)
                for j in range(est.shape[1]):
                    own = ids == qids[s + j]
                    low = np.where(own, -np.inf, est[:, j] - bound[:, j])
                    keep = min(k, int((~own).sum()))
                    if not keep:
                        continue
                    floor = np.partition(low, len(low) - keep)[len(low) - keep]
                    c = np.flatnonzero((est[:, j] + bound[:, j] >= floor) & ~own)
                    score = np.einsum("ij,j->i", x[c], q[s + j]) / (xn[c] * qn[s + j])
                    best = np.lexsort((ids[c], -score))[:k]
                    out_q += [qids[s + j]] * len(best)
                    out_v += ids[c][best].tolist()
                    out_s += score[best].tolist()
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())],
                        names=["query_id", "vec_id", "score"])

    near = rows.groupBy("shard", "block").cogroup(wanted.groupBy("shard", "block")).applyInArrow(
        cell, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_rotated_bit_search(spark, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0))
