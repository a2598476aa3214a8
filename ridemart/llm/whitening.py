r"""Operator 12, embedding whitening by mixed-precision refinement.

Entries become integers (``floor(64 c) + 1000000``), so counts, sums and the covariance are exact: tasks
subtract an integer centre first, multiply small integers in blocks whose sums a double holds without rounding,
and Spark adds the tasks' matrices as decimals. Only matrices of dimension x dimension reach the driver.

There eigenvectors of the covariance are found in float32 and corrected with matrix products in extended
precision (Ogita and Aishima): each iteration about doubles the right digits. Eigenvalues closer to each
other than the present error form a cluster; a cluster's small projected matrix, less its mean eigenvalue, is solved by
itself, which separates what float32 could not, and the iteration goes on.

Defined results: vectors that are null, empty, of another length than most (ties: the shorter), or that hold null or
non-finite entries, or entries of 2**40 and more, take no part; a null id is kept; repeated rows count each; components without
variance have whitened 0 and are left out of the identity error; a deviation beyond a long is null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm.common import read_table, stored

SCALE, OFFSET = 64, 1_000_000
#: Entries below this keep floor(64 c) exact in a double and all sums within 38 digits.
LARGEST = float(1 << 40)
#: Bits of a limb and rows of a block: 2 * 20 + 12 bits, so a block's products add up exactly in a double.
LIMB, BLOCK = 20, 4096
ROUNDS = 16
_DECIMAL = pa.decimal128(38, 0)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x, d): the vectors that take part, as arrays of long."""
    fine = (F.col("v").isNotNull() & (F.size("v") > 0)
            & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST)))
    doubles = df.select(df[f"`{id_col}`"].cast("long").alias("vec_id"),
                        F.transform(df[f"`{vec_col}`"], lambda c: c.cast("double")).alias("v")).where(fine)
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET).cast("long"))
    return doubles.select("vec_id", x.alias("x"), F.size("v").alias("d"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def exact_gram(x: np.ndarray) -> np.ndarray:
    """x.T @ x of an integer matrix without rounding, as Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for s in range(0, len(x), BLOCK):
        block, limbs = x[s:s + BLOCK], []
        while np.abs(block).max(initial=0) >= 1 << LIMB:
            limbs.append((block & ((1 << LIMB) - 1)).astype(float))
            block = block >> LIMB
        limbs.append(block.astype(float))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def column_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sums per dimension), exact."""
    def sums(batches):
        n, total = 0, np.zeros(d, object)
        for b in batches:
            x = _matrix(b.column(0), d)
            n += len(x)
            for s in range(0, len(x), BLOCK):
                total += x[s:s + BLOCK].sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array([Decimal(int(t)) for t in total], _DECIMAL)], names=["i", "n", "s"])

    found = (vectors.select("x").mapInArrow(sums, "i int, n long, s decimal(38,0)").groupBy("i")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect())  # d rows
    return int(found[0].n), [int(r.s) for r in found]


def covariance(vectors: DataFrame, d: int, n: int, sums: list[int]) -> tuple[np.ndarray, list[int], list[int]]:
    """(n * n * covariance as exact integers, integer centre, n * (mean - centre))."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    offset = [s - n * m for s, m in zip(sums, centre)]
    m = np.array(centre, np.int64)
    upper = np.triu_indices(d)

    def grams(batches):
        total = None
        for b in batches:
            if b.num_rows:
                g = exact_gram(_matrix(b.column(0), d) - m)
                total = g if total is None else total + g
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()),
                                              pa.array([Decimal(int(g)) for g in total[upper]], _DECIMAL)], names=["i", "j", "g"])

    found = vectors.select("x").mapInArrow(grams, "i int, j int, g decimal(38,0)").groupBy("i", "j").agg(F.sum("g").alias("g"))
    gram = np.zeros((d, d), object)
    for r in found.collect():  # d * (d + 1) / 2 rows, whatever the table holds
        gram[r.i, r.j] = gram[r.j, r.i] = int(r.g)
    o = np.array(offset, object)
    return gram * n - np.outer(o, o), centre, offset


def extended(a: np.ndarray) -> np.ndarray:
    """Integers in extended precision: each as the sum of two doubles."""
    high = a.astype(float)
    low = np.array([int(v) - int(h) for v, h in zip(a.ravel(), high.ravel())], object).reshape(a.shape).astype(float)
    return high.astype(np.longdouble) + low.astype(np.longdouble)


def _state(a: np.ndarray, x: np.ndarray):
    """Defect of orthogonality, projected matrix, eigenvalues, and the distance below which two are one cluster."""
    r = np.eye(len(a), dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # rounding that is not symmetric would grow by 1 / gap and break orthogonality
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    return r, s, values, 2 * (np.sqrt((off ** 2).sum()) + np.sqrt((a ** 2).sum()) * np.sqrt((r ** 2).sum()))


def _corrected(x: np.ndarray, r: np.ndarray, s: np.ndarray, values: np.ndarray, apart) -> np.ndarray:
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= apart
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
    return x + x @ e


def _sub_solved(a: np.ndarray, x: np.ndarray, values: np.ndarray, apart) -> np.ndarray:
    """Each cluster's vectors turned by the eigenvectors of its own projected matrix, less its mean eigenvalue."""
    x, order = x.copy(), np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    for cluster in np.split(order, cuts):
        if len(cluster) > 1:
            own = x[:, cluster]
            small = own.T @ (a @ own - values[cluster].mean() * own)
            size = np.abs(small).max()
            if size > 4 * len(a) * np.finfo(x.dtype).eps:  # else the eigenvalues are equal: any basis will do
                x[:, cluster] = own @ _orthogonal(np.linalg.eigh(((small + small.T) / (2 * size)).astype(float))[1].astype(x.dtype))
    return x


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made orthonormal to the precision of their type."""
    return x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2


def eigen(a: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, largest entry positive) of a symmetric matrix in
    extended precision, refined from ``start`` (default: eigenvectors in float32)."""
    a = np.asarray(a, np.longdouble)
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / scale
    x = (np.linalg.eigh(a.astype(np.float32))[1] if start is None else start).astype(np.longdouble)
    best, kept = np.inf, x
    for _ in range(ROUNDS):
        r, s, values, apart = _state(a, x)
        if (np.abs(np.diff(np.sort(values))) <= apart).any() and np.abs(r).max() < 1e-3:
            x = _sub_solved(a, x, values, apart)
            r, s, values, apart = _state(a, x)
        left = max(np.abs(r).max(), np.abs(s - np.diag(np.diag(s))).max())
        if left >= best / 2 and left < 1e-15:
            break
        if left < best:
            best, kept = left, x
        x = _corrected(x, r, s, values, apart)
    x = _orthogonal(kept)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order] * scale, x * np.where(x[np.abs(x).argmax(0), np.arange(len(a))] < 0, -1, 1)


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, dict]:
    """((vec_id, deviation, whitened), model): ``whitened`` is an array of at most ``components`` doubles; ``model`` has n,
    the eigenvalues, vectors, explained shares and identity_error."""
    spark = vectors.sparkSession
    base = stored(integer_vectors(vectors, id_col, vec_col), "whiten-integers")
    stats = base.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    schema = "vec_id long, deviation long, whitened array<double>"
    if stats is None:
        return spark.createDataFrame([], schema), {"n": 0, "explained": [], "identity_error": 0.0}
    d = stats["d"]
    base = base.where(F.col("d") == d).select("vec_id", "x")
    n, sums = column_sums(base, d)
    squared, centre, offset = covariance(base, d, n, sums)
    values, axes = eigen(extended(squared) / (np.longdouble(n) * np.longdouble(n)))
    k = min(components, d)
    trace = values.sum()
    some = values[:k] > d * np.finfo(float).eps * max(values[0], 0)
    values, axes = values[:k], axes[:, :k]
    turn = np.where(some, axes / np.sqrt(np.where(some, values, 1)), 0).astype(float)
    m, o = np.array(centre, np.int64), np.array(offset, object)
    shift = np.array([v / n for v in offset])
    most_offset = max(abs(v) for v in offset)

    def project(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b.column(1), d) - m
            size = n * int(np.abs(y).max()) + most_offset
            if size * size * d < 1 << 63:
                z = y * n - o.astype(np.int64)
                deviation = pa.array((z * z).sum(1), pa.int64())
            else:
                z = y.astype(object) * n - o
                deviation = pa.array([v if v < 1 << 63 else None for v in (z * z).sum(1).tolist()], pa.int64())
            white = (y - shift) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), deviation, lists], names=["vec_id", "deviation", "whitened"])

    done = stored(base.mapInArrow(project, schema), "whitened")
    return done, {"n": n, "values": values, "axes": axes, "explained": [float(v / trace) if trace > 0 else 0.0 for v in values],
                  "identity_error": identity_error(done, k, n, some)}


def identity_error(white: DataFrame, k: int, n: int, some: np.ndarray) -> float:
    """Largest absolute entry of the covariance of ``whitened`` less the identity, measured on all rows."""
    upper = np.triu_indices(k)

    def moments(batches):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            w = _matrix(b.column(0), k)
            total += w.T @ w
            sums += w.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[upper[0], np.arange(k)], pa.int32()), pa.array(np.r_[upper[1], np.full(k, -1)], pa.int32()),
             pa.array(np.r_[total[upper], sums])], names=["i", "j", "s"])

    # decimals: the sum doesn't depend on the order of the tasks
    found = (white.select("whitened").mapInArrow(moments, "i int, j int, s double").groupBy("i", "j")
             .agg(F.sum(F.col("s").cast("decimal(38,15)")).alias("s")).collect())  # k * (k + 3) / 2 rows
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in found:
        if r.j < 0:
            mean[r.i] = float(r.s) / n
        else:
            cov[r.i, r.j] = cov[r.j, r.i] = float(r.s) / n
    left = (cov - np.outer(mean, mean) - np.eye(k))[np.ix_(some, some)]
    return float(np.abs(left).max(initial=0.0))


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    done, model = whiten(read_table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(v)) for v in model["explained"]]) if model["n"] else F.array().cast("array<double>")
    return (done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(model["identity_error"]).alias("identity_error")))
