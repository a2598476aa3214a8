"""Vector search (VEC1): exact top-k cosine neighbours of a set of query vectors.

Corpus rows are dealt to shards and queries to blocks, both of bounded size; a (shard, block) part scores
its rows with one matrix product and returns at most k rows per query, so no pair of row and query
ever becomes a row. The best of the parts are then ranked per query.

``top_k`` scores every row. ``build_cells`` and ``search_cells`` give the same answer from fewer rows: rows lie in
cells around k-means centres, a query looks into its nearest cells first, and then only into those
whose centre and radius leave room for something better than the k-th row found.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, BLOCK_ROWS = 16_384, 1024
#: Queries of one matrix product, and slack for rounding in angles.
PRODUCT_ROWS, SLACK = 128, 1e-7
#: Cell of vectors without a direction: null, zero, not finite, or of another length than the centres.
NO_CELL = -1


def centroids(corpus: DataFrame, group: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per group: per-dimension averages (map-side partial aggregation), then the
    dimensions of each group put back in order (one small array per group)."""
    per_dim = (corpus.select(group, F.posexplode(vec).alias("pos", "x"))
               .groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    return (per_dim.groupBy(group)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("_d"))
            .select(F.col(group).alias("query_id"), F.transform("_d", lambda s: s["m"]).alias("query_vec")))


def _lengths(vectors: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)


def _directions(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``width`` entries, and those scaled to length 1 (NaN where there is no direction)."""
    fits = _lengths(vectors) == width
    taken = vectors.filter(pa.array(fits))
    x = taken.flatten().to_numpy(zero_copy_only=False).reshape(len(taken), width).astype(float)
    with np.errstate(invalid="ignore", divide="ignore"):
        x = x / np.abs(x).max(1, initial=0, keepdims=True)  # squares of any finite size stay finite
        return fits, x / np.sqrt((x * x).sum(1, keepdims=True))


def _best(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of ``left`` (id, v) for each query of ``right`` (query_id, q); ties by id, NULL similarity last."""
    ids, vectors = left["id"].combine_chunks(), left["v"].combine_chunks()
    asked = right["q"].combine_chunks()
    place = np.empty(len(ids), np.int64)
    place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
    k, widths = min(k, len(ids)), _lengths(asked)
    queries, rows, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for width in np.unique(widths).tolist():
        who = np.flatnonzero(widths == width)
        if width > 0:
            fits, x = _directions(vectors, width)
            y = _directions(asked, width)[1]
        for at in range(0, len(who), PRODUCT_ROWS):
            score = np.full((len(who[at:at + PRODUCT_ROWS]), len(ids)), -np.inf)
            if width > 0:
                product = y[at:at + PRODUCT_ROWS] @ x.T
                score[:, fits] = np.where(np.isnan(product), -np.inf, product)
            least = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
            for q, s, low in zip(who[at:at + PRODUCT_ROWS], score, least):
                near = np.flatnonzero(s >= low)
                near = near[np.lexsort((place[near], -s[near]))[:k]]
                queries.append(np.full(len(near), q))
                rows.append(near)
                scores.append(s[near])
    score = np.concatenate(scores)
    return pa.table([right["query_id"].combine_chunks().take(pa.array(np.concatenate(queries))), ids.take(pa.array(np.concatenate(rows))),
                     pa.array(score, mask=np.isinf(score))], names=["query_id", "id", "similarity"])


def _ranked(near: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc_nulls_last(), F.col("id"))
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _every(n):
    """One row for each part of ``n``."""
    return F.explode(F.sequence(F.lit(0), n - 1))


def top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
          vec: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, id, similarity, rank) for the k most similar corpus rows of every query; ties by id.

    Vectors that are null, zero or of another length than the query have a NULL similarity and rank last.
    """
    id_type, query_type = corpus.schema[id_col].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    shards = max(1, -(-corpus.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"),
                         F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int").alias("shard"), _every(F.lit(blocks)).alias("block"))
    asked = queries.select("query_id", F.col("query_vec").cast("array<double>").alias("q"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), _every(F.lit(shards)).alias("shard"))
    near = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        lambda left, right: _best(left, right, k), f"query_id {query_type}, id {id_type}, similarity double")
    return _ranked(near, k)


# ------------------------------------------------------------------------------- coarse cells

class Cells(NamedTuple):
    """Centres of length 1, and by cell number its rows and its radius (largest angle to the centre); ``path`` holds the
    rows as (id, v) in one folder per cell."""

    path: str
    id_type: str
    centres: np.ndarray
    rows: dict[int, int]
    radius: dict[int, float]


def _width(corpus: DataFrame, vec: str) -> int:
    """The commonest vector length."""
    row = corpus.groupBy(F.size(vec).alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    return row["n"] if row else 0


def build_cells(corpus: DataFrame, path: str, n_cells: int = 256, id_col: str = "vec_id", vec: str = "embedding",
                fit_rows: int = 50_000, seed: int = 7) -> Cells:
    """Write ``corpus`` as cells. The centres are fitted on about ``fit_rows`` rows chosen by a hash of the id; every row
    gets its nearest centre. Files of a cell hold bounded numbers of rows (AQE splits a hot cell)."""
    spark = corpus.sparkSession
    width = _width(corpus, vec)
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    largest = F.array_max(F.transform("v", F.abs))
    usable = rows.where((F.size("v") == width) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)) & (largest > 0) & (largest < float("inf")))
    step = max(1, -(-usable.count() // fit_rows))
    scaled = F.transform("v", lambda x: x / largest)
    sample = usable.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(step)) == 0).select(array_to_vector(scaled).alias("features"))
    held = sample.count()
    centres = np.empty((0, width))
    if held:
        fitted = KMeans(k=min(n_cells, held), seed=seed, distanceMeasure="cosine", maxIter=10).fit(sample)
        found = np.array(fitted.clusterCenters(), float)  # n_cells vectors
        size = np.sqrt((found * found).sum(1))
        centres = found[size > 0] / size[size > 0, None]

    def assign(batches):
        for b in batches:
            cell, angle = np.full(b.num_rows, NO_CELL, np.int32), np.zeros(b.num_rows)
            if len(centres):
                fits, x = _directions(b.column(1), width)
                near = x @ centres.T
                known = ~np.isnan(near).any(1)
                at = np.flatnonzero(fits)[known]
                cell[at] = near[known].argmax(1)
                angle[at] = np.arccos(np.clip(near[known].max(1), -1, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(angle), pa.array(cell)], names=["id", "v", "angle", "cell"])

    id_type = corpus.schema[id_col].dataType.simpleString()
    (rows.mapInArrow(assign, f"id {id_type}, v array<double>, angle double, cell int")
     .hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path))
    cells = Cells(path, id_type, centres, {}, {})
    stats = _held(spark, cells).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle")).collect()  # a row a cell
    return cells._replace(rows={r.cell: r.n for r in stats}, radius={r.cell: r.angle for r in stats})


def _held(spark, cells: Cells) -> DataFrame:
    return spark.read.schema(f"id {cells.id_type}, v array<double>, angle double, cell int").parquet(cells.path)


def _probe(cells: Cells, probes: int, rest: bool):
    """Cells for each query of (query_id, q, kth): its ``probes`` nearest, or, for ``rest``, all others that may hold a row at
    least as similar as ``kth`` (any, where ``kth`` is NULL: too few were found)."""
    held = [c for c in range(len(cells.centres)) if c in cells.rows]
    centres = cells.centres[held]
    radius = np.array([cells.radius[c] for c in held])

    def run(batches):
        for b in batches:
            y = np.full((b.num_rows, centres.shape[1]), np.nan)
            if len(held):
                fits, x = _directions(b.column(1), centres.shape[1])
                y[fits] = x
            near = y @ centres.T
            lost = np.isnan(near).any(1) if len(held) else np.ones(b.num_rows, bool)
            order = np.argsort(-near, axis=1, kind="stable")
            first = np.zeros(near.shape, bool)
            np.put_along_axis(first, order[:, :probes], True, axis=1)
            first[lost] = False
            kth = b.column(2).to_numpy(zero_copy_only=False).astype(float)
            if rest:
                best = np.cos(np.maximum(0, np.arccos(np.clip(near, -1, 1)) - radius - SLACK))
                asked = ~first & (lost[:, None] | np.isnan(kth)[:, None] | (best + SLACK >= kth[:, None]))
            else:
                asked = first
            q, c = np.nonzero(asked)
            number = np.array(held, np.int32)[c]
            if rest and NO_CELL in cells.rows:
                more = np.flatnonzero(np.isnan(kth) | lost)
                q, number = np.r_[q, more], np.r_[number, np.full(len(more), NO_CELL, np.int32)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(q)), b.column(1).take(pa.array(q)), pa.array(number, pa.int32())],
                                             names=["query_id", "q", "cell"])

    return run


def search_cells(spark, cells: Cells, queries: DataFrame, k: int = 10, probes: int = 8, shard_rows: int = SHARD_ROWS,
                 block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The answer of ``top_k`` and the (query_id, cell) pairs it looked into.

    Only folders of cells that some query asks for are read. A hot cell is split into shards of ``shard_rows``, and its
    queries into blocks."""
    query_type = queries.schema["query_id"].dataType.simpleString()
    asked = queries.select("query_id", F.col("query_vec").cast("array<double>").alias("q"))
    if not cells.rows:
        none = asked.where(F.lit(False)).select("query_id")
        return (none.withColumns({"id": F.lit(None).cast(cells.id_type), "similarity": F.lit(None).cast("double"), "rank": F.lit(None).cast("int")}),
                none.withColumn("cell", F.lit(None).cast("int")))
    index, id_type = _held(spark, cells), cells.id_type
    blocks = max(1, -(-queries.count() // block_rows))
    shards = F.create_map(*[F.lit(int(x)) for c, n in cells.rows.items() for x in (c, -(-n // shard_rows))])

    def score(pairs: DataFrame) -> DataFrame:
        wanted = F.broadcast(pairs.select("cell").distinct())  # at most a row a cell
        rows = index.join(wanted, "cell", "left_semi").select(
            "cell", "id", "v", F.pmod(F.xxhash64("id"), F.element_at(shards, F.col("cell"))).cast("int").alias("shard"),
            _every(F.lit(blocks)).alias("block"))
        parts = pairs.select("cell", "query_id", "q", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
                             _every(F.element_at(shards, F.col("cell"))).alias("shard"))
        keys = ["cell", "shard", "block"]
        near = rows.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInArrow(
            lambda left, right: _best(left, right, k), f"query_id {query_type}, id {id_type}, similarity double")
        return _ranked(near, k).drop("rank")

    pair = f"query_id {query_type}, q array<double>, cell int"
    first = asked.withColumn("kth", F.lit(None).cast("double")).mapInArrow(_probe(cells, probes, False), pair)
    found = score(first).checkpoint()  # k rows a query, read for the bound and for the answer
    kth = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("low")).select(
        F.col("query_id").alias("_of"), F.when(F.col("n") >= k, F.col("low")).alias("kth"))
    bounded = asked.join(kth, F.col("query_id").eqNullSafe(F.col("_of")), "left").select("query_id", "q", "kth")
    second = bounded.mapInArrow(_probe(cells, probes, True), pair).checkpoint()
    return _ranked(found.unionByName(score(second)), k), first.select("query_id", "cell").unionByName(second.select("query_id", "cell"))
