"""Operator 7, SimHash near-duplicates by pigeonhole blocks.

A fingerprint bit is set if it is set in over half of the shingle hashes. Fingerprints within
``max_distance`` bits are linked: of ``blocks`` blocks at least ``blocks - max_distance`` agree in such
a pair, so both share a key for one choice of that many blocks. Only distinct fingerprints are
compared; rows of a key with more than ``hot_rows`` fingerprints get finer keys over their other bits,
which bounds a key by the number of values that the bits outside it can take. Inside a key a
spanning set of links is kept, never all pairs. Connected components follow by large-star and
small-star steps.

Defined results: a null or empty text has fingerprint zero and is linked like any other; repeated
rows give repeated rows; a null id never names a component unless all its ids are null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import LOWER, raw_texts, read_table, stored

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text: ASCII lower-cased, words between ASCII white space."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(shingle)))]
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long. With ``digest`` also that of the text."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in raw_texts(b.column(1).cast(pa.string()))],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])

    more = [_digest(F.col(text_col)).alias("digest")] if digest else []
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"), *more)
            .mapInArrow(run, "doc_id long, fp long" + ", digest string" * digest))


def _digest(text: Column) -> Column:
    """Tells texts apart, and a null from every text."""
    return F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit(""))


def _blocks(bits: list[int], count: int) -> list[list[int]]:
    count = min(count, len(bits))
    return [list(x) for x in np.array_split(np.array(bits, int), count)]


def _mask(bits) -> int:
    m = sum(1 << int(b) for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _masks(bits: list[int], count: int, apart: int) -> list[int]:
    """Masks of every choice of blocks that a pair with ``apart`` differing bits must leave equal."""
    parts = _blocks(bits, count)
    if len(parts) <= apart:
        return [0]
    return [_mask(b for p in c for b in p) for c in combinations(parts, len(parts) - apart)]


def _run_links(a: np.ndarray, apart: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is within ``apart`` bits among distinct ``a``, at most len(a) - 1."""
    out = []
    while len(a) > 1:
        root, rest, front = a[0], a[1:], [a[0]]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= apart
            if near.any():
                hit = rest[near]
                out.append((hit, np.full(len(hit), root)))
                front.extend(hit)
                rest = rest[~near]
        a = rest
    return out


def _linker(apart: int):
    """Reads rows sorted by key; a key's rows may span batches, so the last one is carried over."""
    def links(keys: np.ndarray, fps: np.ndarray):
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        sizes = np.diff(np.r_[starts, len(fps)])
        out = []
        small = np.repeat(sizes <= 16, sizes)
        run = np.repeat(np.arange(len(sizes)), sizes)
        for step in range(1, min(16, sizes.max(initial=1))):
            same = (run[step:] == run[:-step]) & small[step:]
            i = np.flatnonzero(same)
            i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= apart]
            out.append((fps[i + step], fps[i]))
        for s, n in zip(starts[sizes > 16], sizes[sizes > 16]):
            out += _run_links(fps[s:s + n], apart)
        a = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.uint64)
        b = np.concatenate([x for _, x in out]) if out else np.empty(0, np.uint64)
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))],
                                          names=["a", "b"])

    def run(batches):
        keys, fps = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            c, s, k, f = (x.to_numpy() for x in batch.columns)
            keys = np.concatenate([keys, np.stack([c, s, k], 1).astype(np.int64)])
            fps = np.concatenate([fps, f.view(np.uint64)])
            cut = len(keys) - int(np.argmax((keys[::-1] != keys[-1]).any(1))) \
                if (keys != keys[-1]).any() else 0
            if cut:
                yield links(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(fps):
            yield links(keys, fps)

    return run


def links(fps: DataFrame, max_distance: int = 3, blocks: int = 6, sub_blocks: int = 6,
          hot_rows: int = 4096) -> DataFrame:
    """(a, b), a > b: links between distinct fingerprints (column ``fp``) that connect exactly what
    pairs within ``max_distance`` bits connect."""
    masks = _masks(list(range(BITS)), blocks, max_distance)
    fine = [[m, *(m | s for s in _masks([b for b in range(BITS) if not (m >> b) & 1],
                                        sub_blocks, max_distance))] for m in masks]
    width = len(fine[0])
    keyed = (fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                        .alias("c", "k")))
    hot = keyed.groupBy("c", "k").count().where(F.col("count") > hot_rows).select("c", "k", F.lit(1).alias("hot"))
    hot = stored(hot, "simhash-hot")  # on disk, so that AQE may split the join below
    flat = F.array(*[F.lit(m) for row in fine for m in row])
    rekeyed = (keyed.join(hot, ["c", "k"], "left")
               .select("c", "fp", F.explode(F.when(F.col("hot").isNull(), F.array(F.lit(0)))
                                            .otherwise(F.sequence(F.lit(1), F.lit(width - 1)))).alias("s"))
               .select("c", "s", F.col("fp").bitwiseAND(
                   F.element_at(flat, F.col("c") * width + F.col("s") + 1)).alias("k"), "fp"))
    return (rekeyed.repartition("c", "s", "k").sortWithinPartitions("c", "s", "k")
            .mapInArrow(_linker(max_distance), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a > b); root is the least node connected to it."""
    now = stored(edges, "simhash-edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))
        seen = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(stored(least, "simhash-min"), "u").where("v > u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = stored(large, "simhash-large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "simhash-min")
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        now = stored(small, "simhash-edges")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per document row; component_id is the least id reachable by links."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    linked = _rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), max_distance)
    least = stored(linked.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    named = stored(linked.join(least, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(reps: DataFrame, max_distance: int) -> DataFrame:
    """``reps`` (distinct fp, rep) with the root, the least fingerprint of the component."""
    reps = stored(reps, "simhash-reps")
    roots = stored(components(links(reps.select("fp"), max_distance)), "simhash-roots")
    return reps.join(roots, reps.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def one_per_group(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: exactly one row of each component, the one with the
    least id, of several such that with the least text digest. A null id comes after all known ones."""
    prints = fingerprints(docs, shingle, id_col, text_col, digest=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("rep")
    # id and digest decide the text, so they decide the component too: the pairs are distinct
    keep = stored(_rooted(prints.groupBy("fp").agg(first), max_distance).groupBy("root").agg(F.min("rep").alias("rep"))
                  .select(F.col("rep.doc_id").alias("_keep_id"), F.col("rep.digest").alias("_keep_digest")), "simhash-keep")
    # the row is one struct, so its names cannot clash with the helpers
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       docs[f"`{id_col}`"].cast("long").alias("id"), _digest(docs[f"`{text_col}`"]).alias("text_digest"))
    mine = rows.join(keep, rows.id.eqNullSafe(F.col("_keep_id")) & (rows.text_digest == F.col("_keep_digest")), "left_semi")
    # rows with one id and text are left; maps have no order and no hash
    ordered = [F.col("row")[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    order = Window.partitionBy("id", "text_digest").orderBy(F.xxhash64(*ordered))
    first = mine.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return first.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
