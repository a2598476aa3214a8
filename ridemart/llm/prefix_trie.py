r"""Operator 13, prefix trie of conversations as a distributed z-fast trie.

A conversation is a path of turns; a prefix is known by its key, a 128-bit hash chained over the turns. The trie is a table of
compacted nodes: a node's edge holds the keys from below its parent to its own depth, its handle is the key at
the two-fattest depth of the edge (the one divisible by the highest power of two), its name is the first key of the edge.

Conversations go in in batches of growing size, each different one once. ``locate`` finds the deepest node on each
path by fat binary search: level by level of the powers of two, one join on the handles halves what is left, so a
search takes as many joins as the depth has bits. ``insert`` then handles only what is new, the paths below the
nodes found and the edges that they leave half-way: places where paths part or end become nodes.

Sums over subtrees take as many rounds as the height has bits: in each, nodes add what stands twice as far below. Finally edges
are expanded, one row for each turn on them.

Paths are handled one by one, so the keys of a conversation (24 bytes a turn) must fit a row; texts are never collected.
Copies of a conversation are one path, common prefixes are looked up, and the ids that end at a node are hashed in a
stream, chunk by chunk, so no group is held by a task.

Defined results: a null role or text is empty; turns are ordered by (turn, role, digest of role and text) with null turns
first, so ties and repeated rows have a fixed order and all stay; rows with a null conversation id take no part; an
empty table has no trie and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.llm.common import read_table, stored

WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
#: Batches of insertion; each is twice as large as the one before.
BATCHES = 3
#: Ids that one chunk of a stream of ids holds.
CHUNK_IDS = 1 << 16
_PATH = "array<struct<key:binary,total:bigint>>"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs (digest, words)."""
    role, text = F.coalesce(F.col("r"), F.lit("")), F.coalesce(F.col("t"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = (turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                         turns["role"].cast("string").alias("r"), turns["text"].cast("string").alias("t"))
            .where(F.col("conv_id").isNotNull())
            .select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))
    sorted_turns = F.array_sort(F.collect_list(F.struct("turn", "role", "digest", "words")))
    return rows.groupBy("conv_id").agg(F.transform(sorted_turns, lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("turns"))


def with_shared_starts(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns (h: crc32 of c modulo ``most``) in place of which stand the first h turns of
    conversation c - c % ``every``, as many as that has."""
    donors = (convs.where(F.col("conv_id") % every == 0)
              .select(F.col("conv_id").alias("donor"), F.slice("turns", 1, most - 1).alias("lead")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    lead = F.coalesce(F.slice("lead", F.lit(1), h), F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.size("turns"))
    # a donor has at most ``every`` receivers
    return (convs.join(donors, F.col("conv_id") - F.col("conv_id") % every == F.col("donor"), "left")
            .select("conv_id", F.concat(lead, own).alias("turns")))


def paths(convs: DataFrame) -> DataFrame:
    """(conv_id, n, key, path): the prefix keys and the words up to each turn; ``key`` is the whole path's."""
    def run(batches):
        for b in batches:
            turns = b.column(1)
            sizes = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = turns.flatten()
            digests, words = flat.field(0).to_pylist(), flat.field(1).to_numpy(zero_copy_only=False)
            keys, ends, totals, at = [], [], [], 0
            for n in sizes.tolist():
                key = ROOT
                for digest in digests[at:at + n]:
                    key = hashlib.md5(key + digest).digest()
                    keys.append(key)
                ends.append(key)
                totals.append(np.cumsum(words[at:at + n]))
                at += n
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            cells = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(np.concatenate([np.empty(0, np.int64), *totals]), pa.int64())],
                                               names=["key", "total"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(ends, pa.binary()),
                                              pa.ListArray.from_arrays(offsets, cells)], names=["conv_id", "n", "key", "path"])

    return convs.select("conv_id", "turns").mapInArrow(run, f"conv_id long, n int, key binary, path {_PATH}")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _at(path: str, place: Column) -> Column:
    """Cell at a place of a path, from 1."""
    return F.get(F.col(path), place - 1)


def locate(trie: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` (key, n, path) with ``deep``: the depth of the deepest node of ``trie`` on each path, by fat binary search."""
    deepest = trie.agg(F.max("depth")).first()[0]
    handles = trie.select("handle", F.col("depth").alias("z_depth"), F.col("key").alias("z_key"), F.col("top").alias("z_top"))
    state = batch.select("key", "n", "path", F.lit(0).alias("low"), F.least("n", F.lit(deepest)).alias("high"))
    for level in reversed(range(deepest.bit_length())):
        probe = F.shiftleft(F.shiftright("high", level), level)
        asked = state.withColumn("probe", probe).withColumn("asks", probe > F.col("low"))
        # paths that ask nothing at this level are spread by their own key
        asked = asked.withColumn("asked", F.when(F.col("asks"), _at("path", F.col("probe"))["key"]).otherwise(F.col("key")))
        found = asked.join(handles, F.col("asks") & (F.col("asked") == F.col("handle")), "left")
        whole = F.coalesce(_at("path", F.col("z_depth"))["key"] == F.col("z_key"), F.lit(False))
        hit = F.col("z_key").isNotNull()
        low = F.when(whole, F.col("z_depth")).when(hit, F.col("z_top")).otherwise(F.col("low"))
        # left half-way on an edge: the search has ended at the edge's upper node
        high = F.when(whole, F.col("high")).when(hit, F.col("z_top")).when(F.col("asks"), F.col("probe") - 1).otherwise(F.col("high"))
        state = found.select("key", "n", "path", low.alias("low"), high.alias("high"))
    return state.select("key", "n", "path", F.col("low").alias("deep"))


def insert(trie: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The trie with the paths of ``batch`` (key, n, path, deep), of which each is new below ``deep``."""
    above = _at("path", F.col("deep"))
    new = batch.where("deep < n").select(
        F.col("key").alias("item"), F.col("deep").alias("top"), F.coalesce(above["key"], F.lit(bytearray(ROOT))).alias("parent"),
        F.coalesce(above["total"], F.lit(0)).alias("top_total"), F.slice("path", F.col("deep") + 1, F.col("n") - F.col("deep")).alias("path"))
    rest = None
    if trie is not None:
        names = new.select(F.col("path")[0]["key"].alias("name")).distinct()
        rest = trie.join(names, "name", "left_anti")
        left = trie.join(names, "name", "left_semi")
        new = new.unionByName(left.select(F.col("key").alias("item"), "top", "parent", "top_total", F.col("edge").alias("path")))
    items = stored(new, "trie-items")
    cells = (items.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("path"))))
             .select("item", "at", _at("path", F.col("at"))["key"].alias("key"),
                     F.when(F.col("at") == 1, F.col("parent")).otherwise(_at("path", F.col("at") - 1)["key"]).alias("prev")))
    forks = cells.select("prev", "key").distinct().groupBy("prev").count().where("count > 1").select(F.col("prev").alias("key"))
    marks = stored(forks.union(items.select("item")).distinct(), "trie-marks")
    cuts = cells.join(marks, "key").groupBy("item").agg(F.array_sort(F.collect_list("at")).alias("cuts"))
    pieces = (items.join(cuts, "item").withColumn("i", F.explode(F.sequence(F.lit(1), F.size("cuts"))))
              .withColumn("from", F.when(F.col("i") == 1, F.lit(0)).otherwise(_at("cuts", F.col("i") - 1)))
              .withColumn("to", _at("cuts", F.col("i"))))
    up = _at("path", F.col("from"))
    nodes = pieces.select(
        _at("path", F.col("to"))["key"].alias("key"), (F.col("top") + F.col("to")).alias("depth"), (F.col("top") + F.col("from")).alias("top"),
        F.coalesce(up["key"], F.col("parent")).alias("parent"), F.coalesce(up["total"], F.col("top_total")).alias("top_total"),
        F.slice("path", F.col("from") + 1, F.col("to") - F.col("from")).alias("edge"))
    nodes = nodes.dropDuplicates(["key"])  # paths that share an edge give it alike
    handle = _at("edge", two_fattest(F.col("top"), F.col("depth")) - F.col("top"))["key"]
    nodes = nodes.withColumn("name", F.col("edge")[0]["key"]).withColumn("handle", handle)
    return nodes if rest is None else nodes.unionByName(rest)


def build(strings: DataFrame, batches: int = BATCHES) -> DataFrame | None:
    """Compacted nodes (key, depth, top, parent, top_total, edge, name, handle) of different paths (key, n, path); None without
    any. The root is no row."""
    share = F.pmod(F.xxhash64("key"), F.lit((1 << batches) - 1)) + 1
    dealt = strings.where("n > 0").select("key", "n", "path", (F.length(F.bin(share)) - 1).alias("batch"))
    trie = None
    for i in range(batches):
        batch = dealt.where(F.col("batch") == i)
        found = batch.select("key", "n", "path", F.lit(0).alias("deep")) if trie is None else stored(locate(trie, batch), "trie-found")
        grown = stored(insert(trie, found), "trie-nodes")
        trie = None if trie is None and grown.isEmpty() else grown
    return trie


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, cnt, least, cd, w, leaves) summed over subtrees; ``nodes`` has these as each node's own, and ``up``, the parent's key
    (null at the root). After round r a node holds what stands less than 2**r below it."""
    now = nodes
    while True:
        added = now.where("up is not null").groupBy(F.col("up").alias("k")).agg(
            F.sum("cnt").alias("a_cnt"), F.min("least").alias("a_least"), F.sum("cd").alias("a_cd"), F.sum("w").alias("a_w"), F.sum("leaves").alias("a_leaves"))
        jump = now.select(F.col("key").alias("j"), F.col("up").alias("j_up"))
        more = now.join(added, F.col("key") == F.col("k"), "left")
        # nodes that have passed the root look themselves up, so that nulls do not meet
        more = more.join(jump, F.coalesce("up", "key") == F.col("j"), "left")
        now = stored(more.select(
            "key", F.when(F.col("up").isNotNull(), F.col("j_up")).alias("up"), (F.col("cnt") + F.coalesce("a_cnt", F.lit(0))).alias("cnt"),
            F.least("least", "a_least").alias("least"), *[(F.col(c) + F.coalesce(f"a_{c}", F.lit(0))).alias(c) for c in ("cd", "w", "leaves")]), "trie-sums")
        if now.where("up is not null").isEmpty():
            return now.select("key", "cnt", "least", "cd", "w", "leaves")


def id_digests(ends: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): SHA-256 of the ids as decimals, ascending, comma-joined. Sorted ranges give chunks of
    joined ids; a key's chunks are hashed one after the other, so neither ids nor texts of a key are held."""
    def chunks(batches):
        key, first, ids = None, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])],
                                              names=["key", "first", "ids"])

        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key or len(ids) >= chunk:
                    if ids:
                        yield out()
                    key, first, ids = k, c, []
                ids.append(str(c))
        if ids:
            yield out()

    def hashed(batches):
        key, sha = None, None
        for b in batches:
            keys, found = [], []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k == key:
                    sha.update(b",")
                else:
                    if sha is not None:
                        keys.append(key)
                        found.append(sha.hexdigest())
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    pieces = (ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(chunks, "key binary, first long, ids string"))
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """One row per node of the trie of (conv_id, turns as structs digest, words): key, depth, conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = stored(paths(convs), "trie-paths")
    strings = stored(members.groupBy("key").agg(F.first("n").alias("n"), F.first("path").alias("path"), F.count("*").alias("cnt"),
                                                F.min("conv_id").alias("least")), "trie-strings")
    root = F.lit(bytearray(ROOT))
    trie = build(strings, batches)
    if trie is None:
        trie = members.sparkSession.createDataFrame([], f"key binary, depth int, top int, parent binary, top_total long, edge {_PATH}")
    ends = strings.select(F.col("key").alias("end"), "cnt", "least")
    kids = trie.groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("kids"))
    top = (strings.limit(1).select(root.alias("key"), F.lit(0).alias("depth"), F.lit(0).alias("top"), F.lit(None).cast("binary").alias("parent"),
                                   F.lit(0).cast("long").alias("top_total"), F.array().cast(_PATH).alias("edge")))
    nodes = trie.select("key", "depth", "top", "parent", "top_total", "edge").unionByName(top)
    digests = id_digests(members.select("key", "conv_id"))
    total = F.coalesce(_at("edge", F.size("edge"))["total"], F.lit(0))
    nodes = stored(nodes.join(ends, F.col("key") == F.col("end"), "left").join(kids, F.col("key") == F.col("p"), "left")
                   .join(digests.withColumnRenamed("key", "e"), F.col("key") == F.col("e"), "left")
                   .select("key", "depth", "top", "parent", "top_total", "edge", F.coalesce("cnt", F.lit(0)).alias("own"), F.col("least").alias("own_least"),
                           F.coalesce("kids", F.lit(0)).alias("kids"), total.alias("total"), "ends_sha256"), "trie-nodes")
    sums = subtree_sums(nodes.select("key", F.col("parent").alias("up"), F.col("own").alias("cnt"), F.col("own_least").alias("least"),
                                     (F.col("own") * F.col("total")).alias("cd"), (F.col("total") - F.col("top_total")).alias("w"),
                                     (F.col("kids") == 0).cast("long").alias("leaves")))
    upper = sums.select(F.col("key").alias("u"), F.col("least").alias("upper"))
    full = (nodes.join(sums.withColumnRenamed("key", "s"), F.col("key") == F.col("s"))
            .join(upper, F.coalesce("parent", "key") == F.col("u"), "left"))
    # the root's edge is empty; it stands for one row without a turn
    rows = full.withColumn("i", F.explode(F.when(F.size("edge") > 0, F.sequence(F.lit(1), F.size("edge"))).otherwise(F.array(F.lit(0)))))
    last, before = F.col("i") == F.size("edge"), F.coalesce(_at("edge", F.col("i") - 1)["total"], F.col("top_total"))
    return rows.select(
        F.coalesce(_at("edge", F.col("i"))["key"], F.col("key")).alias("key"), (F.col("top") + F.col("i")).cast("long").alias("depth"),
        F.col("least").alias("conv_id"), F.when(F.col("i") > 1, F.col("least")).when(F.col("i") == 1, F.col("upper")).alias("parent_conv_id"),
        F.col("cnt").alias("n_convs"), F.when(last, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("cd") - F.col("cnt") * before - (F.col("w") - (before - F.col("top_total")))).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    convs = stored(ordered_turns(read_table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie(with_shared_starts(convs)).select(*COLUMNS)


OP13_SQL = r"""
WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, row_number() OVER w AS pos, md5(length(role) || ':' || role || text) AS digest,
             CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
      FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text))),
bits AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS c FROM t),
-- crc32 bit by bit: two bits of the result are needed, so the whole register is folded over the digits
crc AS (SELECT conv_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(c, '')]), lambda a, b:
          list_reduce(list_prepend(xor(a, b), [CAST(i AS BIGINT) FOR i IN range(8)]), lambda v, i:
            xor(v // 2, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))) AS reg FROM bits),
h AS (SELECT conv_id, CAST(xor(reg, 4294967295) % 4 AS INT) AS h FROM crc),
r AS (SELECT h.conv_id, 0 AS part, d.pos, d.digest, d.words FROM h JOIN t d ON d.conv_id = h.conv_id - h.conv_id % 20 AND d.pos <= h.h
      UNION ALL SELECT t.conv_id, 1, t.pos, t.digest, t.words FROM t JOIN h USING (conv_id) WHERE t.pos > h.h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, digest, words FROM r),
p AS (SELECT conv_id, depth, words, string_agg(digest, '/') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM o
      UNION ALL SELECT conv_id, 0, 0, '' FROM h),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY key, depth),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
e AS (SELECT p.key, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS ends FROM p JOIN l USING (conv_id, depth) GROUP BY p.key),
up AS (SELECT n.key, q.key AS parent FROM n JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1),
k AS (SELECT parent AS key, count(*) AS kids FROM up GROUP BY parent),
a AS (SELECT q.key, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
      FROM n LEFT JOIN k ON k.key = n.key JOIN p q ON q.conv_id = n.conv_id AND q.depth <= n.depth GROUP BY q.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.kids, 0) AS BIGINT) AS n_children,
       CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n JOIN a ON a.key = n.key LEFT JOIN up ON up.key = n.key LEFT JOIN n m ON m.key = up.parent
LEFT JOIN k ON k.key = n.key LEFT JOIN e ON e.key = n.key
"""
