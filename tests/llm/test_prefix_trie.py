"""Operator 13: fat binary search, inserted tries and node sums against plain walks; odd rows; DuckDB SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ridemart.llm import prefix_trie as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(WORDS.findall(p[-1][1])) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def made(spark, rows, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("turns", "key", "path", "n", "lead", "digest", "r", "t"):
        df = df.withColumn(c, F.lit("clash"))
    convs = T.with_shared_starts(T.ordered_turns(df))
    return sorted(map(tuple, T.prefix_trie(convs, **how).select(*T.COLUMNS).collect()), key=str)


def shared(seed, n, deep=9):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for i in range(rng.randrange(0, deep)):
            rows.append((c, i, "ua"[i % 2], rng.choice(["a", "b b", "c c c"]) if rng.random() < 0.8 else f"own {c}"))
    return rows


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 3), (3, 4)])
def test_random_conversations(spark, seed, batches):
    rows = shared(seed, 150)
    assert made(spark, rows, batches=batches) == plain(rows)


def test_nested_and_deep(spark):
    """Every conversation is a beginning of the next one, and one goes far beyond."""
    rows = [(20 * c + 1, i, "u", f"turn {i}") for c in range(40) for i in range(c + 1)]
    rows += [(7, i, "u", f"turn {i}") for i in range(300)]
    assert made(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(0, None, "u", "first"), (0, 1, None, None), (0, 1, "u", ""), (0, 1, "u", ""), (0, 5, "u", "x y"), (None, 1, "u", "lost"),
            (19, 0, "u", "first"), (-7, 1, "u", "neg"), (-7, 2, "a", "neg"), (41, 1, "u", "z" * 300_000), (41, 2, "u", "w " * 100_000),
            (3, 0, "u:", "a"), (3, 1, "u", ":a")]
    rows += [(c, i, "u", "same") for c in range(100, 160) for i in range(4)]
    want = [r for r in rows if r[0] != -7]  # Python's remainder of a negative id is another one
    assert made(spark, want) == plain(want)
    assert {r[0] for r in made(spark, rows)} >= {-7}
    assert made(spark, []) == []
    assert made(spark, [(3, 0, "u", "one")]) == plain([(3, 0, "u", "one")])


def test_only_turnless(spark):
    """A conversation whose turns all give way to an absent donor's."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "u", "gone")]
    assert made(spark, rows) == plain(rows) and len(plain(rows)) == 1


def test_locate_finds_the_deepest_node(spark):
    convs = T.with_shared_starts(T.ordered_turns(spark.createDataFrame(shared(9, 200, 20), "conv_id long, turn long, role string, text string")))
    strings = T.paths(convs).groupBy("key").agg(F.first("n").alias("n"), F.first("path").alias("path")).where("n > 0").persist()
    some = strings.where("pmod(xxhash64(key), 3) = 0").select("key", "n", "path", F.lit(0).alias("deep"))
    trie = T.insert(None, some).persist()
    nodes = {bytes(r.key) for r in trie.collect()}
    depths = {(bytes(r.handle), r.top, r.depth) for r in trie.collect()}
    for r in T.locate(trie, strings).collect():
        assert r.deep == max([i + 1 for i, c in enumerate(r.path) if bytes(c.key) in nodes], default=0)
    assert len({h for h, _, _ in depths}) == len(depths)  # handles tell nodes apart
    for r in trie.collect():
        assert len(r.edge) == r.depth - r.top and bytes(r.edge[-1].key) == bytes(r.key) and bytes(r.edge[0].key) == bytes(r.name)
        fat = max(range(r.top + 1, r.depth + 1), key=lambda d: d & -d)
        assert bytes(r.edge[fat - r.top - 1].key) == bytes(r.handle)


def test_id_digests_in_chunks(spark):
    rows = [(b"a" * 16, i) for i in range(-5, 500)] + [(b"b" * 16, 7)]
    found = T.id_digests(spark.createDataFrame(rows, "key binary, conv_id long"), chunk=16).collect()
    want = {k: hashlib.sha256(",".join(str(c) for x, c in rows if x == k).encode()).hexdigest() for k in {k for k, _ in rows}}
    assert {bytes(r.key): r.ends_sha256 for r in found} == want


def test_sql(spark):
    con = duckdb.connect()
    con.sql("create view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    found = T.op13_prefix_trie(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(con.sql(T.OP13_SQL).fetchall(), key=str)
    assert {f.dataType.typeName() for f in found.schema} == {"long", "string"}
