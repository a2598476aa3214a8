import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ridemart.llm import simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    sums = [sum((xxhash.xxh64_intdigest(p.encode(), 42) >> b) & 1 for p in parts) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * sums[b] > len(parts))


def brute_components(prints, apart=3):
    """Least id reachable for each (id, print)."""
    label = [i for i, _ in prints]
    for _ in prints:
        new = [min(label[b] for b in range(len(prints)) if (prints[a][1] ^ prints[b][1]).bit_count() <= apart)
               for a in range(len(prints))]
        if new == label:
            return label
        label = new
    return label


def test_query_is_exact(spark, docs):
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    want = {(i, f"{p:016x}", c) for (i, p), c in zip(rows, brute_components(rows))}
    got = {tuple(r) for r in simhash.op7_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and len(got) > len({g[2] for g in got})


def test_links_of_dense_prints_with_finer_keys(spark):
    """Hot keys, long chains and runs beyond 16 rows connect what brute force connects."""
    r = np.random.default_rng(4)
    base, prints = 0x0123456789ABCDEF, set()
    for _ in range(220):
        p = base
        for b in r.choice(24, r.integers(0, 6), replace=False):
            p ^= 1 << int(b)
        prints.add(p)
    prints |= {int(x) for x in r.integers(0, 1 << 63, 50)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "fp long")
    want = brute_components([(p, p) for p in prints])
    for hot in (4096, 5):
        roots = {x.node: x.root for x in simhash.components(simhash.links(df, hot_rows=hot)).collect()}
        groups = {}
        for p, w in zip(prints, want):
            groups.setdefault(w, set()).add(roots.get(p, p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_odd_rows(spark, odd, empty):
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd).collect()), key=str)
    by = {}
    for i, _, c in got:
        by.setdefault(i, []).append(c)
    assert len(got) == odd.count() and by[1] == [1, 1] and by[7] == [1] and by[None] == [1]
    assert by[2] == by[3] == by[4] == [2]
    kept = [r.doc_id for r in simhash.one_per_group(odd).collect()]
    assert sorted(kept) == [1, 2, 5, 6]
    assert simhash.one_per_group(odd).columns == odd.columns
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0
    nameless = odd.where("doc_id is null")
    assert simhash.one_per_group(nameless.union(nameless)).count() == 1


def test_one_row_of_every_group_whatever_its_id(spark):
    """Null ids and one id with several texts: groups are told apart by their texts."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    lone = [" ".join(f"{w}{i}" for w in words) for i in range(6)]
    rows = [(None, lone[0], 1), (None, lone[0], 2), (None, lone[1], 1), (None, lone[2].upper(), 1), (None, None, 1), (None, "", 1),
            (9, lone[2], 1), (None, lone[2], 1), (7, lone[3], 1), (7, lone[4], 1), (7, lone[5], 1), (8, lone[5], 1), (7, lone[5], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = [(r.doc_id, (r.text or "").lower()) for r in simhash.one_per_group(df).collect()]
    assert sorted(got, key=str) == sorted([(None, lone[0]), (None, lone[1]), (9, lone[2]), (None, ""), (7, lone[3]), (7, lone[4]),
                                           (7, lone[5])], key=str)
    assert len({brute_print(t) for _, t in got}) == len(got) == len({brute_print(r[1]) for r in rows})


def test_survivors_keep_columns_named_like_helpers(spark, odd):
    named = odd
    for c in ("_keep_text", "_keep_id", "_keep_digest", "_keep_rank", "nth", "id", "text_digest", "digest", "rep", "fp"):
        named = named.withColumn(c, F.lit(c))
    kept = simhash.one_per_group(named)
    assert kept.columns == named.columns
    assert all(r["_keep_text"] == "_keep_text" and r["nth"] == "nth" for r in kept.collect())
    plain = simhash.one_per_group(odd)
    assert sorted(map(str, kept.select(*odd.columns).collect())) == sorted(map(str, plain.collect()))
