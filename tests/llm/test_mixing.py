"""Operator 11: targets against a plain water filling, takes against a plain walk, odd rows."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ridemart.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return {s: cap * sizes[s] for s in names}
        level = (goal - sum(cap * sizes[s] for s in full)) / sum(w[s] for s in rest)
        more = {s for s in rest if cap * sizes[s] <= level * w[s]}
        if not more:
            return {s: cap * sizes[s] if s in full else level * w[s] for s in names}
        full |= more


def check(rows, texts):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    want = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12, abs_tol=1e-9)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6, (s, taken[s], t)
    assert Counter(r.size for r in rows) == Counter(len(WORDS.findall(t or "")) for t in texts)


def test_whole_table(spark, docs):
    rows = mixing.mix(docs).collect()
    check(rows, [r.text for r in docs.select("text").collect()])
    # complete epochs come first, and at most one document of a source is cut
    cut = Counter()
    for r in rows:
        assert r.epochs * r.size <= r.taken <= (r.epochs + 1) * r.size
        cut[r.source] += r.epochs * r.size < r.taken < (r.epochs + 1) * r.size
    assert max(cut.values()) <= 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_sql(spark):
    found = mixing.op11_source_mixing(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(mixing.OP11_SQL).fetchall())


def test_no_python(spark, docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_odd_rows_and_clashing_names(spark, odd, empty):
    named = odd.withColumn("source", F.when(F.col("doc_id") < 4, F.col("row")).otherwise(F.lit(None)))
    for c in ("part", "run", "base", "before", "key", "nth", "w", "target", "taken", "digest", "size", "_name"):
        named = named.withColumn(c, F.lit("clash"))
    rows = mixing.mix(named).collect()
    assert len(rows) == odd.count()
    check(rows, [r.text for r in odd.select("text").collect()])
    assert mixing.mix(empty.withColumn("source", F.lit("x"))).count() == 0
    silent = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(silent).collect()] == [(0, 0.0, 0), (0, 0.0, 0)]


def test_one_hot_source_is_dealt_to_many_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_ROWS", 7)
    many = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.repeat(F.lit("x "), (F.col("id") % 9).cast("int"))).alias("text"),
                                   F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    check(mixing.mix(many).collect(), [r.text for r in many.select("text").collect()])


def test_better_documents_come_first(spark):
    """With half of a source taken, clean text wins over symbols nearly always."""
    rows = [(i, ("plain words here " if i % 2 else "#### 1234 $$$$ ") * 5, "a") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, weights=(1,), share=0.5).collect()}
    assert sum(v > 0 for k, v in taken.items() if k % 2) > 10 * sum(v > 0 for k, v in taken.items() if not k % 2)


@pytest.mark.parametrize("share", [0.4, 1.5])
def test_mixture_holds_what_the_plan_takes(spark, docs, share):
    both = docs.unionAll(docs.limit(3))
    plan = mixing.mix(both, share=share)
    made = mixing.mixture(both, share=share).collect()
    for r in made:
        assert len(WORDS.findall(r.text)) == r.words
    assert sum(r.words for r in made) == plan.agg(F.sum("taken")).first()[0]
