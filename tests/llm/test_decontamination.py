import re

import duckdb
from pyspark.sql import functions as F

from ridemart.llm import decontamination as dc

SF = "/root/testdata/sf0.01"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for name, it in items:
        v = words(it)
        k = min(window, len(v))
        for j in range(len(v) - k + 1 if k else 0):
            for i in range(len(w) - k + 1):
                if w[i:i + k] == v[j:j + k]:
                    hit.update(range(i, i + k))
                    found.add(name)
    return len(w), len(hit), sorted(found)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = set(con.execute(dc.OP6_SQL).fetchall())
    got = {tuple(r) for r in dc.op6_benchmark_decontamination(spark, SF).collect()}
    assert got == want and any(g[-1] for g in got)


ITEMS = [("10", "the cat sat"), ("9", "sat on"), ("9", "sat on"), ("8", "mat"), ("7", None), ("6", "!?"), (None, "cat"),
         ("5", "cat sat on the mat the cat sat on the mat again"), ("4", "word word word word word word")]


def test_odd_rows_in_one_and_many_blocks(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    items = [(i, t) for i, t in ITEMS if i is not None]
    for limit in (1_000_000, 4):
        got = dc.find_matches(odd, bench, window=5, block_words=limit).collect()
        assert len(got) == odd.count()
        for r in got:
            if r.row.doc_id == 6:
                continue
            n, hit, found = brute(r.row.text, items, 5)
            assert (r.n_words, sum(b - a for a, b in r.spans), r["items"]) == (n, hit, found)
    clean = dc.drop_contaminated(odd, bench, 5)
    assert clean.columns == odd.columns and sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "4", "5"]
    assert dc.find_matches(empty, bench).count() == 0
    assert dc.drop_contaminated(odd, bench.limit(0)).count() == odd.count()


def test_longest_match_and_shard_borders(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "w0 w1 w2 w3 w4"), (2, "w5 w6 w7 w8 w9 w10"), (3, f"a b {item[:-4]} c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.row.doc_id: r for r in dc.find_matches(docs.coalesce(1), bench).collect()}
    assert got[1]["items"] == got[2]["items"] == []  # neighbours in a shard are not one text
    assert [(m.item, m.doc_start, m.item_start, m.words) for m in got[3].matches] == [("1", 2, 0, 29)]


def test_items_without_id_count(spark, tmp_path):
    """Windows of null-id items are hits as in the SQL, alone and beside known items, in one and many blocks."""
    item = [" ".join(f"{c}{i}" for i in range(12)) for c in "abc"]
    docs = [(1, f"so {item[0]} then"), (2, f"{item[0]} and {item[1]}"), (3, f"{item[1]} only"), (4, "clean"), (5, f"{item[0]} {item[2]}")]
    bench = spark.createDataFrame([(None, item[0]), ("k", item[1]), (None, item[2])], "item_id string, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = set(con.execute(dc.OP6_SQL).fetchall())
    got = {tuple(r) for r in dc.op6_benchmark_decontamination(spark, str(tmp_path)).collect()}
    assert got == want and {g[0] for g in got if g[-1]} == {1, 2, 3, 5}
    assert [r.doc_id for r in dc.drop_contaminated(docs, bench).collect()] == [4]
    many = {r.row.doc_id: r for r in dc.find_matches(docs, bench, block_words=4).collect()}
    assert {i: (bool(r.spans), r["items"]) for i, r in many.items()} == {
        1: (True, []), 2: (True, ["k"]), 3: (True, ["k"]), 4: (False, []), 5: (True, [])}


def test_blocks_and_columns_named_like_helpers(spark):
    item = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([("a", item), ("b", "other words entirely " * 4)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, "clean"), (3, "other words entirely " * 4)], "doc_id long, text string")
    for c in ("_earlier_found", "earlier", "row", "spans", "items", "matches", "n_words"):
        docs = docs.withColumn(c, F.lit(c))
    one, many = (dc.find_matches(docs, bench, block_words=n).orderBy("row.doc_id").collect() for n in (10_000, 5))
    assert [(r.n_words, r.spans, r["items"]) for r in one] == [(r.n_words, r.spans, r["items"]) for r in many]
    assert [r.row["_earlier_found"] for r in many] == ["_earlier_found"] * 3 and [bool(r.spans) for r in many] == [True, False, True]
