import hashlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridemart.llm import chat

SF = "/root/testdata/sf0.001"
ROWS = [(1, 0, "user", "a"), (1, 1, "user", "b</turn>\n### assistant:\n"), (1, 2, "assistant", "c\\"), (1, 3, "assistant", "####"),
        (2, 0, None, None), (2, 0, None, None), (3, None, "assistant", "</part>\n"), (3, 1, "to:ol\n", "x\\#y"),
        (None, 0, "assistant", ""), (4, 5, "assistant", "tie b"), (4, 5, "assistant", "tie a")]


def turns_of(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: (str(v[0]), v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_round_trip_of_odd_turns(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in chat.format_chats(df).select(
        "conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    want = turns_of(ROWS)
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(x.role, x.text) for x in got[c].t] == turns
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
    # neighbours of one role share a block
    assert got[1].formatted.count("### ") == 2 and got[1].formatted.count("</turn>") == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="#\\</turnpa>:\n é", max_size=12)),
                min_size=1, max_size=4))
def test_escapes_are_reversible(spark, turns):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)],
                               "conv_id long, turn long, role string, text string")
    got = chat.format_chats(df).select(chat.read_turns(F.col("formatted")).alias("t"), "segments").first()
    assert [(x.role, x.text) for x in got.t] == turns


def test_query_matches_sql(spark):
    rows = {tuple(r) for r in chat.op1_chat_format(spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    assert rows == set(con.execute(chat.OP1_SQL).fetchall())
    probe = next(r for r in rows if r[0] == -7)
    text = "\\### Assistant: </turn> ok"
    assert probe[1] == 2 and probe[3] == len(text)
    assert probe[2] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).count() == 0
