r"""Operator 1, chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Neighbouring turns of one role share
a block; array functions write the blocks and join them:

    ### role:\n  text [</part>\n text ...]  </turn>\n

Control strings inside texts and roles are escaped so that they cannot occur there: `\` becomes `\\`,
`</` becomes `<\/`, `##` becomes `#\#` (in roles also `:` becomes `\:`). Removing the backslash before
each escaped character gives the text back, so the output can be read without the input.

Defined results: a null text or role is empty; turns are ordered by (turn, role, text) with null turns
first, so ties and repeated rows have a fixed order and all stay; a null conversation id is a
conversation of its own; an empty table gives no rows; other columns are ignored. One conversation is
one output row, so its turns must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.llm.common import read_table

TURN_END, PART_END, HEAD = "</turn>\n", "</part>\n", "### "
PROBE_TEXT = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("</"), F.lit("<\\/"))
    return F.replace(out, F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, segments): ``segments`` cuts ``formatted`` into (text, loss) runs; the loss
    mask covers the texts of ``loss_roles`` and nothing of the template."""
    collected = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")))).alias("turns"))

    def block(turn: Column, i: Column) -> Column:
        all_turns = F.col("turns")
        first = (i == 0) | (F.try_element_at(all_turns, F.when(i == 0, F.lit(1)).otherwise(i))["role"] != turn["role"])
        following = F.try_element_at(all_turns, i + 2)["role"]
        last = following.isNull() | (following != turn["role"])
        head = F.concat(F.lit(HEAD), _role(turn["role"]), F.lit(":\n"))
        return F.array(
            F.struct(F.when(first, head).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), turn["role"].isin(*loss_roles).alias("loss")),
            F.struct(F.when(last, F.lit(TURN_END)).otherwise(F.lit(PART_END)).alias("text"),
                     F.lit(False).alias("loss")))

    return (collected.select("conv_id", F.flatten(F.transform("turns", block)).alias("segments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that stand in a formatted conversation, as an array of structs."""
    # every block ends in TURN_END, so the last piece is empty
    blocks = F.split(formatted, r"\Q</turn>\E\n", -1)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))

    def turns(b: Column) -> Column:
        head = F.regexp_extract(b, r"(?s)\A### ((?:[^\\:]++|\\.)*+):\n", 1)
        body = F.substr(b, F.length(head) + F.lit(len(HEAD) + 3))
        return F.transform(F.split(body, r"\Q</part>\E\n", -1),
                           lambda t: F.struct(unescape(head).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    done = format_chats(turns.unionByName(probe))
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("t"),
                       F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                                lambda s: unescape(s["text"])), "").alias("loss"))
    said = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


OP1_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '</', '<\/'), '##', '#\#') AS et,
             replace(replace(replace(replace(role, '\', '\\'), '</', '<\/'), '##', '#\#'), ':', '\:') AS er,
             lag(role) OVER w IS DISTINCT FROM role AS first
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(et) + 8 + CASE WHEN first THEN 6 + length(er) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
