r"""Operator 11, mixing sources to target weights, with DataFrame functions only.

Sources share ``share`` times all words by their weights; no source may exceed ``cap`` times its own
words, and what it can't take is shared anew by weight among the others (``targets``).

A document's key is exponential: ``-ln(u) / quality``, u from a keyed digest of its id and text. In key
order the documents of a source are a weighted sample without replacement (Efraimidis-Spirakis). A
target takes complete epochs of its source first; the words left over are taken in key order until
they are used up, so only the last document that takes part is cut. A document's place comes from prefix sums: rows
are dealt to ranges of (source, key), each range is cut into runs of bounded length, sums inside a run
are a window, and runs are summed up by their totals. So a source of any size spreads over all tasks.

Defined results: a null or empty text has size 0 and takes nothing; a null source is one source, the
last; an empty string is a source too; a null id is kept; repeated rows count each (equal rows share their key,
so which of them is cut makes no difference); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import read_table, stored
from ridemart.operators.keys import dense_key

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one source in key order that one window group holds.
RUN_ROWS = 1000
_LOW = (1 << 33) - 1


def letter_share(text: Column) -> Column:
    """Quality weight of a text, 0.01 to 1: the cube of the share of letters and spaces in it."""
    bare = F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    share = bare / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.01), share * share * share)


def exponential_key(ident: Column, digest: Column, quality: Column, seed: str) -> Column:
    """-ln(u) / quality with u in (0, 1) from 48 bits of a digest."""
    drawn = F.md5(F.concat_ws(":", F.lit(seed), ident.cast("string"), digest).cast("binary"))
    u = (F.conv(F.substring(drawn, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.ln(u) / quality


def targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """(source, source_size) with ``target``: the weights go to the sources by code point, null last, over and over.

    A target is the lesser of ``cap`` times the size and level times the weight; each round shares what
    the capped sources leave by weight among the rest, until no other one is above its cap."""
    order = [F.col("source").asc_nulls_last()]
    given = F.array(*[F.lit(float(w)) for w in weights])
    placed = stored(dense_key(sources, order, "nth").withColumn(
        "w", F.element_at(given, (F.col("nth") % len(weights) + 1).cast("int"))), "mix-sources")
    top = F.col("source_size") * F.lit(float(cap))
    all_words, open_w = placed.agg(F.sum("source_size"), F.sum("w")).first()
    goal, level, capped = share * (all_words or 0), 0.0, -1
    if open_w:
        level, capped = goal / open_w, 0
    while open_w:
        full = top <= F.lit(level) * F.col("w")
        n, held, open_w = placed.agg(F.count_if(full), F.sum(F.when(full, top)), F.sum(F.when(~full, F.col("w")))).first()
        if n == capped or not open_w:
            break
        capped, level = n, (goal - (held or 0.0)) / open_w
    return placed.select("source", "source_size", F.least(top, F.lit(level) * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality=letter_share,
        seed: str = "mix") -> DataFrame:
    """One row per document row: doc_id, source, digest (md5 of the text), size, source_size, target,
    epochs (whole copies that every document of the source gives), taken (words, repeats counted)."""
    text = F.coalesce(F.col("t"), F.lit(""))
    thin = stored(
        docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{source_col}`"].cast("string").alias("source"),
                    docs[f"`{text_col}`"].cast("string").alias("t"))
        .select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                F.md5(text.cast("binary")).alias("digest"), quality(text).alias("quality"))
        .select("doc_id", "source", "size", "digest", exponential_key(F.col("doc_id"), F.col("digest"), F.col("quality"), seed)
                .alias("key")), "mix-keys")
    order = [F.col("key"), F.col("doc_id"), F.col("digest")]
    ranges = (thin.repartitionByRange(F.col("source").asc_nulls_last(), *order)
              .sortWithinPartitions(F.col("source").asc_nulls_last(), *order))
    at = F.monotonically_increasing_id()
    # written once: later jobs read the ranges and the places in them instead of dealing anew
    runs = stored(ranges.withColumn("part", F.spark_partition_id())
                  .withColumn("run", F.floor(at.bitwiseAND(F.lit(_LOW)) / RUN_ROWS).cast("long")), "mix-runs")
    totals = stored(runs.groupBy("source", "part", "run").agg(F.sum("size").alias("words")), "mix-totals")
    goals = targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("source").orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1)
    # one row per run, so a thousandth of the documents
    based = totals.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    planned = (based.join(goals.withColumnRenamed("source", "_name"), F.col("source").eqNullSafe(F.col("_name")))
               .select(F.col("source").alias("_source"), F.col("part").alias("_part"), F.col("run").alias("_run"), "base",
                       "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest")))
    inside = Window.partitionBy("source", "part", "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("base") - F.col("before")))
    return (placed.join(planned, (F.col("part") == F.col("_part")) & (F.col("run") == F.col("_run"))
                        & F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", "source", "digest", "size", "source_size", "target", "epochs",
                    (F.col("epochs") * F.col("size") + part).alias("taken")))


def mixture(docs: DataFrame, plan: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", **how) -> DataFrame:
    """The mixed corpus itself: (doc_id, source, epoch, words, text), one row per copy that the mix takes, epochs
    from 1. A copy that is cut holds its first words, one space between them."""
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how) if plan is None else plan
    taken = (plan.where("taken > 0").groupBy("doc_id", "source", "digest", "size").agg(F.sum("taken").alias("taken"))
             .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"), "size", "taken"))
    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    texts = (docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{source_col}`"].cast("string").alias("source"), text.alias("text"))
             .withColumn("digest", F.md5(F.col("text").cast("binary"))))
    texts = texts.groupBy("doc_id", "source", "digest").agg(F.min("text").alias("text"))
    both = texts.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                      & (F.col("digest") == F.col("_digest")))
    copies = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("long"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    return (both.withColumn("epoch", F.explode(copies)).withColumn("words", words)
            .select("doc_id", "source", "epoch", "words", F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text")).alias("text")))


def op11_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP11_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS digest FROM documents),
d AS (SELECT doc_id, source, digest, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             CAST(length(regexp_replace(text, '[^\p{L}\x20\x09-\x0D]+', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS share,
             md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR), digest)) AS drawn FROM t),
k AS (SELECT doc_id, source, digest, size,
             -ln((CAST(CAST('0x' || substr(drawn, 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0)
             / greatest(0.01, share * share * share) AS key FROM d),
s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM k GROUP BY source),
w AS (SELECT source, CAST(n AS DOUBLE) AS n, CAST([3, 1, 2][(nth - 1) % 3 + 1] AS DOUBLE) AS w FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY 2 * n / w, source NULLS LAST) AS i FROM w),
l AS (SELECT i, 2 * n AS top, w,
             (1.5 * sum(n) OVER () - coalesce(sum(2 * n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
v AS (SELECT level FROM l WHERE top > level * w ORDER BY i LIMIT 1),
g AS (SELECT source, CAST(n AS BIGINT) AS source_size, least(2 * n, coalesce((SELECT level FROM v) * w, 0)) AS target FROM w),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g),
p AS (SELECT k.*, b.* EXCLUDE (source),
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, digest
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM p
"""
