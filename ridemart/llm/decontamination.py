"""Operator 6, benchmark decontamination with suffix arrays of the training shards.

Every shard (a bounded run of whole documents inside a task) gets a suffix array over its words:
the suffixes that start like some test suffix, sorted by their first words up to the window length.
Each test suffix is binary-searched in it; the matching range gives all places where its window
stands. Places on one diagonal (document place less item place) join to the longest verbatim matches.
A document lies in one shard, so no row is shuffled. The benchmark is searched in blocks of bounded
size, one pass over the documents each.

Defined results: a null or empty text has no words and is clean; an item without words matches
nothing; items with the same id count once; an item with a null id gives spans and matches and counts
as an item, but has no place in the list of ids; repeated rows give repeated rows; empty tables give no
rows or clean rows; other columns are kept by ``drop_contaminated`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridemart.llm.common import WORDS, chunks, map_rows, read_table, texts_of

#: Benchmark words in one broadcast block, about 40 bytes each in a task.
BLOCK_WORDS = 2_000_000
_PACK = 3  # words in one sort key, of 21 bits each: more than BLOCK_WORDS values


class TestSuffixes:
    """The windows of a block of items: word ids, and packed keys for the binary search."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.names = window, [name for name, _ in items]
        self.ids: dict[bytes, int] = {}
        rows, owner, place, size = [], [], [], []
        for i, (_, words) in enumerate(items):
            seq = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            w = min(window, len(seq))
            for j in range(len(seq) - w + 1 if w else 0):
                rows.append(seq[j:j + w] + [0] * (window - w))
                owner.append(i)
                place.append(j)
                size.append(w)
        self.rows = np.array(rows, np.int64).reshape(-1, window)
        self.owner, self.place, self.size = (np.array(x, np.int64) for x in (owner, place, size))
        two = min(2, window)
        self.starts = np.unique(self.rows[:, 0] << 21 | (self.rows[:, 1] if two == 2 else 0))
        self.single = np.unique(self.rows[self.size == 1, 0])

    def search(self, words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window number, first word) of all places; ``words``: ids in the shard, 0 for words that no
        item has; ``doc``: each word's document."""
        none = np.empty(0, np.int64)
        if not len(words) or not len(self.rows):
            return none, none
        nxt = np.r_[words[1:], 0]
        at = np.flatnonzero(words)
        pair = words[at] << 21 | nxt[at]
        i = np.minimum(np.searchsorted(self.starts, pair), len(self.starts) - 1)
        keep = self.starts[i] == pair
        if len(self.single):
            keep |= np.isin(words[at], self.single)
        at = at[keep]
        if not len(at):
            return none, none
        # the suffix array: places sorted by their next `window` words, packed into a few keys
        padded = np.r_[words, np.zeros(self.window, np.int64)]
        keys = [self._packed(lambda c: padded[at + c], k) for k in range(0, self.window, _PACK)]
        order = np.lexsort(keys[::-1])
        at, keys = at[order], [k[order] for k in keys]
        which, where = [], []
        for size in np.unique(self.size):
            tests = np.flatnonzero(self.size == size)
            first = self._bounds(keys, 0, size, tests)
            for t, lo, hi in zip(tests[first[0] < first[1]], *(x[first[0] < first[1]] for x in first)):
                for k in range(1, -(-size // _PACK)):  # narrow by the next words
                    low, high = self._limits(t, k, size)
                    lo, hi = lo + np.searchsorted(keys[k][lo:hi], (low, high), "left")
                    if lo >= hi:
                        break
                if lo < hi:
                    which.append(np.full(hi - lo, t))
                    where.append(at[lo:hi])
        if not which:
            return none, none
        which, where = np.concatenate(which), np.concatenate(where)
        last = np.minimum(where + self.size[which] - 1, len(words) - 1)
        inside = (where + self.size[which] <= len(words)) & (doc[where] == doc[last])
        return which[inside], where[inside]

    def _packed(self, column, k: int) -> np.ndarray:
        out = 0
        for c in range(k, k + _PACK):
            out = out << 21 | (column(c) if c < self.window else 0)
        return out

    def _limits(self, t, k: int, size: int):
        """Range [low, high) of key k for windows number t of ``size`` words: words beyond are free."""
        free = 21 * max(0, (k + 1) * _PACK - size)
        low = self._packed(lambda c: self.rows[t, c], k * _PACK) >> free
        return low << free, (low + 1) << free

    def _bounds(self, keys, k: int, size: int, tests: np.ndarray):
        low, high = self._limits(tests, k, size)
        return np.searchsorted(keys[k], low, "left"), np.searchsorted(keys[k], high, "left")


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int
                 ) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of about ``limit`` words; one block at a time is held."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    for r in rows.toLocalIterator():
        words = (r.t or "").encode().translate(WORDS).split()
        if not words:
            continue
        block.append((r.i, words))
        size += len(words)
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


_FOUND = "n_words long, spans array<array<long>>, items array<string>, matches array<struct<item:string,doc_start:long,item_start:long,words:long>>"


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                 item_col: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, n_words, spans, items, matches): row holds all columns of ``docs``; spans are the hit word
    ranges [from, to); items the known item ids with an occurring window, sorted; matches the longest
    verbatim matches with their places."""
    spark = docs.sparkSession
    found_type = StructType.fromDDL(_FOUND)
    kinds = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string()),
             pa.list_(pa.struct([("item", pa.string()), ("doc_start", pa.int64()),
                                 ("item_start", pa.int64()), ("words", pa.int64())]))]

    def scan(df: DataFrame, block, name: str) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches):
            tests = TestSuffixes(shared.value, window)
            get = tests.ids.get
            for rows in batches:
                out = [[], [], [], []]
                for texts in chunks(texts_of(rows, name)):
                    split = [t.translate(WORDS).split() for t in texts]
                    n = np.array([len(w) for w in split], np.int64)
                    words = np.array([get(w, 0) for s in split for w in s], np.int64)
                    base = np.cumsum(n) - n
                    which, where = tests.search(words, np.repeat(np.arange(len(n)), n))
                    doc = np.searchsorted(base + n, where, "right")
                    order = np.argsort(doc, kind="stable")
                    which, where, doc = which[order], where[order], doc[order]
                    cuts = np.searchsorted(doc, np.arange(len(n) + 1))
                    for d in range(len(n)):
                        a, b = cuts[d], cuts[d + 1]
                        out[0].append(int(n[d]))
                        if a == b:
                            for o in out[1:]:
                                o.append([])
                            continue
                        s, w = where[a:b] - base[d], which[a:b]
                        owner, place, size = tests.owner[w], tests.place[w], tests.size[w]
                        out[1].append(_merged(s, s + size))
                        out[2].append(sorted({tests.names[o] for o in owner.tolist()} - {None}))
                        longest: list[list] = []
                        for o, _, x, p, k in sorted(zip(owner.tolist(), (s - place).tolist(), s.tolist(),
                                                        place.tolist(), size.tolist())):
                            last = longest[-1] if longest else None
                            if last and last[0] == o and last[1] - last[2] == x - p and x <= last[1] + last[3]:
                                last[3] = x + k - last[1]
                            else:
                                longest.append([o, x, p, k])
                        out[3].append([{"item": tests.names[o], "doc_start": x, "item_start": p, "words": k}
                                       for o, x, p, k in longest])
                yield [pa.array(o, k) for o, k in zip(out, kinds)]

        return map_rows(df, run, found_type)

    result = None
    for block in _item_blocks(benchmark, item_col, text_col, block_words):
        if result is None:
            result = scan(docs, block, text_col)
            continue
        # the document stays one struct, so its names cannot clash with the earlier findings
        more = scan(result.select(F.col("row"), F.col("row")[text_col].alias("text"),
                                  F.struct(*[F.col(f.name) for f in found_type]).alias("earlier")), block, "text")
        old = F.col("row.earlier")
        spans = F.aggregate(
            F.array_sort(F.concat(old["spans"], F.col("spans"))), F.expr("cast(array() as array<array<bigint>>)"),
            lambda acc, x: F.when((F.size(acc) > 0) & (x[0] <= F.element_at(F.element_at(acc, -1), 2)),
                                  F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                           F.array(F.array(F.element_at(acc, -1)[0],
                                                           F.greatest(F.element_at(acc, -1)[1], x[1])))))
            .otherwise(F.concat(acc, F.array(x))))
        result = more.select(F.col("row.row").alias("row"), "n_words", spans.alias("spans"),
                             F.array_sort(F.array_union(old["items"], F.col("items"))).alias("items"),
                             F.concat(old["matches"], F.col("matches")).alias("matches"))
    return result if result is not None else scan(docs, [], text_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of any item stands."""
    return find_matches(docs, benchmark, window, text_col).where(F.size("spans") == 0).select("row.*")


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_matches(docs, read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    nameless = F.exists("matches", lambda m: m["item"].isNull()).cast("long")
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"),
                        (F.size("items").cast("long") + nameless).alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') g
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') g
       FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) i FROM w, ks WHERE len(ws) >= k)),
h AS (SELECT doc_id, item_id, i, bw.k FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) n_items, string_agg(s, ',' ORDER BY s) l
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) s FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM w LEFT JOIN hw ON hw.doc_id = w.doc_id LEFT JOIN it ON it.doc_id = w.doc_id
"""
