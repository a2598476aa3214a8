"""Operator 9, license scan by an exact set-similarity join.

A template matches a text if some window of the text holds at least ``threshold`` of the template's
different words. A window ends at every template word and has three times the template's words up to
``BLOCK``, or twice its words if that is more, so every template can match. Words are ordered by how often
the corpus has them, rarest first (one count over all documents). A template of m words that needs k of
them must share one of its first m - k + 1 words with the text (prefix filter); a text with fewer than k
template words is skipped (length filter); from the places of a shared word in both orders follows the
most that can still match (positional filter). Only windows around a prefix word are then counted exactly.

A window that holds enough words is verified: a longest common subsequence with the template of at least
``threshold`` of its words (same words in the same order), all words that tell the license from others
(``needs``), and between its first and last template word none that makes it another one (``without``).
Verified windows that overlap make a block. Phrases are templates that need all their words; an exact
check then finds the places where the words stand consecutively.

Templates are a parameter of bounded size (``MAX_TEMPLATE_WORDS``), so they are sent to all tasks.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows give repeated
rows; an empty table gives no rows; an empty template matches nothing; other columns stay in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridemart.llm.common import WORDS, chunks, map_rows, read_table, texts_of

#: Words up to which a window has three times the words of its template.
BLOCK = 64
MAX_TEMPLATE_WORDS = 100_000


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False
    needs: str = ""
    without: str = ""


#: The base phrases, then sentences of common licenses and notices; each matches alone, so a
#: part of a license is found without its opening.
TEMPLATES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                    "and associated documentation files"),
    Template("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, "
                    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
                    "portions of the Software"),
    Template("mit", 'The Software is provided "as is", without warranty of any kind, express or implied, including but not '
                    "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    Template("apache", "Licensed under the Apache License, Version 2.0", needs="apache license"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                       "License at"),
    Template("apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is '
                       'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND'),
    Template("gpl", "licensed under the GNU General Public License, version 3", needs="gnu general public license"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                    "GNU General Public License as published by the Free Software Foundation", needs="gnu general public"),
    Template("gpl", "You should have received a copy of the GNU General Public License along with this program",
             needs="gnu general public"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer"),
    Template("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                    "the following disclaimer in the documentation and/or other materials provided with the distribution"),
    Template("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", needs="cc by nc", without="sa nd"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", needs="cc by sa", without="nc nd"),
    Template("cc-by", "Licensed under CC BY 4.0", needs="cc by", without="nc sa nd"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             needs="creative commons attribution", without="noncommercial sharealike noderivatives noderivs"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             needs="creative commons attribution sharealike", without="noncommercial noderivatives noderivs"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             needs="creative commons attribution noncommercial", without="sharealike noderivatives noderivs"),
    Template("epl", "Licensed under the Eclipse Public License, Version 2.0", needs="eclipse public license"),
    Template("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                    "License which is available at", needs="eclipse public license"),
    Template("mpl", "Licensed under the Mozilla Public License, Version 2.0", needs="mozilla public license"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             needs="mozilla public license"),
    Template("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at", needs="mpl"),
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def template_words(t: Template) -> set[bytes]:
    return set(words_of(f"{t.text} {t.needs} {t.without}".encode()))


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str) -> dict[bytes, int]:
    """How often the corpus has each word of ``vocabulary``."""
    order = sorted(vocabulary)

    def count(batches):
        ids = {w: i for i, w in enumerate(order, 1)}
        total = np.zeros(len(order) + 1, np.int64)
        for b in batches:
            for texts in chunks(b.column(0).cast(pa.string())):
                found = [ids.get(w, 0) for t in texts for w in words_of(t)]
                total += np.bincount(np.array(found, np.int64), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(order))), pa.array(total[1:])], names=["w", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "w long, n long").groupBy("w").agg(
        F.sum("n").alias("n")).collect()  # one row per template word
    n = {r.w: r.n for r in rows}
    return {w: n.get(i, 0) for i, w in enumerate(order)}


class TemplateIndex:
    """Templates in the global word order and the inverted index over their prefixes."""

    def __init__(self, templates: Sequence[Template], frequency: dict[bytes, int], threshold: float):
        order = sorted(frequency, key=lambda w: (frequency[w], w))
        self.rank = {w: i for i, w in enumerate(order, 1)}
        self.templates = templates
        self.sorted = [sorted({self.rank[w] for w in words_of(t.text.encode())}) for t in templates]
        self.words = [[self.rank[w] for w in words_of(t.text.encode())] for t in templates]
        self.need = [len(s) if t.phrase else math.ceil(threshold * len(s) - 1e-9)
                     for t, s in zip(templates, self.sorted)]
        self.window = [max(min(BLOCK, 3 * len(w)), 2 * len(w)) for w in self.words]
        self.in_order = [math.ceil(threshold * len(w) - 1e-9) for w in self.words]
        self.needs = [{self.rank[w] for w in words_of(t.needs.encode())} for t in templates]
        self.without = [{self.rank[w] for w in words_of(t.without.encode())} for t in templates]
        self.bits: list[dict[int, int]] = []
        for w in self.words:
            bits: dict[int, int] = {}
            for place, r in enumerate(w):
                bits[r] = bits.get(r, 0) | 1 << place
            self.bits.append(bits)
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for i, (s, k) in enumerate(zip(self.sorted, self.need)):
            for place, r in enumerate(s[:len(s) - k + 1] if s else []):
                self.prefix.setdefault(r, []).append((i, place))
        self.starts = np.zeros(len(order) + 1, bool)
        self.starts[list(self.prefix)] = True

    def join(self, block: list[int]) -> list[tuple[int, float]]:
        """(template, containment) of the templates that meet their threshold in a text of sorted
        different ranks."""
        have, seen, out = set(block), set(), []
        for j, r in enumerate(block):
            for t, i in self.prefix.get(r, ()):
                s, need = self.sorted[t], self.need[t]
                # i words of s come before and at most as many of the block; none needs to match
                if t in seen or len(block) < need or min(i, j) + 1 + min(len(s) - i, len(block) - j) - 1 < need:
                    continue
                seen.add(t)
                both = sum(x in have for x in s)
                if both >= need:
                    out.append((t, both / len(s)))
        return out

    def subsequence(self, t: int, words: list[int]) -> int:
        """Length of the longest common subsequence of template ``t`` and ``words``: a clear bit of ``row`` is a
        step of the usual table's current row, so a word costs one addition of a template's length in bits."""
        full = (1 << len(self.words[t])) - 1
        row, bits = full, self.bits[t]
        for w in words:
            both = row & bits.get(w, 0)
            row = (row + both | row - both) & full
        return len(self.words[t]) - row.bit_count()

    def blocks(self, t: int, ranks: np.ndarray) -> list[tuple[int, int, float]]:
        """(first word, last word, largest containment) of the runs of overlapping verified windows of ``t``."""
        size, mine = self.window[t], self.sorted[t]
        at = np.flatnonzero(np.isin(ranks, mine))
        rare = np.flatnonzero(np.isin(ranks, mine[:len(mine) - self.need[t] + 1]))
        # a window that matches holds a prefix word, so places farther from all of them are in none
        after = np.searchsorted(rare, at)
        left = at - rare[np.maximum(after - 1, 0)]
        right = rare[np.minimum(after, len(rare) - 1)] - at
        at = at[((left >= 0) & (left < size)) | ((right >= 0) & (right < size))]
        others = np.flatnonzero(np.isin(ranks, list(self.without[t]))) if self.without[t] else at[:0]
        held, first, different = dict.fromkeys(mine, 0), 0, 0
        words, places, found = ranks[at].tolist(), at.tolist(), []
        for i, (r, p) in enumerate(zip(words, places)):
            different += not held[r]
            held[r] += 1
            while p - places[first] >= size:
                held[words[first]] -= 1
                different -= not held[words[first]]
                first += 1
            if different < self.need[t] or not all(held.get(n, 0) for n in self.needs[t]):
                continue
            if np.searchsorted(others, p) > np.searchsorted(others, places[first]):
                continue
            if self.subsequence(t, words[first:i + 1]) < self.in_order[t]:
                continue
            share = different / len(mine)
            if found and places[first] <= found[-1][1]:
                a, _, best = found.pop()
                found.append((min(a, places[first]), p, max(best, share)))
            else:
                found.append((places[first], p, share))
        return found

    def scan(self, ranks: np.ndarray):
        """(places of phrases as (word, label), blocks as (first word, last word, label, containment), labels of
        matching templates, largest containment)."""
        places: set[tuple[int, str]] = set()
        blocks: set[tuple[int, int, str, float]] = set()
        if self.starts[ranks].any():
            for t, _ in self.join(np.unique(ranks[ranks > 0]).tolist()):
                label, w = self.templates[t].label, self.words[t]
                if self.templates[t].phrase:
                    at = np.flatnonzero(ranks[:max(0, len(ranks) - len(w) + 1)] == w[0])
                    for k in range(1, len(w)):
                        at = at[ranks[at + k] == w[k]]
                    places.update((int(p), label) for p in at)
                else:
                    blocks.update((a, b, label, share) for a, b, share in self.blocks(t, ranks))
        labels = {label for _, label in places} | {label for _, _, label, _ in blocks}
        return places, blocks, labels, 1.0 if places else max((share for *_, share in blocks), default=0.0)


_BLOCK = [("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]
_FOUND = ("n_words long, places array<struct<word:long,label:string>>, "
          "blocks array<struct<first:long,last:long,label:string,containment:double>>, labels array<string>, score double")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: float = 0.8,
                  text_col: str = "text") -> DataFrame:
    """(row, n_words, places, blocks, labels, score): places of the phrases, blocks of the other templates by
    their first and last words, labels of all matching templates (phrases only where their words stand
    together), sorted, and the largest containment."""
    vocabulary = {w for t in templates for w in template_words(t)}
    if sum(len(words_of(t.text.encode())) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words: scan in parts")
    index = TemplateIndex(templates, word_frequencies(docs, vocabulary, text_col), threshold)
    kinds = [pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
             pa.list_(pa.struct(_BLOCK)), pa.list_(pa.string()), pa.float64()]

    def run(batches):
        get = index.rank.get
        for rows in batches:
            out: list[list] = [[], [], [], [], []]
            for texts in chunks(texts_of(rows, text_col)):
                for t in texts:
                    ranks = np.array([get(w, 0) for w in words_of(t)], np.int64)
                    places, blocks, labels, best = index.scan(ranks)
                    spans = [dict(zip(("first", "last", "label", "containment"), b)) for b in sorted(blocks)]
                    for o, v in zip(out, (len(ranks), [{"word": w, "label": x} for w, x in sorted(places)], spans,
                                          sorted(labels), best)):
                        o.append(v)
            yield [pa.array(o, k) for o, k in zip(out, kinds)]

    return map_rows(docs, run, StructType.fromDDL(_FOUND))


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = F.transform("places", lambda p: p["word"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                        F.concat_ws(",", base).alias("base_labels"), F.concat_ws(",", "labels").alias("labels"),
                        "score")
