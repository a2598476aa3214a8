"""Operator 8, a quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage of the whole text is encoded
from its byte classes, word lengths and repeated words; gated attention weights, learned from document
labels alone, make one representation, and a logistic unit scores it. The model is fitted in numpy on
at most ``fit_rows`` labelled documents (chosen by a hash of their id) and sent to the tasks: a few
thousand numbers, whatever the corpus holds.

Defined results: a null or empty text is one empty passage; without labels, or with labels of one
class, every score is the smoothed share of label 1 (0.5 without labels); repeated rows are scored
alike; a null id can't be a training row; an empty table gives no rows; other columns are kept by
``keep_good`` and ignored elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridemart.llm.common import chunks, crc_mod, labelled_sample, map_rows, read_table, texts_of

PASSAGE_WORDS = 64
#: Bound on the documents the model is fitted on.
FIT_ROWS = 6000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _byte_classes() -> np.ndarray:
    """Class of each byte: letters, digits, other ASCII controls, non-ASCII; each punctuation mark its own."""
    out, marks = np.empty(256, np.int64), 5
    for c in range(256):
        ch = chr(c)
        if c >= 128:
            out[c] = 3
        elif ch.islower():
            out[c] = 0
        elif ch.isupper():
            out[c] = 1
        elif ch.isdigit():
            out[c] = 2
        elif c <= 32 or c == 127:
            out[c] = 4
        else:
            out[c] = marks
            marks += 1
    return out


_CLASS = _byte_classes()
_CLASSES = int(_CLASS.max()) + 1
_LENGTHS = 16
WIDTH = _CLASSES + _LENGTHS + 4


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, passages of each text); at least one passage a text."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    space = _SPACE[buf]
    begin = np.flatnonzero(~space & np.r_[True, space[:-1]])
    length = np.flatnonzero(~space & np.r_[space[1:], True]) + 1 - begin
    doc = np.searchsorted(np.cumsum(sizes), begin, "right")
    words = np.bincount(doc, minlength=len(texts))
    nth = np.arange(len(begin)) - (np.cumsum(words) - words)[doc]
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    passage = (np.cumsum(count) - count)[doc] + nth // PASSAGE_WORDS
    n = int(count.sum())
    solid = np.flatnonzero(~space)
    held = buf[solid]
    shares = np.bincount(np.repeat(passage, length) * _CLASSES + _CLASS[held], minlength=n * _CLASSES)
    shares = shares.reshape(n, _CLASSES) / np.maximum(1, np.bincount(passage, length, n))[:, None]
    per_word = np.maximum(1, np.bincount(passage, minlength=n))[:, None]
    lengths = np.bincount(passage * _LENGTHS + np.minimum(length, _LENGTHS) - 1, minlength=n * _LENGTHS)
    if len(begin):
        pos = np.arange(len(solid)) - np.repeat(np.cumsum(length) - length, length)
        power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
        code = np.add.reduceat((held.astype(np.uint64) + np.uint64(1)) * power[pos], np.cumsum(length) - length)
    else:
        code = np.empty(0, np.uint64)
    repeats = []
    for back in (1, 2):
        same = np.zeros(len(code), bool)
        same[back:] = (code[back:] == code[:-back]) & (doc[back:] == doc[:-back])
        repeats.append(np.bincount(passage[same], minlength=n)[:, None] / per_word)
    order = np.lexsort((code, passage))
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[order][1:] != code[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][fresh], minlength=n)[:, None] / per_word
    x = np.hstack([np.sqrt(shares), lengths.reshape(n, _LENGTHS) / per_word, *repeats, distinct, per_word / PASSAGE_WORDS])
    return x.astype(np.float32), count


class AttentionModel:
    """Encoder tanh(x W + b), attention softmax over w . (tanh(h V) * sigmoid(h U)), logistic head."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 12, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {"W": r.normal(0, 1 / np.sqrt(width), (width, hidden)), "b": np.zeros(hidden),
                  "V": r.normal(0, 1 / np.sqrt(hidden), (hidden, gate)),
                  "U": r.normal(0, 1 / np.sqrt(hidden), (hidden, gate)), "w": r.normal(0, 0.1, gate),
                  "c": r.normal(0, 0.1, hidden), "d": np.zeros(1)}
        self.mean, self.scale, self.prior = np.zeros(width), np.ones(width), None

    def _forward(self, x: np.ndarray, starts: np.ndarray):
        p = self.p
        bag = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40)))
        return bag, h, t, g, a, z, y

    def score(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(count), self.prior)
        return self._forward((x - self.mean) / self.scale, np.cumsum(count) - count)[-1]

    def fit(self, x: np.ndarray, count: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64,
            rate: float = 0.01, decay: float = 1e-4, seed: int = 11) -> AttentionModel:
        if len(y) == 0 or y.min() == y.max():
            self.prior = float((y.sum() + 1) / (len(y) + 2))
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 0.02
        x = (x - self.mean) / self.scale
        p, r = self.p, np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        first, step = np.cumsum(count) - count, 0
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs) + rate / 50
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                pick = order[i:i + batch]
                n = count[pick]
                rows = np.concatenate([np.arange(first[j], first[j] + count[j]) for j in pick])
                xb, starts = x[rows], np.cumsum(n) - n
                bag, h, t, g, a, z, out = self._forward(xb, starts)
                dy = (out - y[pick]) / len(pick)
                dz = dy[:, None] * p["c"]
                da = (dz[bag] * h).sum(1)
                de = a * (da - np.add.reduceat(a * da, starts)[bag])
                dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
                dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
                grad = {"W": xb.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                        "c": z.T @ dy, "d": np.array([dy.sum()])}
                step += 1
                for k in p:
                    d = grad[k] + decay * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.999 * s[k] + 0.001 * d * d
                    p[k] = p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fit_model(docs: DataFrame, labels: DataFrame, usable, label: str = "quality", fit_rows: int = FIT_ROWS,
              id_col: str = "doc_id", text_col: str = "text") -> AttentionModel:
    def encode(batches):
        for b in batches:
            xs, counts = [], []
            for texts in chunks(b.column(1).cast(pa.string())):
                x, c = passage_features(texts)
                counts += c.tolist()
                xs += [v.tobytes() for v in np.split(x, np.cumsum(c)[:-1])]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array(counts, pa.int32()),
                                              pa.array(xs, pa.binary())], names=["y", "n", "x"])

    rows = (labelled_sample(docs, labels, label, usable, fit_rows, id_col, text_col)
            .mapInArrow(encode, "y int, n int, x binary").collect())
    rows.sort(key=lambda r: (r.y, r.n, bytes(r.x)))  # the same model whatever order tasks end in
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(-1, WIDTH).astype(float)
    return AttentionModel(WIDTH).fit(x, np.array([r.n for r in rows], int), np.array([r.y for r in rows], float))


def score_quality(docs: DataFrame, model: AttentionModel, text_col: str = "text") -> DataFrame:
    """(row, score): row holds all columns of ``docs``."""
    def run(batches):
        for rows in batches:
            out = [np.empty(0)]
            for texts in chunks(texts_of(rows, text_col)):
                out.append(model.score(*passage_features(texts)))
            yield [pa.array(np.concatenate(out))]

    return map_rows(docs, run, StructType.fromDDL("score double"))


def keep_good(docs: DataFrame, labels: DataFrame, usable, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    return score_quality(docs, fit_model(docs, labels, usable)).where(F.col("score") >= threshold).select("row.*")


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_model(docs, read_table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    scored = score_quality(docs, model).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
