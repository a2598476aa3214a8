import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import lm_scoring as lm

SF = "/root/testdata/sf0.001"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [" end"]


def test_query_against_brute_force(spark):
    texts = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    rows = lm.op10_log_bilinear(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    out = [r for r in rows if r.held_out]  # on texts it has not seen the model is better than the base
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def vocabulary(words=300):
    return lm.Vocabulary(1 + 20_000 // np.arange(1, words + 1), np.full(lm.REST, 500))


@pytest.mark.parametrize("words", [0, 1, lm.TOP, lm.TOP + 1, 300])
def test_log_probabilities_are_normalised(words):
    voc, r = vocabulary(words), np.random.default_rng(0)
    m = lm.LogBilinear(voc)
    m.p = {x: (v + r.normal(0, 3, v.shape)).astype(np.float32) for x, v in m.p.items()}
    codes = np.arange(voc.start)
    for c in r.integers(0, voc.start + 1, (20, lm.CONTEXT)):
        assert np.exp(m.log_probs(np.repeat(c[None], len(codes), 0), codes)).sum() == pytest.approx(1, abs=1e-4)


def test_log_probabilities_against_a_plain_softmax():
    voc, r = vocabulary(), np.random.default_rng(2)
    m = lm.LogBilinear(voc)
    m.p = {x: (v + r.normal(0, 1, v.shape)).astype(np.float32) for x, v in m.p.items()}
    context, target = r.integers(0, 5, (500, lm.CONTEXT)), r.integers(0, voc.start, 500)
    got = m.log_probs(context, target, size=64)
    p = {x: v.astype(float) for x, v in m.p.items()}
    for c, t, g in zip(context, target, got):
        h = np.r_[sum(p["r"][x] @ p["C"][j * lm.DIM:(j + 1) * lm.DIM] for j, x in enumerate(c)), 1]
        k = voc.class_of[t]
        want = p["q"][k] @ h - np.log(np.exp(p["q"] @ h).sum())
        if t < voc.words:
            of = np.flatnonzero(voc.class_of[:voc.words] == k)
            want += p["v"][t] @ h - np.log(np.exp(p["v"][of] @ h).sum())
        assert g == pytest.approx(want, abs=1e-3)


def test_noise_contrastive_training_learns_words_inside_their_class():
    r, voc = np.random.default_rng(1), lm.Vocabulary(np.full(lm.TOP + 60, 100), np.ones(lm.REST))
    words = np.arange(lm.TOP, lm.TOP + 60)
    prev = r.integers(0, 20, 8000)
    nxt = words[(prev * 7 + 1) % 60]
    m = lm.LogBilinear(voc).copy()
    context = np.stack([prev, prev], 1)
    before = m.log_probs(context, nxt).mean()
    m.train(context, nxt, r, steps=800, k=20)
    assert m.log_probs(context, nxt).mean() > max(before + 2, np.log(0.5))


def test_every_training_token_is_a_target():
    taught = np.r_[np.arange(3, 500), np.arange(700, 1203)]
    for visits in (1, 3):
        rounds = [lm.round_places(4, taught, visits, step) for step in range(lm.ROUNDS)]
        assert np.array_equal(np.sort(np.concatenate(rounds)), np.repeat(taught, visits))
    voc = vocabulary()
    codes = np.random.default_rng(2).integers(0, voc.words, 1300).astype(np.int32)
    context, m = lm._contexts(codes, np.arange(1300), voc.start), lm.LogBilinear(voc).copy()
    m.train(context, codes, np.random.default_rng(3), batch=64, places=np.concatenate(rounds))
    assert m.touched["r"].sum() == 3 * len(taught) * lm.CONTEXT


def test_states_average_rows_by_how_often_they_were_touched():
    a, voc = lm.LogBilinear(vocabulary()), vocabulary()
    x, y = a.copy(), a.copy()
    for m, touched, value in ((x, 1, 2.0), (y, 3, 6.0)):
        m.p["v"][5], m.touched["v"][5] = value, touched
    a.load(x.state().astype(float) + y.state())
    assert np.allclose(a.p["v"][5], 5) and np.allclose(a.p["v"][6], lm.LogBilinear(voc).p["v"][6])


def test_contexts():
    sizes = np.array([3, 1, 2])
    got = lm._contexts(np.array([5, 6, 7, 8, 9, 4]), lm._places(sizes), 99)
    s = 99
    assert got.tolist() == [[s, s], [5, s], [6, 5], [s, s], [s, s], [9, s]]


def test_named_words_grow_with_the_corpus(spark):
    assert [round(lm.named_limit(n), -2) for n in (10**6, 10**9, 10**12)] == [1600, 16000, 160000]
    counts = spark.createDataFrame([(b"a", 9), (b"b", 7), (b"c", 7), (b"d", 2), (b"e", 0)], "token binary, c long")

    def named(limit):
        return [(bytes(r.token), r.code) for r in lm._named(counts, limit).orderBy("code").collect()]

    assert named(0) == [] and named(1) == [(b"a", 0)]
    assert named(2) == [(b"a", 0)]  # equal counts are named together
    assert named(3) == [(b"a", 0), (b"b", 1), (b"c", 2)] and len(named(10)) == 4


def test_context_tells_rare_words_apart(spark):
    """Words of one class follow words of another: the model knows which, the shared hash codes of old could not."""
    r = np.random.default_rng(5)
    pairs = [(f"left{i}", f"right{i}") for i in range(40)]
    texts = [" ".join(w for i in r.integers(0, 40, 60) for w in pairs[i]) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm.score_texts(docs, F.col("doc_id") % 4 == 0).where("held_out").collect()
    assert sum(x.score for x in rows) / sum(x.n_tokens for x in rows) > \
        0.75 * sum(x.base_score for x in rows) / sum(x.n_tokens for x in rows)


def test_odd_rows(spark, odd, empty):
    never = F.lit(False)
    rows = lm.score_texts(odd, never).collect()
    assert len(rows) == odd.count() and {r.train_tokens for r in rows} == {sum(len(tokens(r.text)) for r in odd.collect())}
    assert {(r.n_tokens, r.n_known) for r in rows if r.doc_id in (2, 3, 4)} == {(1, 1)}
    untaught = lm.score_texts(odd, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in untaught} == {(0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in untaught)
    assert lm.score_texts(empty, never).count() == 0


def test_a_class_is_scored_once_over_many_places(monkeypatch):
    r = np.random.default_rng(5)
    voc = lm.Vocabulary(np.sort(r.integers(1, 500, 400))[::-1], np.ones(lm.REST))
    m = lm.LogBilinear(voc)
    context = r.integers(0, voc.start + 1, (1024, lm.CONTEXT)).astype(np.int32)
    target = r.integers(0, voc.start, 1024).astype(np.int32)
    calls, sums = [], lm.LogBilinear._log_sums
    monkeypatch.setattr(lm.LogBilinear, "_log_sums", staticmethod(lambda z: (calls.append(len(z)), sums(z))[1]))
    got = m.log_probs(context, target, size=64)
    assert len(calls) <= 1024 // 64 + voc.classes  # not a product for each class of each 64 places
    one = [m.log_probs(context[i:i + 1], target[i:i + 1])[0] for i in range(0, 1024, 97)]
    np.testing.assert_allclose(got[::97], one, atol=1e-5)


def test_orders_by_several_keys_are_stable():
    r = np.random.default_rng(6)
    for below in (9, 1 << 17):  # by digits, and by comparison
        a, b = (r.integers(0, below, 500) // (below // 9) for _ in range(2))
        want = sorted(range(500), key=lambda i: (a[i], b[i]))
        assert lm._sorted_order(a, b, below=below).tolist() == want


@pytest.mark.parametrize("visits", [1, 3])
def test_a_large_corpus_takes_the_same_steps_as_a_small_one(spark, monkeypatch, visits):
    r, voc = np.random.default_rng(5), vocabulary()
    codes = r.zipf(1.3, 9000).astype(np.int64) % voc.start
    sizes, held = [1500] * 6, [False, False, True, False, False, False]
    monkeypatch.setattr(lm, "LEAST_VISITS", visits * 7500)  # no more visits than a large corpus has
    rows = [(7, held, sizes, bytearray(codes.astype(voc.dtype).tobytes()))]
    coded = spark.createDataFrame(rows, "block long, held array<boolean>, sizes array<int>, codes binary").coalesce(1)
    got = lm.train_model(coded, voc, 7500)
    want, taught = lm.LogBilinear(voc), np.flatnonzero(~np.repeat(held, sizes))
    context = lm._contexts(codes, lm._places(np.array(sizes)), voc.start)
    for step in range(lm.ROUNDS):
        want = want.copy()
        want.train(context, codes, np.random.default_rng([step, 0]), batch=1024, k=64, m=8,
                   rate=0.05 * (1 - step / lm.ROUNDS) + 0.005, places=lm.round_places(7, taught, visits, step))
    for x in want.p:
        assert np.abs(got.p[x] - want.p[x]).max() < 5e-3


def test_a_step_sums_the_gradients_of_repeated_rows():
    r = np.random.default_rng(6)
    rows, grad, scale = r.integers(0, 30, 90), r.normal(size=(30, 25)).astype(np.float32), r.normal(size=90).astype(np.float32)
    for given, factor, plain in ((grad, scale, scale[:, None] * np.repeat(grad, 3, 0)), (np.repeat(grad, 3, 0), None, np.repeat(grad, 3, 0))):
        p, memory, touched = np.ones((40, 25), np.float32), np.full((40, 25), 1e-6, np.float32), np.zeros(40, np.float32)
        lm._push(p, memory, touched, rows, given, 0.1, factor)
        total = np.zeros((40, 25))
        np.add.at(total, rows, plain)
        assert p == pytest.approx(1 - 0.1 * total / np.sqrt(1e-6 + total ** 2), abs=1e-4)
        assert touched.tolist() == np.bincount(rows, minlength=40).tolist()


def test_texts_are_cut_into_words():
    texts = ["", " ", "A b\tc\nd\x0be\x0cf\rg", "  \x1c\x85 \u00a0\u2003É a  a ", "end", "a" * 300, "\x00 B"]
    found, sizes, body = lm._local_codes([t.encode() for t in texts] + [b"\xff\xfeA \xc3"])
    words = [found.to_pylist()[i] for i in body]
    want = [[w.encode() for w in tokens(t)] for t in texts] + [[b"\xff\xfea", b"\xc3", lm.END]]
    assert words == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert len(set(found.to_pylist())) == len(found)


@pytest.mark.parametrize("counts", [[5], [10 ** 9, 3, 2, 1, 1, 1], list(range(500, 0, -1)), [7] * 50 + [1] * 3000])
def test_words_are_drawn_by_their_counts(counts):
    voc = lm.Vocabulary(np.array(counts), np.ones(lm.REST))
    r, total = np.random.default_rng(1), sum(counts)
    x = np.concatenate((voc.cum[:-1], np.nextafter(voc.cum[1:], 0), r.random(4000) * total)).reshape(-1, 2)
    assert (voc.word_at(x) == np.searchsorted(voc.cum, x, side="right") - 1).all()
    assert voc.word_at(np.array([float(total)])) == [len(counts) - 1]
