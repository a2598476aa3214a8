import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query, label, share", [(quality.op8_quality_classifier, "quality", 0.97),
                                                 (toxicity.op2_weak_toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, query, label, share):
    rows = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    good = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert good[1] > 100 and good[0] >= share
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxic_documents_are_found_in_every_language(spark):
    rows = toxicity.op2_weak_toxicity(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    got = rows.groupBy("lang").agg(F.sum("toxic").alias("toxic"), F.sum(F.col("toxic") * F.col("predicted")).alias("found"),
                                   F.count_if(F.col("toxic") == 0).alias("clean"), F.sum((1 - F.col("toxic")) * F.col("predicted")).alias("false")).collect()
    assert len(got) == 4 and all(r.found >= 0.8 * r.toxic for r in got)
    assert sum(r.false for r in got) <= 0.01 * sum(r.clean for r in got)


def test_withheld_labels_change_the_training(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    every, few = (toxicity.fit_model(docs, x, F.lit(True)) for x in (labels, labels.where("doc_id % 2 = 0")))
    assert every.voters.texts != few.voters.texts or abs(every.weights - few.weights).max() > 0.01


def test_patterns_of_words_and_long_runs():
    got = toxicity.word_patterns(b"Scumbag scumbag, ok " + b"xy" * 30 + b"insult" + b"z" * 30)
    assert got[" scumbag "] == got[" scum"] == got[" scumb"] == 2 and " ok " not in got
    assert got["insul"] == 1 and got["xyxyx"] == 1
    v = toxicity.Voters([" scum", "insul"])
    x = v.features([b"scum", b"scum scums scummy scumbag", b"a" * 50 + b"insult" + b"b" * 50, b""])
    at = toxicity.LEVELS * len(toxicity.LEXICONS)
    assert x[:, at:at + 6].tolist() == [[1, 0, 0, 0, 0, 0], [0, 0, 1, 0, 0, 0], [0, 0, 0, 1, 0, 0], [0] * 6]


def test_held_out_rule(spark):
    for q, n, r in ((quality.op8_quality_classifier, 5, 0), (toxicity.op2_weak_toxicity, 3, 1)):
        for x in q(spark, "/root/testdata/sf0.001").collect():
            assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % n == r)
            assert x.predicted == int(x.score >= (0.3 if n == 5 else 0.7))


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    usable = F.lit(True)
    for q in (labels, labels.limit(0)):
        model = quality.fit_model(odd, q, usable)
        scored = quality.score_quality(odd, model).collect()
        assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
        same = {r.score for r in scored if r.row.text == "The cat sat on the mat"}
        assert len(same) == 1
        tox = toxicity.score_toxicity(odd, toxicity.fit_model(odd, q, usable)).collect()
        assert len(tox) == odd.count() and all(0 <= r.score <= 1 for r in tox)
    kept = quality.keep_good(odd, labels, usable)
    assert kept.columns == odd.columns
    assert quality.score_quality(empty, model).count() == 0
    assert quality.fit_model(empty, labels, usable).score(*quality.passage_features([b""])) == [0.5]


def test_word_lists_alone_flag_insults(spark, empty):
    model = toxicity.fit_model(empty, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    clean, bad = model.score([b"a kind word", b"you stupid, worthless idiot"])
    assert clean < 0.5 < bad


def test_passage_features_brute_force():
    texts = [b"", b"One two two x!!", b"a " * 200, "é ñ".encode()]
    x, count = quality.passage_features(texts)
    assert count.tolist() == [1, 1, 4, 1] and len(x) == 7
    assert x[1][-4] == pytest.approx(1 / 4)  # one word repeats the one before
    assert x[1][-2] == pytest.approx(3 / 4)  # three different words
    assert x[2][-2] == pytest.approx(1 / 64)
    letters = np.square(x[1][0])
    assert letters == pytest.approx(9 / 12)  # lower-case letters among bytes that are no space


def test_attention_gradient():
    r = np.random.default_rng(0)
    count = np.array([3, 1, 4, 2] * 30)
    x = r.standard_normal((count.sum(), 6))
    first = np.cumsum(count) - count
    y = (np.maximum.reduceat(x[:, 0], first) > 1).astype(float)  # one passage decides
    m = quality.AttentionModel(6).fit(x, count, y, epochs=80)
    assert ((m.score(x, count) > 0.5) == y).mean() > 0.9


def test_label_model_finds_accuracies_and_correlations():
    r = np.random.default_rng(2)
    y = r.random(4000) < 0.3
    a = np.where(y, r.random(4000) < 0.8, r.random(4000) < 0.05)
    b = a ^ (r.random(4000) < 0.02)  # copies the first voter
    c = np.where(y, r.random(4000) < 0.7, r.random(4000) < 0.1)
    d = r.random(4000) < 0.5  # knows nothing
    e = np.where(y, r.random(4000) < 0.75, r.random(4000) < 0.05)
    votes = np.stack([a, b, c, d, e], 1).astype(float)
    gold = np.where(r.random(4000) < 0.1, y.astype(int), -1)
    m = toxicity.LabelModel().fit(votes, gold)
    assert ((m.posterior(votes, gold) > 0.5) == y).mean() > 0.9
    assert m.correlation[0, 1] > 0.5 > abs(m.correlation[0, 3])
    assert m.together[0, 1] > 0.5 and m.together[0, 3] == 0
    # the posterior labels come from the votes: an anchor's own label is no vote of theirs
    assert (m.posterior(votes) == m.posterior(votes, np.full(4000, -1))).all()
    alone = toxicity.LabelModel().fit(votes, np.full(4000, -1))
    assert abs(alone.posterior(votes) - m.posterior(votes)).max() > 0.05
