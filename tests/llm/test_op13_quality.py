"""Gradients against differences, held-out accuracy on the test data, and the cases of the docstrings."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import op13_quality as Q

DOC = "doc_id bigint, text string, score string, quality int"


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def prose(rng, n):
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def made():
    """Prose; label 0 where one passage of many is junk."""
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(500):
        words = prose(rng, rng.randrange(20, 400)).split()
        if i % 2 == 0:
            at = rng.randrange(len(words))
            words[at:at + 40] = [f"{w}###" for w in words[at:at + 40]] if i % 4 else ["lala"] * 40
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, np.array(labels)


def fitted(texts, labels, share=None):
    numbers, text = Q.encode(pa.array(texts, pa.string()))
    return Q.fit(numbers, text, labels, share)


def test_passages():
    part, text = Q.passages(np.array([0, 0, 3, 3, 110]), 32)
    assert text.tolist() == [1, 3, 3, 3] and np.bincount(part).tolist() == [3, 32, 32, 43]


def test_numbers_do_not_depend_on_the_slice(monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, 70) + " Ünd! 12", None, "", " \n", "a", prose(rng, 3) + " A B C " * 200]
    whole, text = Q.encode(pa.array(texts))
    assert text.tolist() == [0, 0, 4, *[5] * (len(text) - 3)]
    for i, t in enumerate(texts):
        assert np.array_equal(whole[text == i], Q.encode(pa.array([t], pa.string()))[0])
    monkeypatch.setattr(Q, "WORDS_AT_ONCE", 7)
    assert np.array_equal(Q.encode(pa.array(texts))[0], whole)


def test_gradients():
    rng = np.random.default_rng(0)
    bags = Q.Bags(np.array([0, 0, 0, 1, 3, 3]), 4)
    x, labels = rng.normal(0, 1, (6, Q.WIDTH)), np.array([1., 0, 1, 0])
    model = Q.Model.start(x, rng)
    loss = lambda: float(np.sum(np.log1p(np.exp(-(2 * labels - 1) * model.forward(x, bags)["logit"]))))
    made = model.forward(x, bags)
    found = model.gradients(x, bags, made, Q._sigmoid(made["logit"]) - labels)
    for p, g in zip(model.params, found):
        for at in [tuple(rng.integers(s) for s in p.shape) for _ in range(6)]:
            was = p[at]
            p[at] = was + 1e-5
            high = loss()
            p[at] = was - 1e-5
            low = loss()
            p[at] = was
            assert g[at] == pytest.approx((high - low) / 2e-5, abs=1e-5)


def test_attention_is_a_softmax_of_each_text():
    bags = Q.Bags(np.array([0, 0, 2]), 4)
    weights = bags.softmax(np.array([1., 2., 500.]))
    assert weights.tolist() == pytest.approx([1 / (1 + np.e), np.e / (1 + np.e), 1])
    assert bags.sum(np.array([[1.], [2.], [4.]])).tolist() == [[3], [0], [4], [0]]


def test_finds_the_passage_that_tells(made, spark):
    texts, labels = made
    model = fitted(texts[:400], labels[:400], .5)
    scores, weights, text = model.scores(pa.array(texts[400:]))
    assert auc(scores, labels[400:]) > .95
    rng = random.Random(9)
    long = prose(rng, 640) + " " + "lala " * 64 + prose(rng, 640)
    docs = spark.createDataFrame([(1, long, "x", 1)], DOC)
    row = Q.score_quality(docs, model, ["doc_id", "quality"], attention=True).first()
    assert row.score < .5 and len(row.attention) == 42 and sum(row.attention) == pytest.approx(1, abs=1e-5)
    assert sum(row.attention[20:22]) > 4 / 42


def test_degenerate_training():
    none = np.zeros((0, Q.WIDTH), np.float32)
    assert Q.fit(none, np.zeros(0, int), np.array([])).scores(pa.array(["x"]))[0][0] == pytest.approx(.5)
    assert fitted(["a b"] * 9, np.ones(9)).scores(pa.array(["c", None]))[0] == pytest.approx([.95] * 2)


def test_rows(spark, made):
    model = fitted(made[0][:100], made[1][:100])
    docs = [(1, None, "x", 1), (2, "", "x", 1), (3, " \n", "x", 1), (None, "banana", None, None), (4, "na " * 300_000 + "###", "x", 1), (5, "kipu", "x", 0), (5, "kipu", "x", 0), (6, "\x00 é😀", "x", 0)]
    rows = Q.score_quality(spark.createDataFrame(docs, DOC), model, ["doc_id"]).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == 8 and by[1] == by[2] == by[3] and all(0 <= r.score <= 1 for r in rows)
    assert Q.score_quality(spark.createDataFrame([], DOC), model, ["doc_id"]).count() == 0


def test_held_out_fold_is_never_learnt(spark, monkeypatch):
    docs = [(i, " ".join([f"t{i}"] * (i % 50)), "s", 0) for i in range(500)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(500)] + [(None, 0, 1), (3, 0, None)], "doc_id bigint, toxic int, quality int")
    fold = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(500)]
    frame = spark.createDataFrame([*docs, docs[0], docs[0], (None, "x", "s", 0)], DOC)
    numbers, text, found, share = Q.training_sample(frame, labels, per_class=1000)
    assert len(found) == 500 - sum(fold) and abs(share - .5) < .05 and len(numbers) == len(text) and len(set(text.tolist())) == sum(not f and i % 50 > 0 for i, f in enumerate(fold))
    assert [r.h for r in frame.limit(500).select("doc_id", Q.held_out(F.col("doc_id")).alias("h")).collect()] == fold
    _, _, found, _ = Q.training_sample(frame, labels, per_class=20)
    assert np.bincount(found).tolist() == [20, 20]
    empty = Q.training_sample(frame.where("false"), labels)
    assert len(empty[0]) == len(empty[2]) == 0


def test_long_texts_are_learnt_from_all_over(spark):
    text = " ".join(f"w{i}" for i in range(32 * 300))
    out = next(Q._Encode()([pa.RecordBatch.from_arrays([pa.array([text, "a", None]), pa.array([1, 0, 1])], names=["text", "quality"])]))
    rows = [np.frombuffer(b, np.float32).reshape(-1, Q.WIDTH) for b in out.column(0).to_pylist()]
    whole, _ = Q.encode(pa.array([text]))
    assert [len(r) for r in rows] == [Q.TRAIN_PASSAGES, 1, 0]
    assert np.array_equal(rows[0], whole[np.arange(64) * 300 // 64])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.score_quality(docs, Q.learn(docs, labels), ["doc_id"]).join(labels, "doc_id").where(Q.held_out(F.col("doc_id"))).toPandas()
    assert auc(scored.score.to_numpy(), scored.quality.to_numpy()) > .99
    assert ((scored.score >= .5) == (scored.quality == 1)).mean() > .98
