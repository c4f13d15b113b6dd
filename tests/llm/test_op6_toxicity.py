"""Held-out accuracy on the test data, unseen spellings, and the cases of the docstrings."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from changeloom.llm import op6_toxicity as T, words as W

DOC = "doc_id bigint, text string, score string, toxic int"


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.fixture(scope="module")
def made():
    rng = random.Random(8)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    bad = lambda: rng.choice(["zwoqix", "vexhum"]) + rng.choice(["", "s", "er", word()])
    texts, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randrange(5, 300))]
        if i % 2:
            for _ in range(1 + len(words) // 60):
                words.insert(rng.randrange(len(words) + 1), bad())
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, np.array(labels)


def test_unseen_spellings(made):
    texts, labels = made
    model = T.fit(texts[:300], labels[:300], 0.5)
    assert auc(model.scores(pa.array(texts[300:])), labels[300:]) > .97
    clean, toxic = model.scores(pa.array(["banana redo kipu mola", "banana zwoqixedly kipu mola"]))
    assert clean < .5 < toxic


def test_degenerate_training():
    assert T.fit([], np.array([])).scores(pa.array(["x"]))[0] == pytest.approx(.5)
    one = T.fit(["a b"] * 9, np.ones(9))
    assert one.scores(pa.array(["c", None])) == pytest.approx([.95] * 2)


def test_grams_are_whole_words_and_marked_substrings():
    own, bucket = T.word_grams(pa.array(["ab", "é"]))
    # <ab>: 2 of 3, 1 of 4, none of 5; <é>: 1 of 3; and both words.
    assert np.bincount(own).tolist() == [4, 2] and bucket.max() < 1 << T.BUCKET_BITS


def test_rows(spark, made):
    model = T.fit(made[0][:100], made[1][:100])
    docs = [(1, None, "x", 1), (2, "", "x", 1), (None, "banana", None, None), (3, "na " * 400_000 + "zwoqix", "x", 1), (4, "kipu", "x", 0), (4, "kipu", "x", 0)]
    rows = T.score_toxicity(spark.createDataFrame(docs, DOC), model, ["doc_id"]).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == 6 and by[1] == by[2] and all(0 <= r.score <= 1 for r in rows) and by[3] > by[4]
    assert T.score_toxicity(spark.createDataFrame([], DOC), model, ["doc_id"]).count() == 0


def test_held_out_fold_is_never_learnt(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "s", 0) for i in range(500)], DOC)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(500)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, toxic int, quality int")
    texts, found, share = T.training_sample(docs, labels, per_class=1000)
    assert {int(t[1:]) for t in texts.to_pylist()} == {i for i in range(500) if T.fold_of(i)} and abs(share - .5) < .05 and len(found) == len(texts)
    assert [r.h for r in docs.limit(50).select("doc_id", T.held_out(F.col("doc_id")).alias("h")).collect()] == [T.fold_of(i) == 0 for i in range(50)]


def test_long_texts_are_learnt(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    docs = spark.createDataFrame([(i, long if i % 10 == 1 else f"t{i}", "s", 0) for i in range(100)], DOC)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id bigint, toxic int, quality int")
    known = [i for i in range(100) if T.fold_of(i)]
    texts, found, _ = T.training_sample(docs, labels)
    assert len(found) == len(known) and texts.to_pylist().count(long) == sum(i % 10 == 1 for i in known)
    # Over the bytes of the sample, the long ones are cut to stretches from all over the text; all rows stay.
    texts, found, _ = T.training_sample(docs, labels, per_class=100, row_bytes=100)
    texts = texts.to_pylist()
    cut = [t.split() for t in texts if " " in t]
    assert len(found) == len(known) and len(cut) == sum(i % 10 == 1 for i in known) and sum(map(len, texts)) <= 2 * 100 * 100
    at = [int(w[1:]) for w in cut[0]]
    assert 64 <= len(at) < 4000 and min(at) < 500 and max(at) > 3000 and all(at[i + 15] == at[i] + 15 for i in range(0, len(at) - 15, 16))


def test_sample_holds_2000_rows_per_class(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "concat('t', id) as text", "cast(id % 2 as int) as toxic")
    _, found, _ = T.training_sample(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert np.bincount(found).tolist() == [2000, 2000]


def test_shares_of_a_budget():
    assert T.largest_share([5, 1, 9], 15) is None and T.largest_share([5, 1, 9], 12) == 6 and T.largest_share([9, 9], 4) == 2


def test_long_clean_texts_are_clean():
    """Clean texts with a suspicious word each now and then: the more of them a text has, the higher its highest stretch."""
    rng = random.Random(3)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    def text(n, share):  # noqa: E306
        return " ".join("zwoqix" if rng.random() < share else rng.choice(vocabulary) for _ in range(n))
    labels = np.array([i % 2 for i in range(600)])
    model = T.fit([text(rng.randrange(16, 120), .2 if y else .02) for y in labels], labels, .5)
    short, long = model.scores(pa.array([text(64, .02) for _ in range(100)])), model.scores(pa.array([text(4000, .02) for _ in range(100)]))
    assert (short >= .5).mean() < .2 and (long >= .5).mean() < .2


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = T.score_toxicity(docs, T.learn(docs, labels), ["doc_id"]).join(labels, "doc_id").where(T.held_out(F.col("doc_id"))).toPandas()
    assert auc(scored.score.to_numpy(), scored.toxic.to_numpy()) > .92
    assert ((scored.score >= .5) == (scored.toxic == 1)).mean() > .94


def plain_score(model, text):
    """One text, word by word: mean of the numbers of a word's n-grams, mean of a stretch's words, the highest stretch."""
    mask = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)
    roll = int(W.ROLL[0])
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    def of_word(word):
        hashed = [xxhash.xxh3_64_intdigest(word)]
        points = [mix(ord(c) + roll) for c in f"<{word}>"]
        for n in T.NGRAMS:
            for i in range(len(points) - n + 1):
                h = 0
                for p in points[i:i + n]:
                    h = (h * roll + p) & mask
                hashed.append(mix(h) ^ n)
        return sum(model.grams[mix(h) & ((1 << T.BUCKET_BITS) - 1)] for h in hashed) / len(hashed)
    if not words:
        return 1 / (1 + math.exp(-model.bias))
    each, parts = [of_word(w) for w in words], max(1, (len(words) + T.STRETCH // 2) // T.STRETCH)
    means = [sum(x) / len(x) for x in (each[i * T.STRETCH:(i + 1) * T.STRETCH if i < parts - 1 else None] for i in range(parts))]
    return 1 / (1 + math.exp(-(model.bias + max(means) + model.length * math.log(parts))))


def test_scores_against_a_plain_version(made):
    model = T.fit(made[0][:200], made[1][:200], .3)
    texts = [*made[0][200:230], "", None, "Straße ZWOQIXed! 中文 zwo-qix", "a", "x" * 500, "b " * 23, "b " * 24, "b " * 25]
    assert model.scores(pa.array(texts)) == pytest.approx([plain_score(model, t) for t in texts], abs=1e-9)
