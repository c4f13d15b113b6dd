"""Fingerprints: neighbours and edits against a plain version, collision rates against generalised Jaccard."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeloom.llm import op1_fingerprints as P

DOC = "doc_id bigint, text string, id string, block int"


def plain(docs):
    """doc_id, n_chars, sha of the edited text, texts; for unique ids."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + following[:m]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following)
    return out


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.mark.parametrize("block_ids,group_blocks", [(256, 4096), (3, 2)])
def test_neighbours_edits_and_likeness(spark, block_ids, group_blocks):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghé😀") + str(rng.randrange(12))
    docs = [(i, " ".join(word() for _ in range(rng.randrange(120))), "x", 1) for i in rng.sample(range(-40, 400), 60)]
    docs[3], docs[7] = (docs[3][0], None, "x", 1), (docs[7][0], docs[8][1], None, None)
    rows = {r.doc_id: r for r in P.compare_neighbours(spark.createDataFrame(docs, DOC), 128, block_ids, group_blocks).collect()}
    want, off = plain(docs), []
    assert rows.keys() == want.keys()
    for i, (n, sha, text, edited, following) in want.items():
        assert (rows[i].n_chars, rows[i].edited_sha256) == (n, sha)
        assert len(rows[i].fingerprint) == len(rows[i].edited_fingerprint) == 8 * 128
        if text.split():
            off += [rows[i].near_edited - jaccard(text, edited), rows[i].near_next - jaccard(text, following)]
    assert rows[docs[7][0]].fingerprint == rows[docs[8][0]].fingerprint
    assert abs(sum(off) / len(off)) < .02 and sum(x * x for x in off) / len(off) < .05 ** 2


def test_ranks_follow_weights(spark):
    """Two single-term bags of weights 2 and 6 agree in a third of the samples."""
    df = spark.createDataFrame([(0, "a a"), (1, "a a a a a a")], "k int, said string")
    a, b = (r.signature for r in P.fingerprints(df, ["k"], "said", 600).orderBy("k").collect())
    assert abs(sum(x == y for x, y in zip(a, b)) / 600 - 1 / 3) < .07


def test_edges(spark):
    make = lambda docs: P.compare_neighbours(spark.createDataFrame(docs, DOC), 8)
    assert make([]).count() == 0
    one = make([(5, "abc def", "x", 1)]).first()
    assert one.n_chars == 7 and one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()
    rows = make([(1, "a b c", "x", 1)] * 2 + [(None, "z", "x", 1), (None, None, "x", 1), (2, "w " * 400_000 + "end", "x", 1)]).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "None", "None"]
    assert [r.near_next for r in rows if r.doc_id == 1].count(1.0) == 1
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * 64}


def test_plan_is_native_and_moves_texts_once(spark):
    df = P.compare_neighbours(spark.createDataFrame([(1, "a", "x", 1)], DOC).where(F.col("doc_id") > 0))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("hashpartitioning(block") == 1


def test_error_at_the_number_of_samples_in_use(spark):
    """Bags of 40 words of which 34 are shared, with likeness 34 / 46: the default's spread is that of 48 trials."""
    n, want = 2000, 34 / 46
    rows = spark.range(n).selectExpr("id k", "explode(array(0, 1)) side").selectExpr(
        "k", "side", "concat_ws(' ', transform(sequence(0, 39), i -> concat('w', k, '_', if(i < 34, i, i + 100 * side)))) said")
    pairs = P.fingerprints(rows, ["k", "side"], "said").groupBy("k").agg(F.min_by("signature", "side").alias("a"), F.max_by("signature", "side").alias("b"))
    off = [r.s - want for r in pairs.select(P.likeness(F.col("a"), F.col("b")).alias("s")).collect()]
    error = (sum(x * x for x in off) / n) ** .5
    print("mean", sum(off) / n, "standard error", error)
    assert abs(sum(off) / n) < .01 and error < 1.1 * (want * (1 - want) / P.SAMPLES) ** .5
