"""Poisson replication against a plain inversion, its rates, and the cases of its docstring."""

import hashlib
import math
from collections import Counter

from changeloom.llm import op9_mix_sources as M

DOC = "doc_id bigint, text string, source string, copy int"


def copies(seed, doc_id, text, rate):
    own = f"{seed}:{'' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}"
    u = int(hashlib.md5(own.encode()).hexdigest()[:13], 16) / 2 ** 52
    k, total = 0, 0.0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate else 1.0
        if total > u or k > 10_000:
            return k
        k += 1


def test_draws_and_rates(spark):
    docs = [(i, f"t{i}", "big" if i % 10 else "small", 9) for i in range(5000)] + [(None, None, None, 1), (7, "", None, None)]
    df = spark.createDataFrame(docs, DOC)
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), (None, 0.001), ("absent", 5.0)], "source string, weight double")
    n, total = Counter(d[2] for d in docs), 4.001
    rate = {s: w / total * len(docs) / n[s] for s, w in (("big", 1.0), ("small", 3.0), (None, 0.001))}
    rows = M.mix_sources(df, weights, seed="s").collect()
    want = Counter({d[:3]: c for d in docs if (c := copies("s", d[0], d[1], rate[d[2]]))})
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == want
    share = Counter(r.source for r in rows)
    assert abs(share["small"] / len(rows) - .75) < .02 and abs(len(rows) / len(docs) - 1) < .05
    assert rows[0].asDict().keys() == {"doc_id", "text", "source", "copy", "shuffle_key"}


def test_order_is_shuffled_and_repeatable(spark):
    df = spark.createDataFrame([(i, f"t{i}", "a", 0) for i in range(2000)], DOC)
    first, again = (sorted(map(tuple, M.mix_sources(x).collect())) for x in (df, df.repartition(7, "text")))
    assert first == again
    ids = [r.doc_id for r in M.mix_sources(df).collect()]
    assert sum(b > a for a, b in zip(ids, ids[1:])) < .6 * len(ids)


def test_edges(spark):
    assert M.mix_sources(spark.createDataFrame([], DOC)).count() == 0
    one = spark.createDataFrame([(1, "a", "x", 0)] * 2 + [(2, "b" * 2_000_000, "y", 0)], DOC)
    weights = spark.createDataFrame([("x", 1.0)], "source string, weight double")
    rows = M.mix_sources(one, weights, size=1000.0).collect()
    counts = Counter(r.doc_id for r in rows)
    assert 2 not in counts and counts[1] % 2 == 0 and 2600 < counts[1] < 3400
