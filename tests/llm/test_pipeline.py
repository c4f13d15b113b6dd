"""Each stage of the pipeline against a plain version, and the whole run."""

import random
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline as P
from changeloom.llm import op2_pii, op6_toxicity
from test_op2_pii import brute as brute_pii
from test_op3_ngram_jaccard import brute as brute_groups
from test_op4_decontaminate import brute as brute_hits
from test_op9_mix_sources import copies

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = [a + b for a in "bdfgklmnprst" for b in "aeiou"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))
    item = [word() for _ in range(14)]
    docs, labels = [], []
    for i in range(300):
        w = [word() for _ in range(rng.randrange(1, 80))]
        if i % 5 == 0:
            w[rng.randrange(len(w))] = rng.choice(["zwoqix", "vexhumer", "zwoqixed"])
        if i % 11 == 0:
            w += item[rng.randrange(4):]
        if i % 13 == 0:
            w += ["mail", "x.y@z.org", "or", "4111", "1111", "1111", "1111"]
        text = " ".join(w)
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(i % 5 == 0)))
    docs += [(300 + i, d[1] + (" end" if i % 2 else ""), *d[2:]) for i, d in enumerate(docs[:40])]
    docs += [docs[7], (None, docs[8][1], None, None, None), (400, None, None, "s0", None), (401, "", "", None, 0), (402, " \n", "en", "s1", 2)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, DOC).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, docs, [(1, " ".join(item), ""), (2, None, ""), (3, "", "")]


def rows(df):
    return Counter(map(tuple, df.select(*P.COLUMNS).collect()))


def frame(spark, docs):
    # A column more, with a name that stages use themselves.
    return spark.createDataFrame([(*d, "x") for d in docs], DOC + ", score string")


def test_toxicity(spark, tables):
    at, docs, _ = tables
    df = frame(spark, docs)
    kept = rows(P.toxicity(spark, df, at))
    model = op6_toxicity.learn(df, spark.read.parquet(f"{at}/labels.parquet"))
    scores = model.scores(pa.array([d[1] for d in docs]))
    assert kept == Counter(d for d, s in zip(docs, scores) if s < .5 or not (d[1] or "").strip())
    clean = [d for d in docs[:300] if d[0] % 5]
    assert sum(kept[d] > 0 for d in clean) > .97 * len(clean) and sum(kept[d] > 0 for d in docs[:300:5]) < 6


def test_near_duplicates(spark, tables):
    _, docs, _ = tables
    component = {}
    for doc_id, n, low in brute_groups(docs):
        component.setdefault((doc_id, n > 0), low)
    want = Counter()
    for d in docs:
        grouped = bool((d[1] or "").split())
        if not grouped:
            want[d] += 1
        elif component[d[0], True] == d[0]:
            want[d] = 1
    assert rows(P.near_duplicates(spark, frame(spark, docs), "")) == want


def test_decontamination(spark, tables):
    at, docs, items = tables
    hit = {(i, n): h for i, n, h, _ in brute_hits([(d[0], d[1], "") for d in docs], items)}
    want = Counter(d for d in docs if not hit[d[0], len((d[1] or "").split()) if d[0] is None or "@" not in (d[1] or "") else next(n for (i, n) in hit if i == d[0])])
    assert rows(P.decontamination(spark, frame(spark, docs), at)) == want


def test_personal_data(spark, tables):
    _, docs, _ = tables
    got = rows(P.personal_data(spark, frame(spark, docs), ""))
    want = Counter()
    for d in docs:
        text = op2_pii.masked(d[1], [(op2_pii.KINDS.index(k), a, b) for k, a, b in brute_pii(d[1])]) if d[1] else d[1]
        want[(d[0], text, *d[2:4], d[4] if text is None else len(text))] += 1
    assert got == want


def test_mixing(spark, tables):
    _, docs, _ = tables
    n = Counter(d[3] for d in docs)
    total = sum(c ** .5 for c in n.values())
    want = Counter()
    for d in docs:
        want[d] += copies("mix-1", d[0], d[1], n[d[3]] ** .5 / total * len(docs) / n[d[3]])
    assert rows(P.mixing(spark, frame(spark, docs), "")) == +want


def test_run_and_empty_tables(spark, tables):
    at, docs, _ = tables
    out = P.run(spark, at)
    assert out.columns == [*P.COLUMNS, "copy", "shuffle_key"] and 0 < out.count() < 2 * len(docs)
    empty = frame(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, empty, at).count() == 0
