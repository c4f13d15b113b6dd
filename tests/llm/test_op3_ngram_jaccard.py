"""Groups against all pairs compared, for several boundaries and limits."""

import random

import pytest

from changeloom.llm import op3_ngram_jaccard as N

DOC = "doc_id bigint, text string, label string, n int"


def brute(docs):
    sets = []
    for _, text, *_ in docs:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, *_) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None] if sets[i] else []
        out.append((doc_id, len(sets[i]), min(ids) if ids else doc_id))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def case(seed, count=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Aa", "b", "ÉC", "dd", "e"]) + str(rng.randrange(30))
    passage = [word() for _ in range(30)]
    bases = [[word() for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 25, 60, 200]))] for _ in range(25)]
    docs = []
    for i in range(count):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < .3:
            w += passage
        if rng.random() < .2:
            w = w[:rng.randrange(1, len(w) + 1)]
        docs.append((rng.randrange(10 * count) if rng.random() < .95 else None, rng.choice([" ", "\n", "\t"]).join(w), "x", 1))
    return [*docs, docs[0], (docs[1][0], docs[1][1].swapcase().lower(), "x", 1), (5000, None, "x", 1), (5001, " \n", None, 1), (5002, "", "x", None)]


@pytest.mark.parametrize("seed,boundary,frequent,bucket", [(0, None, 64, 400_000), (1, 0, 3, 50), (2, 32, 3, 300), (3, 16, 2, 40)])
def test_against_all_pairs(spark, seed, boundary, frequent, bucket):
    docs = case(seed)
    got = N.near_groups(spark.createDataFrame(docs, DOC), boundary, frequent, bucket)
    assert rows(got) == brute(docs)


def test_long_texts_chain_and_empty_table(spark):
    base = [f"w{i}" for i in range(100_000)]
    docs = [(9, " ".join(base), "x", 1), (4, " ".join(base[:80_000]), "x", 1), (3, " ".join(base[:62_000]), "x", 1), (2, " ".join(base[50_000:]), "x", 1)]
    assert rows(N.near_groups(spark.createDataFrame(docs, DOC))) == brute(docs)
    assert N.near_groups(spark.createDataFrame([], DOC)).count() == 0


def test_bounds_never_exclude_linked_sets():
    import numpy as np
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(1, 400)
        pool = np.array([rng.getrandbits(64) for _ in range(n + 50)], np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[rng.randrange(40):n + rng.randrange(40)])
        both = len(np.intersect1d(a, b))
        assert N.sketch_distance(N.sketch(a), N.sketch(b)) <= len(a) + len(b) - 2 * both


def test_boundary_follows_cost():
    assert N.boundary_by_cost([(10, 100), (40, 100)], 1.0) == 0
    assert N.boundary_by_cost([(10, 100), (40, 100)], 1000.0) >= 32


@pytest.mark.parametrize("boundary", [0, 64, 128])
def test_a_template_with_own_words_makes_few_meetings(spark, monkeypatch, boundary):
    """Unlinked texts, 80 of 100 words the same: what meets must not grow with the square of their number."""
    rng = random.Random(2)
    template = [f"t{i}" for i in range(80)]
    docs = [(i, " ".join([*template, *[f"o{rng.getrandbits(40)}" for _ in range(20)]]), "x", 1) for i in range(200)]
    met = []
    across = N._across
    monkeypatch.setattr(N, "_across", lambda lists: met.append(across(lists).count()) or across(lists))
    got = rows(N.near_groups(spark.createDataFrame(docs, DOC), boundary))
    assert got == brute(docs) and len({r[2] for r in got}) == 200
    assert met == [0] or met[0] < 1000


@pytest.mark.parametrize("own", [10, 16, 40])
def test_templates_with_varying_sizes(spark, own):
    rng = random.Random(own)
    docs = []
    for i in range(120):
        template = [f"t{j}" for j in range(rng.choice([60, 80, 90]))]
        docs.append((i, " ".join([*template, *[f"o{rng.randrange(60)}" for _ in range(rng.randrange(own))]]), "x", 1))
    for boundary in (0, 128):
        assert rows(N.near_groups(spark.createDataFrame(docs, DOC), boundary, 16, 500)) == brute(docs)


def test_others_are_the_same_in_all_lists(spark):
    """A pair has to meet twice: 300 sets in 12 lists each meet some of a few sets, not none by chance."""
    lists = spark.range(300).selectExpr("id AS set_id", "explode(sequence(0L, 11L)) AS key", "true AS frequent", "100 AS n", "0 AS place", "id AS label")
    pairs = N._meeting_twice(N._others(lists, 0)).collect()
    assert {p.b for p in pairs} == set(range(300)) and len({p.a for p in pairs}) == N.OTHERS and len(pairs) < 300 * N.OTHERS
    assert N._left(lists) == (12 * 300 * 299 / 2, 12 * 300)


def test_pairs_left_are_compared_a_few_for_each_set(spark):
    """5 sets open against 1,000 others: some pairs of each, and after these link nothing is left of the 5,000 but strangers."""
    pairs = spark.range(5).selectExpr("id AS a", "explode(sequence(100L, 1099L)) AS b")
    some = N._some(pairs, 0).collect()
    assert {p.a for p in some} == set(range(5)) and {p.b for p in some} == set(range(100, 1100)) and len(some) <= 1005 * N.OTHERS
    few = spark.createDataFrame([(0, 100), (1, 101), (2, 102)], "a bigint, b bigint")
    label = N._labels(spark.createDataFrame([(0, 100), (1, 101)], "a bigint, b bigint"),
                      spark.range(101, 1100).selectExpr("id AS set_id", "100L AS label"))
    rest = N._not_yet(pairs, few, label)
    assert {r.a for r in rest.collect()} == {2, 3, 4} and rest.count() == 2999
