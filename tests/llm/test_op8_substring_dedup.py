"""Substring dedup against a search over all windows."""

import random

import pytest

from changeloom.llm import op8_substring_dedup as S

DOC = "doc_id bigint, text string, doc string, row bigint"


def brute(docs, window):
    first, out = {}, []
    split = [(i, (t or "").encode().split()) for i, t, _, _ in docs]
    for i, words in split:
        key = float("inf") if i is None else i
        for a in range(len(words) - window + 1):
            w = tuple(words[a:a + window])
            first[w] = min(first.get(w, key), key)
    for i, words in split:
        key, gone = float("inf") if i is None else i, set()
        for a in range(len(words) - window + 1):
            if first[tuple(words[a:a + window])] < key:
                gone.update(range(a, a + window))
        out.append((i, len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", " x", "é", "long-word"][:rng.choice([2, 5])]
    make = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(n))
    shared = [make(n) for n in (7, 12, 30)]
    docs = [(rng.randrange(60), make(rng.randrange(20)) + "".join(rng.choice(shared) + make(rng.randrange(4)) for _ in range(rng.randrange(3))), "c", 1)
            for _ in range(60)]
    return [*docs, docs[0], docs[1], (None, docs[2][1], "c", 2), (None, shared[2] * 2, "c", 2), (99, None, "c", 3), (98, "", None, None)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bucket,hot", [(20_000, 2_000), (5, 3)])
def test_against_search(spark, seed, bucket, hot):
    docs = case(seed)
    got = S.remove_repeats(spark.createDataFrame(docs, DOC), window=8, gram=3, bucket=bucket, hot_from=hot)
    assert rows(got) == brute(docs, 8)


def test_long_texts_and_empty_table(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = [(2, "x " * 200_000 + passage, "c", 1), (1, passage + " y" * 200_000, "c", 1), (3, "x " * 50, "c", 1)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.remove_repeats(spark.createDataFrame(docs, DOC), digest=True).collect()}
    assert got == {1: (200_060, 0), 2: (200_060, 60), 3: (50, 50)}
    assert S.remove_repeats(spark.createDataFrame([], DOC)).count() == 0
