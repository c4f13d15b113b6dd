"""Ranked search against scores of all documents, the work it saves, and the cases of its docstring."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from changeloom.llm import op12_lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id bigint, text string, score string", "item_id bigint, text string, rank string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t, _ in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_words = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text, _ in items:
        found = []
        for d, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // n_words
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, times in Counter(terms(text)).items() if c[t])
            if score > 0:
                found.append((score, d))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(item_id, i + 1, d, s) for i, (s, d) in enumerate(found[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(seed, n_docs=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"Ü{i}x" for i in range(60)]

    def text(n):
        return "".join(rng.choice(vocabulary[:rng.choice([3, 20, 60])]) + rng.choice([" ", "-", ", ", "\n"]) for _ in range(n))
    docs = [(i * 7 % 1000, text(rng.randrange(1, 60)), "x") for i in range(n_docs)]
    docs += [(5000 + i, docs[3][1], "x") for i in range(40)] + [docs[4], docs[4]]           # ties, repeated rows
    docs += [(9000, None, None), (9001, "", "x"), (9002, "--- \x00", "x"), (None, docs[5][1], "x"), (9003, "w1 " * 30_000 + "w2", "x")]
    items = [(i, text(rng.randrange(1, 30)), "x") for i in range(12)] + [(3, "w1 W1 w2", "x"), (3, "w1 W1 w2", "x"), (None, docs[3][1], "x"), (90, None, "x"), (91, "", None), (92, "unknown", "x")]
    return docs, items


@pytest.mark.parametrize("seed,k,shard_rows,block_bytes", [(0, 10, 1 << 15, 1 << 20), (1, 3, 20, 1 << 20), (2, 10, 50, 200), (3, 60, 1, 1 << 20)])
def test_against_all_scores(spark, seed, k, shard_rows, block_bytes):
    docs, items = made(seed)
    got = L.search(spark.createDataFrame(docs, DOC).repartition(3), spark.createDataFrame(items, ITEM), k, block_bytes, shard_rows)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOC), spark.createDataFrame([], ITEM)
    some = spark.createDataFrame([(1, "a b", "x")], DOC)
    assert L.search(docs, spark.createDataFrame([(1, "a", "x")], ITEM)).count() == L.search(some, items).count() == 0
    assert L.search(some.where("doc_id < 0"), items).count() == 0
    assert L.search(spark.createDataFrame([(1, None, "x")], DOC), spark.createDataFrame([(1, "a", "x")], ITEM)).count() == 0


def shard_of(n_docs=4000, n_terms=6, seed=5):
    rng = np.random.default_rng(seed)
    holds = rng.random((n_docs, n_terms)) < .5
    offsets = np.concatenate(([0], np.cumsum(holds.sum(1))))
    found = np.nonzero(holds)[1]
    tfs = rng.zipf(1.7, len(found)).clip(1, 500)
    lengths = np.maximum(1, np.bincount(np.nonzero(holds)[0], tfs, n_docs).astype(np.int64))
    ids = np.stack((np.arange(n_docs), np.ones(n_docs, np.int64)))
    return L.Shard(ids, lengths, offsets, found, tfs, np.array([4000, 900, 300, 90, 20, 5]), n_docs, int(lengths.sum()))


def test_stops_early_and_at_the_same_ranks():
    shard, none = shard_of(), np.zeros(0, np.int64)
    asked, times = np.arange(6), np.ones(6, np.int64)
    total = np.add.reduceat(np.append(shard.impacts, 0), shard.offsets[:-1]) * (np.diff(shard.offsets) > 0)
    scores, ids, _ = shard.best(asked, times, (none, none, none), 10)
    assert ids.tolist() == np.lexsort((np.arange(4000), -total))[:10].tolist() and scores.tolist() == sorted(total, reverse=True)[:10]
    assert shard.read < 3000
    # A high k-th score from other shards ends the search before anything is read; nothing stays marked.
    before, high = shard.read, (np.full(10, 10 ** 12), np.arange(10), np.ones(10, np.int64))
    assert shard.best(asked, times, high, 10) is high and shard.read == before
    assert not shard.seen.any() and not shard.met.any() and not shard.repeats.any()


def test_a_tie_with_the_bound_is_read_on():
    """Equal documents: the k smallest ids are ranked, wherever they stand in the lists."""
    n = 500
    ids = np.stack((np.arange(n)[::-1], np.ones(n, np.int64)))
    shard = L.Shard(ids, np.full(n, 2), np.arange(0, 2 * n + 1, 2), np.tile([0, 1], n), np.ones(2 * n, np.int64), np.array([500, 900]), n, 2 * n)
    none = np.zeros(0, np.int64)
    assert shard.best(np.array([0, 1]), np.array([1, 2]), (none, none, none), 4)[1].tolist() == [0, 1, 2, 3]


def test_lengths_beyond_64_bits_divide_exactly():
    big = 1 << 45
    shard = L.Shard(np.array([[0], [1]]), np.array([big]), np.array([0, 1]), np.array([0]), np.array([3]), np.array([1000]), 1 << 20, big * 7)
    assert shard.impacts.tolist() == [1000 * (3_000_000_000 // (3000 + 8 * (25 + 75 * big * (1 << 20) // (big * 7))))]


def test_query_against_its_sql(spark):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows(L.op12(spark, sf)) == sorted(con.execute(L.SQL).fetchall(), key=str)
