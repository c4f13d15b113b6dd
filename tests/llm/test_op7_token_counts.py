"""Counts against a search over all segmentations and against the plain dynamic programme."""

import itertools
import random

from changeloom.llm import op7_token_counts as T

DOC = "doc_id bigint, text string, n_tokens int"


def brute(word, scores, byte):
    options = []
    for cuts in itertools.product([0, 1], repeat=max(0, len(word) - 1)):
        pieces, start = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                pieces.append(word[start:i])
                start = i
        score = n = 0
        for p in pieces:
            if p in scores:
                score, n = score + scores[p], n + 1
            elif len(p) == 1:
                score, n = score + len(p.encode()) * byte, n + len(p.encode())
            else:
                break
        else:
            options.append((-score, n))
    return min(options)


def test_against_all_segmentations():
    rng = random.Random(6)
    scores = {"".join(rng.choice("abé▁") for _ in range(rng.randrange(1, 5))): -rng.random() * 9 for _ in range(60)}
    words = ["".join(rng.choice("abcé😀") for _ in range(rng.randrange(0, 9))) for _ in range(400)]
    trie = T.Trie(scores)
    found = trie.count("▁" + w for w in words)
    for w in words:
        assert found["▁" + w] == brute("▁" + w, scores, trie.byte)[1], w
    prefixes = {("▁" + w)[:i] for w in words for i in range(1, len(w) + 2)}
    assert trie.nodes == len(prefixes)      # one step per shared prefix


def test_documents(spark):
    docs = [(1, "the the end", 0), (2, None, 0), (3, "", 0), (None, " \n ", 0), (4, "a" * 30_000 + " x" * 100_000, 0), (1, "the the end", 0)]
    rows = T.count_tokens(spark.createDataFrame(docs, DOC)).collect()
    scores = T.read_pieces()
    one = {w: n for w, n in T.Trie(scores).count(["▁the", "▁end", "▁x", "▁" + "a" * 30_000]).items()}
    by = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in rows}
    assert by == {1: (3, 2 * one["▁the"] + one["▁end"]), 2: (0, 0), 3: (0, 0), None: (0, 0), 4: (100_001, one["▁" + "a" * 30_000] + 100_000 * one["▁x"])}
    assert len(rows) == 6 and one["▁the"] == 1
    assert T.count_tokens(spark.createDataFrame([], DOC)).count() == 0
