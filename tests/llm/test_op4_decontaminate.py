"""Decontamination against a word-by-word search, and the cases of its docstring."""

import random
import re
import time

import pyarrow as pa
import pytest

from changeloom.llm import words as W
from changeloom.llm.op4_decontaminate import Index, decontaminate

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id bigint, text string, source string", "item_id bigint, text string, source string"


def lower(text):
    return SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text, _ in docs:
        words, hit, ids = lower(text), set(), set()
        for item_id, item, _ in items:
            own = lower(item)
            n = min(10, len(own))
            windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set()
            for i in range(len(words) - n + 1):
                if windows and tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids.add(str(item_id) if item_id is not None else "")
        out.append((doc_id, len(words), len(hit), sorted(ids)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=str)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "ç", "D", "e9", "ff"][:rng.choice([2, 4, 6])]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25])), "s") for i in range(12)] + [(None, text(12), None), (3, text(14), "s")]
    docs = []
    for i in range(40):
        parts = [text(rng.randrange(40))] + [rng.choice(items)[1] + " " + text(5) for _ in range(rng.randrange(3))]
        docs.append((i, " ".join(parts), "s"))
    return [*docs, docs[0], (None, docs[3][1], None), (77, None, "s"), (78, "", "s")], items


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_against_search(spark, seed, block_bytes):
    docs, items = random_case(seed)
    got = decontaminate(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), block_bytes=block_bytes)
    assert rows(got) == brute(docs, items)


def test_long_text_and_empty_tables(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = [(1, "x " * 300_000 + item + " y" * 300_000, "s"), (2, "the " * 50_000, "s")]
    items = spark.createDataFrame([(5, item, "s"), (6, "the " * 40, "s")], ITEM)
    got = decontaminate(spark.createDataFrame(docs, DOC), items)
    assert rows(got) == [(1, 600_012, 12, ["5"]), (2, 50_000, 50_000, ["6"])]
    assert decontaminate(spark.createDataFrame([], DOC), items).count() == 0
    assert rows(decontaminate(spark.createDataFrame(docs[1:], DOC), spark.createDataFrame([], ITEM))) == [(2, 50_000, 0, [])]


def test_repeated_words_cost_what_the_text_costs(spark):
    item, text = "ha " * 2_000, "ha " * 20_000
    index = Index(["1", "2"], [item, "ha " * 500], 10, 5)
    words = W.Words(pa.array([text]), W.LETTERS)
    hashes = words.hashes()
    began = time.perf_counter()
    found = [(first, kind) for first, kind, _ in index.occurrences(hashes, words.offsets)]
    assert time.perf_counter() - began < 1
    assert len(found) == 1 and len(found[0][0]) == 20_000 - 9 and set(found[0][1].tolist()) == {0}
    docs = [(1, text, "x"), (2, "ha " * 9, "x"), (3, "ho ha " * 3_000, "x")]
    items = [(1, item, "x"), (2, "ha " * 500, "x"), (3, "ha", "x"), (3, "ha ho " * 400, "x"), (4, "Ha! HA!", "x")]
    assert rows(decontaminate(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))) == [
        (1, 20_000, 20_000, ["1", "2", "3", "4"]), (2, 9, 9, ["3", "4"]), (3, 6_000, 6_000, ["3"])]


def test_many_items_with_one_passage(spark):
    shared = " ".join(f"s{i}" for i in range(12))
    items = [(i, f"{shared} own{i}" if i % 2 else "one two", "x") for i in range(300)]
    got = decontaminate(spark.createDataFrame([(1, f"a {shared} b one two", "x")], DOC), spark.createDataFrame(items, ITEM))
    assert rows(got) == [(1, 16, 14, sorted(str(i) for i in range(300)))]
