"""Benchmark decontamination by winnowing.

Every 10 consecutive item words are a window. Its fingerprint is the smallest 5-gram hash of 6 consecutive ones (5 + 6 - 1 = 10
words), the last one where equal. A document that contains a window has that fingerprint at the same place in it. Document
fingerprints are looked up in the items' fingerprints, and each hit is extended to both sides, word by word, to the
windows it stands for. Equal windows of the items are one, with the list of their items, so a text costs what its words cost even where
both repeat one word. Items of fewer than 10 words are one window each, looked up by their whole hash.

The benchmark is cut into blocks of a bounded number of bytes, each broadcast to all tasks; one
block is the usual case and needs no shuffle. More blocks mean more passes over the documents and
one small join of their findings, so neither side has a size limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

WINDOW = 10
GRAM = 5
# Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 32 << 20
# Findings (text, item) listed at once.
PAIRS = 1 << 20

_FOUND = pa.schema([("doc_id", pa.int64()), ("_row", pa.int64()), ("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    ("items", pa.list_(pa.string()))])
_FOUND_DDL = "doc_id bigint, _row bigint, n_words bigint, spans array<struct<a:bigint,b:bigint>>, items array<string>"


def fingerprints(hashes: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, position of the fingerprint of each, all 5-gram hashes): the smallest gram of a window, the last of equal ones.

    A fingerprint depends on the words of its window alone, so equal windows have theirs at the same place.
    """
    grams = W.gram_hashes(hashes, gram)
    width = window - gram + 1
    smallest = W.sliding_min(grams, width) if len(grams) >= width else grams[:0]
    start = np.flatnonzero(W.room(offsets)[:len(smallest)] >= window)
    at = start.copy()
    for j in range(1, width):
        at = np.where(grams[start + j] == smallest[start], start + j, at)
    return start, at, grams


class _Spans:
    """Distinct stretches of n item words that begin at ``at``, and the items that hold each."""

    def __init__(self, words: np.ndarray, at: np.ndarray, owner: np.ndarray, n: int):
        hashes, item = W.gram_hashes(words, n)[at], owner[at]
        order = np.lexsort((item, hashes))
        hashes, item, at = hashes[order], item[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        other = new.copy()
        other[1:] |= item[1:] != item[:-1]
        self.n, self.hashes, self.place, self.items = n, hashes[new], at[new], item[other]
        self.starts = np.searchsorted((np.cumsum(new) - 1)[other], np.arange(len(self.hashes) + 1))

    def extend(self, words: np.ndarray, start: np.ndarray, grams: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of places in a text whose ``grams`` are known: (start, stretch) where all n words are those of a stretch."""
        kind = np.searchsorted(self.hashes, grams)
        found = np.flatnonzero(kind < len(self.hashes))
        found = found[self.hashes[kind[found]] == grams[found]]
        start, kind = start[found], kind[found]
        for j in range(self.n):
            same = words[start + j] == own[self.place[kind] + j]
            start, kind = start[same], kind[same]
        return start, kind


class Index:
    """Word hashes and fingerprints of one block of items."""

    def __init__(self, ids: list[str], texts: list[str], window: int, gram: int):
        self.window, self.gram, self.ids = window, gram, ids
        words = W.Words(pa.array(texts, pa.string()), W.LETTERS)
        self.words, owner = words.hashes(), words.owner()
        start, at, grams = fingerprints(self.words, words.offsets, window, gram)
        self.prints = np.unique(grams[at])
        self.long = _Spans(self.words, start, owner, window)
        self.short = [_Spans(self.words, words.offsets[np.flatnonzero(words.counts == n)], owner, n)
                      for n in sorted({int(c) for c in words.counts if 0 < c < window})]

    def occurrences(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, _Spans]]:
        """(first word, stretch) of each place where a text holds all words of a stretch, and the stretches they belong to.

        A hit is a window whose fingerprint an item has; it is extended word by word to the whole window. The cost is that
        of the text, however often its words and those of an item repeat.
        """
        start, at, grams = fingerprints(hashes, offsets, self.window, self.gram)
        place = np.minimum(np.searchsorted(self.prints, grams[at]), max(0, len(self.prints) - 1))
        start = start[self.prints[place] == grams[at]] if len(self.prints) else start[:0]
        yield *self.long.extend(hashes, start, W.gram_hashes(hashes, self.window)[start], self.words), self.long
        for spans in self.short:
            grams = W.gram_hashes(hashes, spans.n)
            start = np.flatnonzero(W.room(offsets)[:len(grams)] >= spans.n)
            yield *spans.extend(hashes, start, grams[start], self.words), spans

    def holders(self, text: np.ndarray, kind: np.ndarray, spans: _Spans) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct (text, item) of texts and the stretches they hold, a bounded number at a time."""
        text, kind = np.unique(np.stack((text, kind)), axis=1)
        size = spans.starts[kind + 1] - spans.starts[kind]
        ends = np.cumsum(size)
        low = 0
        while low < len(kind):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
            n = size[low:high]
            at = np.repeat(spans.starts[kind[low:high]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            yield np.unique(np.stack((np.repeat(text[low:high], n), spans.items[at])), axis=1)
            low = high

    def find(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2):
            words = W.Words(part.column(2), W.LETTERS)
            spans, items = [[] for _ in range(part.num_rows)], [set() for _ in range(part.num_rows)]
            if len(words.flat):
                covered, owner = np.zeros(len(words.flat) + 1, np.int64), words.owner()
                for first, kind, held in self.occurrences(words.hashes(), words.offsets):
                    np.add.at(covered, first, 1)
                    np.add.at(covered, first + held.n, -1)
                    for found in self.holders(owner[first], kind, held):
                        for d, i in zip(*found.tolist()):
                            items[d].add(self.ids[i])
                # Runs of hit words, cut where a text ends.
                hit = np.cumsum(covered)[:-1] > 0
                edge = np.ones(len(hit), bool)
                edge[1:] = (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(edge)
                for a, b in zip(at.tolist(), [*at[1:].tolist(), len(hit)]):
                    if hit[a]:
                        base = int(words.offsets[owner[a]])
                        spans[owner[a]].append({"a": a - base, "b": b - base})
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), part.column(1), pa.array(words.counts, pa.int64()),
                 pa.array(spans, _FOUND.field("spans").type),
                 pa.array([sorted(i) for i in items], _FOUND.field("items").type)], schema=_FOUND)


def _blocks(benchmark: DataFrame, window: int, gram: int, block_bytes: int) -> list:
    """Broadcast indexes of the benchmark, each of about ``block_bytes`` of text."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, out = max(1, math.ceil(size / block_bytes)), []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        out.append(benchmark.sparkSession.sparkContext.broadcast(Index([r[0] for r in block], [r[1] for r in block], window, gram)))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit words, end exclusive, in order), items (ids as
    text, sorted), n_hit, n_items.

    A null text, of either side, has no words; an item without words has no window; an item without id is
    counted under the empty id. Equal ids count once. Repeated documents give a row each. An empty
    benchmark finds nothing, empty documents give no rows; other columns are not read.
    """
    rows = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("_row"), "text")
    passes = [rows.mapInArrow(_Finder(shared), _FOUND_DDL) for shared in _blocks(benchmark, window, gram, block_bytes)]
    found, blocks = passes[0], len(passes)
    if blocks > 1:
        for more in passes[1:]:
            found = found.unionAll(more)
        # Equal rows find the same; each pass has one finding for every one of them.
        found = (found.groupBy("doc_id", "_row")
                 .agg(F.max("n_words").alias("n_words"),
                      F.flatten(F.collect_list("spans")).alias("spans"),
                      F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                      F.count(F.lit(1)).alias("_n"))
                 .withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_n") / blocks).cast("int")))))
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["to"]))).alias("n"),
                              F.greatest(s["to"], x["b"]).alias("to")),
        lambda s: s["n"])
    return found.select("doc_id", "n_words", F.array_sort("spans").alias("spans"), F.array_sort("items").alias("items"),
                        covered.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents``, with all their columns, that hold no window of any item. A row without text stays."""
    kept = documents
    for shared in _blocks(benchmark, window, gram, block_bytes):
        kept = kept.mapInArrow(_Keeper(shared, kept.columns.index("text")), kept.schema)
    return kept


class _Keeper:
    def __init__(self, shared, text: int):
        self.shared, self.text = shared, text

    def __call__(self, batches):
        for part in W.slices(batches, self.text):
            words = W.Words(part.column(self.text), W.LETTERS)
            clean = np.ones(part.num_rows, bool)
            if len(words.flat):
                for first, _, _ in self.shared.value.occurrences(words.hashes(), words.offsets):
                    clean[words.owner()[first]] = False
            yield part.filter(pa.array(clean))


class _Finder:
    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches):
        return self.shared.value.find(batches)


@query("op4_decontaminate")
def op4(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
