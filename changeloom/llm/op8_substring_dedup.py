"""Substring dedup by super-k-mer partitioning.

A window is 50 consecutive words of a document; its minimiser is the smallest hash of its 8-grams. Consecutive
windows with the same minimiser form a super-k-mer, which travels as one packed string of words to the bucket
of its minimiser. Equal windows have equal minimisers, so they meet in one bucket; sorting a bucket's windows by
hash and document finds the first document of each.

1. Super-k-mers per minimiser are counted (reduced map-side). Windows of a minimiser that one super-k-mer has
   cannot repeat. Minimisers with more are noted in a bitmap of fixed size; a stray bit only sends more.
2. Super-k-mers of noted minimisers travel to their buckets, of which there are as many as their number asks for.
   A minimiser with more than HOT super-k-mers (a passage that very many documents share) is dealt to several
   buckets by document. Each of them settles its own repeats; only the first occurrence of each window in a bucket
   goes on to be compared with those of the other buckets.
3. Repeated stretches come back to their documents by a join, and the words they cover are taken out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .stored import Bitmap, stored

WINDOW = 50
GRAM = 8
# Super-k-mers in a bucket, on average, and the most of one minimiser that go to a bucket.
BUCKET = 6_000
HOT = 2_000
NULL_ID = 2 ** 63 - 1

_COUNTS = pa.schema([("minimiser", pa.int64()), ("n", pa.int64())])
_PACKED = pa.schema([("bucket", pa.int64()), ("hot", pa.bool_()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("packed", pa.binary())])
# Words a to b of a row: repeated ones, or (with h1, h2) the first window of its kind in a part of a hot minimiser.
_FOUND = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def super_kmers(hashes: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """(first window, number of windows, minimiser) of each run of windows with one minimiser in one text."""
    grams = W.gram_hashes(hashes, gram)
    width = window - gram + 1
    if len(grams) < width:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    smallest = W.sliding_min(grams, width)
    valid = W.room(offsets)[:len(smallest)] >= window
    first = valid.copy()
    first[1:] &= ~(valid[:-1] & (smallest[1:] == smallest[:-1]))
    # Two texts never touch: the last window - 1 words of a text start no window (window > 1).
    start = np.flatnonzero(first)
    behind = valid.copy()
    behind[:-1] &= ~(valid[1:] & (smallest[1:] == smallest[:-1]))
    return start, np.flatnonzero(behind) - start + 1, smallest[start]


class _Count:
    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2):
            words = W.Words(part.column(2))
            if len(words.flat):
                _, _, minimisers = super_kmers(words.hashes(), words.offsets, self.window, self.gram)
                values, n = np.unique(minimisers, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(values)), pa.array(n.astype(np.int64))], schema=_COUNTS)


class _Pack:
    """Super-k-mers of repeated minimisers as packed strings, with their buckets."""

    def __init__(self, window: int, gram: int, repeated: Bitmap, hot, buckets: int, hot_from: int):
        self.window, self.gram, self.repeated, self.hot, self.buckets, self.hot_from = window, gram, repeated, hot, buckets, hot_from

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, counts = self.hot.value
        for part in W.slices(batches, 2):
            words = W.Words(part.column(2))
            if not len(words.flat):
                continue
            start, n, minimiser = super_kmers(words.hashes(), words.offsets, self.window, self.gram)
            some = np.flatnonzero(self.repeated(minimiser))
            start, n, minimiser = start[some], n[some], minimiser[some]
            length = n + self.window - 1
            joined = pa.LargeListArray.from_arrays(pa.array(_bounds(length)), words.flat.take(pa.array(_stretch(start, length))))
            packed = pc.binary_join(joined, pa.scalar(" ", words.flat.type)).cast(pa.large_binary()).cast(pa.binary())
            own = words.owner()[start]
            docs, rows = (part.column(i).to_numpy(zero_copy_only=False)[own] for i in (0, 1))
            # Parts of a hot minimiser hold about hot_from super-k-mers each.
            at = np.searchsorted(hot, minimiser)
            is_hot = (hot[np.minimum(at, len(hot) - 1)] == minimiser) if len(hot) else np.zeros(len(at), bool)
            parts = np.ones(len(at), np.uint64)
            parts[is_hot] += (counts[at[is_hot]] // self.hot_from).astype(np.uint64)
            salt = W.mix(docs.view(np.uint64)) % parts
            bucket = W.mix(minimiser + salt * W.ROLL[1]) % np.uint64(self.buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(bucket)), pa.array(is_hot), pa.array(docs), pa.array(rows), pa.array(start - words.offsets[own]), packed], schema=_PACKED)


def _bounds(n: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(n))).astype(np.int64)


def _stretch(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... n of them, for each pair."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _bucket(window: int):
    """Sorts the windows of one bucket."""

    def sort_windows(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        docs, rows, starts, hot = (group[c].to_numpy() for c in ("doc", "row", "start", "hot"))
        words = W.Words(group["packed"].cast(pa.large_binary()).cast(pa.large_string()).combine_chunks())
        at = np.flatnonzero(W.room(words.offsets) >= window)
        own = words.owner()[at]
        g1, g2 = (W.gram_hashes(h, window, r)[at] for h, r in zip(words.hashes(wide=True), W.ROLL))
        doc = docs[own]
        order = np.lexsort((doc, g2, g1))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (g1[order][1:] != g1[order][:-1]) | (g2[order][1:] != g2[order][:-1])
        first = doc[order][np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        repeated = np.zeros(len(order), bool)
        repeated[order] = doc[order] > first
        # Runs of repeated windows of one super-k-mer.
        some = np.flatnonzero(repeated)
        new = np.ones(len(some), bool)
        new[1:] = (some[1:] != some[:-1] + 1) | (own[some[1:]] != own[some[:-1]])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(some)) - 1 if len(some) else head
        of = own[some[head]]
        a = starts[of] + at[some[head]] - words.offsets[of]
        # First windows in this part of a hot minimiser.
        open_ = np.flatnonzero(hot[own] & ~repeated)
        of2 = own[open_]
        a2 = starts[of2] + at[open_] - words.offsets[of2]
        none = pa.nulls(len(of), pa.int64())
        return pa.Table.from_arrays([
            pa.array(np.concatenate((docs[of], docs[of2]))), pa.array(np.concatenate((rows[of], rows[of2]))), pa.array(np.concatenate((a, a2))),
            pa.array(np.concatenate((a + some[tail] - some[head] + window, a2 + window))),
            pa.concat_arrays([none, pa.array(W.signed(g1[open_]))]), pa.concat_arrays([none, pa.array(W.signed(g2[open_]))])], schema=_FOUND)

    return sort_windows


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


class _Cut:
    def __init__(self, digest: bool):
        self.digest = digest

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 1):
            counts, removed, kept = [], [], []
            for text, stretches in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                # bytes.split() separates words at the six ASCII white space characters and nothing else.
                words = (text or "").encode().split()
                out, at = [], 0
                for s in sorted(stretches or [], key=lambda s: s["a"]):
                    out += words[at:s["a"]]
                    at = max(at, s["b"])
                out += words[at:]
                counts.append(len(words))
                removed.append(len(words) - len(out))
                joined = b" ".join(out)
                kept.append(hashlib.sha256(joined).hexdigest() if self.digest else joined.decode())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             schema=_DIGEST if self.digest else _KEPT)


def repeated_stretches(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET, hot_from: int = HOT) -> DataFrame:
    """(doc, row, a, b): words a to b of a document row that windows known from a smaller document cover."""
    spark = documents.sparkSession
    rows = _rows(documents)
    counted = rows.mapInArrow(_Count(window, gram), _ddl(_COUNTS)).groupBy("minimiser").agg(F.sum("n").alias("n")).where("n > 1")
    counted = stored(counted, "minimisers")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # At most 200,000 minimisers are dealt out; if more have so many super-k-mers, only larger ones are.
    hot_from = max(hot_from, total // 200_000)
    hot = counted.where(F.col("n") > hot_from).toArrow()
    order = np.argsort(hot["minimiser"].to_numpy().view(np.uint64))
    shared = spark.sparkContext.broadcast((hot["minimiser"].to_numpy().view(np.uint64)[order], hot["n"].to_numpy()[order]))
    buckets = max(1, math.ceil(total / bucket))
    packed = rows.mapInArrow(_Pack(window, gram, Bitmap(counted, "minimiser"), shared, buckets, hot_from), _ddl(_PACKED))
    found = stored(packed.groupBy("bucket").applyInArrow(_bucket(window), _ddl(_FOUND)), "repeats")
    open_ = found.where("h1 is not null")
    first = open_.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("h1", "h2", "first")
    later = open_.join(first, ["h1", "h2"]).where(F.col("doc") > F.col("first"))
    return found.where("h1 is null").select("doc", "row", "a", "b").unionAll(later.select("doc", "row", "a", "b"))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("doc"),
                            F.xxhash64("doc_id", "text").alias("row"), "text")


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, digest: bool = False,
                   bucket: int = BUCKET, hot_from: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the words left, joined by a space; its SHA-256 as ``kept_sha256``
    with ``digest``) of each document row.

    A word goes when a window of ``window`` words that covers it starts in a document with a smaller id as well.
    Rows with equal ids do not remove from each other; a missing id is larger than all others. A null or empty
    text has no words. Equal rows give equal results, one each. An empty table gives no rows; other columns are
    not read.
    """
    found = (repeated_stretches(documents, window, gram, bucket, hot_from).groupBy("doc", "row")
             .agg(F.collect_list(F.struct("a", "b")).alias("stretches")))
    joined = (_rows(documents).join(found, ["doc", "row"], "left")
              .select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "text", "stretches"))
    return joined.mapInArrow(_Cut(digest), _ddl(_DIGEST if digest else _KEPT))


_SQL = """WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 49), ' ')) AS h FROM s),
m AS (SELECT h, min(doc_id) AS d FROM h GROUP BY h),
r AS (SELECT DISTINCT h.doc_id, unnest(range(i, i + 50)) AS j FROM h JOIN m USING (h) WHERE h.doc_id > m.d),
g AS (SELECT doc_id, list(j) AS js, count(*) AS n FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
sha256(array_to_string(CASE WHEN n IS NULL THEN ws ELSE list_select(ws, list_filter(range(1, len(ws) + 1), lambda x: NOT list_contains(js, x))) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id"""


@query("op8_substring_dedup", _SQL)
def op8(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)
