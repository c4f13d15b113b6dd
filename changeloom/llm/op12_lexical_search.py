"""Ranked lexical search by the Best Position Algorithm.

One pass over the documents turns each into its length and its counts of the terms that queries hold, which is stored;
numbers of documents and of words come from there. The stored rows are then searched shard by shard, a shard being a
bounded number of neighbouring rows of a task. In a shard every term has an *impact list*: its documents by falling share
of the score. For a query, its lists are read in parallel from the top. A document met for the first time is scored at
once by direct accesses to all lists, and its place in each of them is marked as seen. The *best position* of a list is
the end of its unbroken run of seen places, however they were reached; a document not met yet lies beyond it in every
list, so the impacts found there sum to a bound that falls faster than that of the last places read. A shard is done
when the bound is strictly below the k-th score (equal scores are settled by document id, so a tie is read on), or when
the lists end. The k best of a task go from shard to shard, so later shards start with a high k-th score; only they are
shuffled, k rows for each query and task.

The queries are taken in blocks of a bounded number of bytes, each broadcast. More blocks mean more passes over the
documents, so neither side has a size limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .stored import stored

K = 10
# Bytes of query text in one broadcast block.
BLOCK_BYTES = 8 << 20
# A shard ends at so many documents or postings.
SHARD_ROWS = 1 << 15
SHARD_POSTINGS = 1 << 21
# Places read in every list in the first round; each later round reads twice as many.
STEP = 16

_POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
_POSTINGS_DDL = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
_BEST = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_BEST_DDL = "item bigint, item_id bigint, doc_id bigint, score bigint"


class Queries:
    """Terms of a block of items: ``terms[offsets[i]:offsets[i + 1]]`` are the distinct terms of item i, as places in
    ``vocabulary``, and ``repeats`` how often the item holds them."""

    def __init__(self, ids: list, texts: list):
        words = W.Words(pa.array(texts, pa.string()), W.LETTERS)
        coded = words.flat.dictionary_encode()
        self.ids, self.vocabulary = ids, coded.dictionary
        n = max(1, len(self.vocabulary))
        keys, self.repeats = np.unique(words.owner() * n + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
        self.terms = keys % n
        self.offsets = np.searchsorted(keys // n, np.arange(len(ids) + 1))

    def postings(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, number of terms, and query terms with their counts, of each row of (doc_id, text)."""
        for part in W.slices(batches, 1):
            words = W.Words(part.column(1), W.LETTERS)
            code = pc.index_in(words.flat, value_set=self.vocabulary)
            known = code.is_valid().to_numpy(zero_copy_only=False)
            n = max(1, len(self.vocabulary))
            keys, tfs = np.unique(words.owner()[known] * n + code.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
            cuts = pa.array(np.searchsorted(keys // n, np.arange(part.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words.counts), pa.ListArray.from_arrays(cuts, pa.array((keys % n).astype(np.int32))),
                 pa.ListArray.from_arrays(cuts, pa.array(tfs.astype(np.int64)))], schema=_POSTINGS)


class Shard:
    """Impact lists over some documents, with direct access by document.

    Postings are in document order; ``place`` is where each stands in the lists, which lie one behind the other by term.
    """

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, n_docs: int, n_words: int):
        self.doc_ids, self.offsets, self.terms = doc_ids, offsets, terms
        own = np.repeat(np.arange(len(lengths)), np.diff(offsets))
        if lengths.size and 75 * int(lengths.max()) * n_docs > np.iinfo(np.int64).max:
            share = np.array([75 * int(x) * n_docs // n_words for x in lengths], np.int64)
        else:
            share = 75 * lengths * n_docs // max(1, n_words)
        self.impacts = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * (25 + share[own])))
        order = np.lexsort((-self.impacts, terms))
        self.listed, self.falling = own[order], self.impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.met = np.zeros(len(lengths), bool)
        self.seen = np.zeros(len(order) + 1, bool)          # one more, so that every list ends before an unseen place
        self.repeats = np.zeros(len(weights), np.int64)
        self.read = 0                                       # documents scored, over all queries

    def best(self, terms: np.ndarray, repeats: np.ndarray, top: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
        """The best k (scores, ids, known) of ``top`` and this shard."""
        at, ends = self.starts[terms].copy(), self.starts[terms + 1]
        some = at < ends
        at, ends, times = at[some], ends[some], repeats[some]
        self.repeats[terms] = repeats
        step, marks, docs = STEP, [], []
        while True:
            live = at < ends
            if not live.any() or (len(top[0]) >= k and top[0][k - 1] > int((self.falling[at[live]] * times[live]).sum())):
                break
            size = np.minimum(step, ends - at)
            new = np.unique(self.listed[_ranges(at, size)])
            new = new[~self.met[new]]
            step *= 2
            self.met[new] = True
            docs.append(new)
            # Direct accesses: all postings of these documents.
            count = self.offsets[new + 1] - self.offsets[new]
            access = _ranges(self.offsets[new], count)
            share = self.impacts[access] * self.repeats[self.terms[access]]
            total = np.concatenate(([0], np.cumsum(share)))
            ends_at = np.cumsum(count)
            top = _first((total[ends_at] - total[ends_at - count], *self.doc_ids[:, new]), top, k)
            marked = self.place[access[self.repeats[self.terms[access]] > 0]]
            self.seen[marked] = True
            marks.append(marked)
            at = np.array([_unseen(self.seen, a, e) for a, e in zip(at.tolist(), ends.tolist())], np.int64)
        for x in marks:
            self.seen[x] = False
        for x in docs:
            self.met[x] = False
            self.read += len(x)
        self.repeats[terms] = 0
        return top


def _unseen(seen: np.ndarray, at: int, end: int) -> int:
    """First unseen place of a list from its best position on."""
    while at < end:
        part = seen[at:min(end, at + 4096)]
        step = int(part.argmin())
        if not part[step]:
            return at + step
        at += len(part)
    return end


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _first(found: tuple, top: tuple, k: int) -> tuple:
    """The k best of both by falling score, then id, rows without id last; scores of 0 do not count."""
    least = top[0][k - 1] if len(top[0]) >= k else 1
    good = found[0] >= max(1, least)
    if not good.any():
        return top
    scores, ids, known = (np.concatenate((t, f[good])) for t, f in zip(top, found))
    order = np.lexsort((ids, known == 0, -scores))[:k]
    return scores[order], ids[order], known[order]


class _Search:
    def __init__(self, shared, weights, n_docs: int, n_words: int, k: int, shard_rows: int):
        self.shared, self.weights, self.n_docs, self.n_words, self.k, self.shard_rows = shared, weights, n_docs, n_words, k, shard_rows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, none = self.shared.value, np.zeros(0, np.int64)
        tops = [(none, none, none)] * len(queries.ids)
        for rows in self._gathered(batches):
            shard = self._shard(rows)
            for i, top in enumerate(tops):
                own = slice(queries.offsets[i], queries.offsets[i + 1])
                tops[i] = shard.best(queries.terms[own], queries.repeats[own], top, self.k)
        size = [len(t[0]) for t in tops]
        item = np.repeat(np.arange(len(tops)), size)
        scores, ids, known = (np.concatenate([none, *(t[j] for t in tops)]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array([queries.ids[i] for i in item.tolist()], pa.int64()),
             pa.array(ids, pa.int64(), mask=known == 0), pa.array(scores, pa.int64())], schema=_BEST)

    def _gathered(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows, postings = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            postings += pc.sum(pc.list_value_length(batch.column(2))).as_py() or 0
            if rows >= self.shard_rows or postings >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, postings = [], 0, 0
        if held:
            yield pa.Table.from_batches(held)

    def _shard(self, rows: pa.Table) -> Shard:
        doc_id, n, terms, tfs = (c.combine_chunks() for c in rows.columns)
        known = doc_id.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))))
        return Shard(np.stack((pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False), known)), n.to_numpy(zero_copy_only=False), offsets,
                     terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64), tfs.flatten().to_numpy(zero_copy_only=False),
                     self.weights, self.n_docs, self.n_words)


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def search(documents: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of each item row.

    Scores are whole numbers; equal ones are ranked by doc_id, rows without id last. Documents and items that are null,
    empty or without a term match nothing. Repeated documents are documents of their own; repeated item rows give their
    ranks each. Empty tables give no rows; other columns are not read.
    """
    spark, found = documents.sparkSession, None
    texts = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        block = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(Queries([r[0] for r in block], [r[1] for r in block]))
        postings = stored(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
                          .mapInArrow(_Call(shared), _POSTINGS_DDL).where("n > 0"), "postings")
        n_docs, n_words = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        # At most one row for each term of the block.
        df = postings.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        holding = np.zeros(len(shared.value.vocabulary), np.int64)
        holding[df["term"].to_numpy()] = df["count"].to_numpy()
        best = stored(postings.mapInArrow(_Search(shared, term_weights(n_docs, holding), n_docs, n_words or 0, k, shard_rows), _BEST_DDL), "best")
        shared.destroy()
        best = best.withColumn("block", F.lit(b))
        found = best if found is None else found.unionAll(best)
    rank = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


class _Call:
    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches):
        return self.shared.value.postings(batches)


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = f"regexp_extract_all(translate({{}}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"
SQL = f"""
WITH words AS (SELECT doc_id, unnest({_WORDS.format('text')}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, totals GROUP BY term, nn),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_WORDS.format('text')}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nn) // ll)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10"""


@query("op12_lexical_search", SQL)
def op12(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
