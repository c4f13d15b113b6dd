"""Toxicity by subword bags.

A word is the mean of the vectors of its character n-grams (3 to 5 characters with word ends marked, hashed to a table)
and of the word itself; a text is the mean of its words, and a linear softmax tells toxic from clean. Vectors and softmax
are trained jointly, in numpy, on a bounded sample of labelled rows. A misspelt or unseen word shares most n-grams with
a known one and so its vector.

A mean over a long text hides a few words. Texts are therefore scored in stretches of STRETCH words, and the highest score
counts; training picks, for a toxic text, the stretch that the model so far finds most toxic. The highest of many clean
stretches is higher than that of a few, so the calibration takes a multiple of the logarithm of their number off again;
it is learnt from the sample's texts and from several of them taken together as one.

The trained model reduces to one number per n-gram and one for the length; it is broadcast (2 ** BUCKET_BITS numbers), and scoring is one pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

# The sample: labelled rows per class, chosen by a hash of id and text, and bytes per row on average. Texts are whole unless
# the sample as a whole is larger; then the longest ones are represented by some of their stretches, over their whole length.
SAMPLE_PER_CLASS = 2_000
TRAIN_BYTES = 16_384
FOLDS = 5
STRETCH = 16
BUCKET_BITS = 17
NGRAMS = (3, 4, 5)
# Words whose n-grams are hashed at once.
WORDS_AT_ONCE = 4_000
DIMS = 4
# n-grams seen fewer times in the sample, or about as often in both classes, carry no vector; SMOOTH is added to their
# counts in the starting log-odds.
LEAST_SEEN = 5
LEAST_ODDS = 0.2
SMOOTH = 5.0
# Texts taken together as one long text in the calibration, and how many such texts of each class.
TOGETHER = (4, 16, 64)
JOINED = 400
STEPS = 60
RATE = 0.2


def word_grams(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of the words, with the whole word as one more."""
    owns, buckets = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(vocabulary), WORDS_AT_ONCE):
        own, bucket = _grams_of(vocabulary.slice(at, WORDS_AT_ONCE))
        owns.append((own + at).astype(np.int32))
        buckets.append(bucket.astype(np.int32))
    return np.concatenate(owns), np.concatenate(buckets)


def _grams_of(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = vocabulary.to_pylist()
    points = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), np.uint32).astype(np.uint64)
    offsets = np.concatenate(([0], np.cumsum(pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) + 2)))
    room, owner, mixed = W.room(offsets), np.repeat(np.arange(len(words)), np.diff(offsets)), W.mix(points + W.ROLL[0])
    own, hashed = [np.arange(len(words))], [np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)]
    for n in NGRAMS:
        grams = W.gram_hashes(mixed, n)
        at = np.flatnonzero(room[:len(grams)] >= n)
        own.append(owner[at])
        hashed.append(grams[at] ^ np.uint64(n))
    return np.concatenate(own), (W.mix(np.concatenate(hashed)) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


def _stretches(offsets: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch of each word, text of each stretch); a short rest joins the stretch before it."""
    counts = np.diff(offsets)
    parts = np.maximum(1, (counts + stretch // 2) // stretch)
    first = np.cumsum(parts) - parts
    place = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], counts)
    return np.repeat(first, counts) + np.minimum(place // stretch, np.repeat(parts, counts) - 1), np.repeat(np.arange(len(counts)), parts)


class Model:
    """One number per n-gram bucket, a bias, and what a text loses per logarithm of its number of stretches, in log-odds."""

    def __init__(self, grams: np.ndarray, bias: float, length: float = 0.0):
        self.grams, self.bias, self.length = grams, bias, length

    def scores(self, column: pa.Array) -> np.ndarray:
        words = W.Words(column, W.LETTERS)
        out = np.full(len(column), self.bias)
        if len(words.flat):
            coded = words.flat.dictionary_encode()
            own, bucket = word_grams(coded.dictionary)
            n = len(coded.dictionary)
            each = np.bincount(own, self.grams[bucket], n) / np.bincount(own, minlength=n)
            part, text = _stretches(words.offsets, STRETCH)
            total = np.bincount(part, each[coded.indices.to_numpy(zero_copy_only=False)], len(text))
            mean = total / np.maximum(1, np.bincount(part, minlength=len(text)))
            best = np.full(len(column), -np.inf)
            np.maximum.at(best, text, mean)
            out += best + self.length * np.log(np.bincount(text, minlength=len(column)))
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def _counted(at: np.ndarray, n: int, weights: np.ndarray | None = None, by: np.ndarray | None = None, step: int = 1 << 19) -> np.ndarray:
    """Number of each of 0..n-1 in ``at``, or sum of ``weights[by]`` there, some at a time to hold little."""
    out = np.zeros(n)
    for low in range(0, len(at), step):
        some = slice(low, low + step)
        out += np.bincount(at[some], None if weights is None else weights[by[some]], n)
    return out


class _Groups:
    """Sums of rows by a fixed group number, by sorting once."""

    def __init__(self, groups: np.ndarray, n: int):
        self.order = np.argsort(groups, kind="stable").astype(np.int32)
        at = groups[self.order]
        self.starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
        self.present, self.n = at[self.starts], n

    def __call__(self, table: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Sums of ``table[by]``, whose rows are never held all at once."""
        out = np.zeros((self.n, table.shape[1]), np.float32)
        if len(self.starts):
            at = by[self.order]
            for d in range(table.shape[1]):
                out[self.present, d] = np.add.reduceat(table[:, d][at], self.starts)
        return out


def fit(texts: pa.Array | list[str], labels: np.ndarray, toxic_share: float | None = None, seed: int = 7) -> Model:
    """Joint training of n-gram vectors and softmax on whole batches; without both labels, only their share is learnt.

    Vectors start from each n-gram's smoothed log-odds of being in a toxic text, so the first choice of stretches is
    sensible, and are then moved by Adam together with the softmax. At the end the scores of whole texts are calibrated to
    ``toxic_share``, the share of toxic texts among all, as the sample holds about as many of each class.
    """
    labels = np.asarray(labels, np.int64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    buckets = 1 << BUCKET_BITS
    words = W.Words(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, W.LETTERS)
    del texts
    if len(set(labels.tolist())) < 2 or not len(words.flat):
        return Model(np.zeros(buckets), float(np.log(share / (1 - share))))
    coded = words.flat.dictionary_encode()
    code, n_words = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    vocabulary, offsets = coded.dictionary, words.offsets
    del words, coded
    pa.default_memory_pool().release_unused()
    part, text = _stretches(offsets, STRETCH)
    part = part.astype(np.int32)
    own, bucket = word_grams(vocabulary)
    per_word = _counted(own, n_words)[:, None].astype(np.float32)
    # In how many texts of each class a bucket is seen (a text counts once for each of its words with it).
    word_in = np.unique(np.repeat(np.arange(len(labels)) * n_words, np.diff(offsets)) + code)
    del vocabulary, offsets
    seen = [_counted(bucket, buckets, np.bincount((word_in % n_words)[labels[word_in // n_words] == c], minlength=n_words), own) for c in (0, 1)]
    del word_in
    pa.default_memory_pool().release_unused()
    texts_of = np.bincount(labels, minlength=2)
    odds = np.log((seen[1] + SMOOTH) / (texts_of[1] + SMOOTH)) - np.log((seen[0] + SMOOTH) / (texts_of[0] + SMOOTH))
    good = (seen[0] + seen[1] >= LEAST_SEEN) & (np.abs(odds) >= LEAST_ODDS)
    kept = good[bucket]
    own, bucket = own[kept], bucket[kept]
    used = np.flatnonzero(_counted(bucket, buckets) > 0)
    column = np.searchsorted(used, np.arange(buckets)).astype(np.int32)[bucket]
    odds = odds[used]
    rng = np.random.default_rng(seed)
    del kept, bucket
    params = [rng.normal(0, 0.1, (len(used), DIMS)).astype(np.float32), rng.normal(0, 0.1, (DIMS, 2)), np.array([1.0, -1.0])]
    params[0][:, 0] += odds
    params[1][0] += [-STRETCH / 4, STRETCH / 4]
    size = np.maximum(1, np.bincount(part, minlength=len(text)))[:, None].astype(np.float32)
    by_word, by_part = _Groups(own, n_words), _Groups(part, len(text))
    by_column, by_code = _Groups(column, len(used)), _Groups(code, n_words)

    def forward():
        vectors = by_word(params[0], column) / per_word
        means = by_part(vectors, code) / size
        return means, means @ params[1] + params[2]

    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    y, rates = labels[text], (RATE, STRETCH * RATE / 4, RATE)
    for step in range(1, STEPS + 1):
        means, logits = forward()
        # Of a toxic text, its most toxic stretch counts; of a clean one, all of them, the most toxic most.
        odds_of = logits[:, 1] - logits[:, 0]
        best = np.full(len(labels), -np.inf)
        np.maximum.at(best, text, odds_of)
        first = odds_of >= best[text]
        weight = np.where(first, 1.0, np.where(y == 0, 0.2, 0.0))
        for c in (0, 1):        # both classes weigh the same
            weight[y == c] /= max(1.0, weight[y == c].sum())
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        d_logit = p * weight[:, None]
        d_mean = (d_logit @ params[1].T / size).astype(np.float32)
        d_vector = by_code(d_mean, part) / per_word
        grads = [by_column(d_vector, own), means.T @ d_logit, d_logit.sum(0)]
        for p_, g, (m, v), rate in zip(params, grads, moments, rates):
            m += 0.1 * (g - m)
            # One scale for a whole table: frequent n-grams move further than rare ones.
            v += 0.05 * ((g * g).max() - v)
            p_ -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.95 ** step)) + 1e-12)
    best = np.full(len(labels), -np.inf)
    np.maximum.at(best, text, forward()[1] @ np.array([-1.0, 1.0]))
    said = np.isfinite(best)
    slope, length, shift = _calibrate(best[said], np.bincount(text, minlength=len(labels))[said], labels[said],
                                      share if toxic_share is None else toxic_share, rng)
    grams = np.zeros(buckets)
    grams[used] = params[0] @ params[1] @ np.array([-slope, slope])
    return Model(grams, float(slope * (params[2][1] - params[2][0]) + shift), length)


def _calibrate(odds: np.ndarray, stretches: np.ndarray, labels: np.ndarray, toxic_share: float, rng) -> tuple[float, float, float]:
    """Slope, length and shift that make the odds of whole texts probabilities, where ``toxic_share`` of all texts are toxic.

    Long texts are rare. For each of TOGETHER, as many clean texts, and a toxic one with clean ones, are therefore taken as
    one text: its odds are the highest of theirs, and its stretches are all of theirs.
    """
    rows = [(odds, stretches, labels, 1.0)]
    clean, toxic = (np.flatnonzero(labels == c) for c in (0, 1))
    for n in TOGETHER:
        if len(clean) >= n and len(toxic):
            for label in (0, 1):
                groups = np.stack([rng.permutation(clean)[:n] for _ in range(JOINED)])
                if label:
                    groups[:, 0] = rng.choice(toxic, JOINED)
                rows.append((odds[groups].max(1), stretches[groups].sum(1), np.full(JOINED, label), 1 / len(TOGETHER)))
    weight = np.concatenate([w * np.where(y == 1, toxic_share / max(1, (y == 1).sum()), (1 - toxic_share) / max(1, (y == 0).sum())) for _, _, y, w in rows])
    labels = np.concatenate([y for _, _, y, _ in rows])
    x = np.stack([np.concatenate([o for o, _, _, _ in rows]), -np.log(np.concatenate([n for _, n, _, _ in rows])), np.ones(len(labels))], 1)
    at = np.array([1.0, 0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        # A little weight keeps the slope bounded where the classes are apart.
        gradient = x.T @ (weight * (p - labels)) + 1e-4 * (at - [1.0, 0.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
        at = at - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(at[0], 1e-3)), -float(max(at[1], 0.0)), float(at[2])


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def largest_share(sizes: list[int], budget: int) -> int | None:
    """Size to which the larger ones must be cut for all to fit in ``budget``; None if they fit as they are."""
    if sum(sizes) <= budget:
        return None
    left, sizes = budget, sorted(sizes)
    for i, size in enumerate(sizes):
        if size * (len(sizes) - i) > left:
            return max(1, left // (len(sizes) - i))
        left -= size
    return None


class _Parts:
    """Texts over ``most`` bytes as some of their stretches, evenly over their length."""

    def __init__(self, most: int):
        self.most = most

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, 0):
            texts = [self._parts(t) if len(t.as_py().encode()) > self.most else t.as_py() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], names=batch.schema.names)

    def _parts(self, text: pa.Scalar) -> str:
        words = W.Words(pa.array([text.as_py()], pa.string()), W.LETTERS)
        part, all_parts = _stretches(words.offsets, STRETCH)
        n = len(all_parts)
        take = max(1, n * self.most // len(text.as_py().encode()))
        return " ".join(words.flat.filter(pa.array(np.isin(part, np.arange(take) * n // take))).to_pylist())


def training_sample(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
                    row_bytes: int = TRAIN_BYTES) -> tuple[pa.Array, np.ndarray, float | None]:
    """Texts and labels of at most ``per_class`` rows of each class, outside the held-out fold, and the share of toxic ones.

    The sample has at most 2 * per_class * row_bytes. Only if it would be larger, its longest texts are represented by
    stretches.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(~held_out(F.col("doc_id"))))
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_h")).where(F.octet_length("text") >= 1)
    # Ids, hashes and sizes are joined with the labels; texts are fetched for the chosen rows only, at most 2 * per_class of them.
    known_rows = rows.select("doc_id", "_h", F.octet_length("text").alias("_n")).join(known, "doc_id")
    chosen = [r for label in (0, 1) for r in known_rows.where(F.col("toxic") == label).orderBy("_h", "doc_id").limit(per_class).collect()]
    some = documents.sparkSession.createDataFrame(chosen, known_rows.schema).drop("_n").dropDuplicates(["doc_id", "_h"])
    sample = rows.join(F.broadcast(some), ["doc_id", "_h"]).select("text", "toxic", "_h", "doc_id")
    most = largest_share([r["_n"] for r in chosen], 2 * per_class * row_bytes)
    if most is not None:
        sample = sample.mapInArrow(_Parts(most), sample.schema)
    sample = sample.orderBy("toxic", "_h", "doc_id").select("text", "toxic").toArrow()
    texts, found = sample["text"].combine_chunks(), sample["toxic"].to_pylist()
    share = known.agg(F.avg("toxic")).first()[0]
    return texts, np.array(found, np.int64), share


class _Score:
    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 0):
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(self.shared.value.scores(part.column(0)))],
                                             names=[*part.schema.names[1:], "score"])


def score_toxicity(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1, higher: more likely toxic) of each document row.

    Only the text is scored. Null, empty and wordless texts get the model's bias. Repeated rows give a row each; no
    documents, no rows.
    """
    kinds = dict(documents.dtypes)
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    rows = documents.select(F.col("text").alias("_scored"), *keep)
    return rows.mapInArrow(_Score(documents.sparkSession.sparkContext.broadcast(model)), f"{ddl}, score double")


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    return fit(*training_sample(documents, labels))


def fold_of(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


@query("op6_toxicity")
def op6(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = score_toxicity(documents, learn(documents, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
