"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Every passage is encoded: numbers about its words (their length and case,
how often they repeat, in the passage and in the text) and a hashed bag of character classes, three in a row, go through
one layer of tanh units. Gated attention gives each passage a weight, softmax(w (tanh(V h) * sigmoid(U h))) over the
passages of the text; the weighted sum of the encodings is scored by one linear layer. Labels are known for whole texts
only; encoder, attention and score are trained together on them, in numpy, so which passages tell is learnt as well.

The training sample is bounded: SAMPLE_PER_CLASS labelled rows of each class, and of each row at most TRAIN_PASSAGES passages,
evenly over its length. Executors encode it; only numbers reach the driver. The model is a few thousand numbers. Scoring is
one pass without a shuffle, over all passages of whole texts; bytes are counted a bounded number at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

PASSAGE = 32
# The training sample: labelled rows of each class, chosen by a hash of id and text, and passages of each row.
SAMPLE_PER_CLASS = 2_000
TRAIN_PASSAGES = 64
FOLDS, HELD_OUT = 3, 1
BAG = 128
UNITS = 16
GATES = 8
STEPS = 150
RATE = 0.02
DECAY = 1e-4
# Words whose bytes are counted at once.
WORDS_AT_ONCE = 50_000

# Classes of bytes: lower case, upper case, digit, beyond ASCII; then each sign of ASCII by itself.
_LOWER, _UPPER, _DIGIT, _WIDE, _SIGNS = 0, 1, 2, 3, 4
CLASSES = np.full(256, _WIDE, np.int64)
CLASSES[:128] = _SIGNS + np.arange(128)
CLASSES[ord("a"):ord("z") + 1], CLASSES[ord("A"):ord("Z") + 1], CLASSES[ord("0"):ord("9") + 1] = _LOWER, _UPPER, _DIGIT
_KINDS = _SIGNS + 1         # classes with all signs as one
_MEASURES = 6
WIDTH = _KINDS + _MEASURES + BAG


def passages(offsets: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(passage of each word, text of each passage); a rest shorter than half a passage joins the one before."""
    counts = np.diff(offsets)
    parts = np.where(counts > 0, np.maximum(1, (counts + size // 2) // size), 0)
    first, place = np.cumsum(parts) - parts, np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], counts)
    return np.repeat(first, counts) + np.minimum(place // size, np.repeat(parts, counts) - 1), np.repeat(np.arange(len(counts)), parts)


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of each passage, text of each passage); wordless texts have no passage."""
    words = W.Words(column)
    part, text = passages(words.offsets)
    n, out = len(text), np.zeros((len(text), WIDTH), np.float32)
    if not n:
        return out, text
    size = np.bincount(part, minlength=n).astype(np.float32)
    measures = out[:, _KINDS:_KINDS + _MEASURES]
    _count_bytes(words.flat, part, out)
    # Repeats: of the word before, of words in the passage, of three words in a row in the whole text.
    hashes, owner = words.hashes(), words.owner()
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    measures[:, 0] = np.bincount(part, again, n) / size
    order = np.lexsort((hashes, part))
    near, known = part[order], hashes[order]
    new = np.concatenate(([True], (near[1:] != near[:-1]) | (known[1:] != known[:-1])))
    measures[:, 1] = np.bincount(near[new], minlength=n) / size
    threes = W.gram_hashes(hashes, 3)
    inside = np.flatnonzero(W.room(words.offsets)[:len(threes)] >= 3)
    _, kind, times = np.unique(W.mix(threes[inside] ^ W.mix(owner[inside].astype(np.uint64) + W.ROLL[0])), return_inverse=True, return_counts=True)
    measures[:, 2] = np.bincount(part[inside], times[kind] > 1, n) / size
    lengths = pc.utf8_length(words.flat).to_numpy(zero_copy_only=False)
    measures[:, 3] = np.bincount(part, lengths, n) / size / 8
    measures[:, 4] = np.bincount(part, lengths > 20, n) / size
    measures[:, 5] = np.log(size) / 4
    return out, text


def _count_bytes(flat: pa.Array, part: np.ndarray, out: np.ndarray) -> None:
    """Shares of the kinds of bytes, and of the hashed triples of byte classes, of each passage."""
    bag, ends = out[:, _KINDS + _MEASURES:], np.cumsum(np.bincount(part))
    first = low = 0
    while low < len(flat):          # whole passages at a time
        last = max(first + 1, int(np.searchsorted(ends, low + WORDS_AT_ONCE, "right")))
        some = flat.slice(low, int(ends[last - 1]) - low)
        starts = np.frombuffer(some.buffers()[1], np.int64)[some.offset:some.offset + len(some) + 1]
        classes = CLASSES[np.frombuffer(some.buffers()[2], np.uint8)[starts[0]:starts[-1]]]
        own, n = np.repeat(part[low:low + len(some)] - first, np.diff(starts)), last - first
        out[first:last, :_KINDS] = np.bincount(own * _KINDS + np.minimum(classes, _SIGNS), minlength=n * _KINDS).reshape(n, _KINDS)
        # Word beginnings are told apart, so that triples know where words end.
        classes[starts[:-1] - starts[0]] += 256
        slots = (W.mix(((classes[:-2] * 512 + classes[1:-1]) * 512 + classes[2:]).astype(np.uint64)) & np.uint64(BAG - 1)).astype(np.int64)
        inside = own[2:] == own[:-2]
        bag[first:last] = np.bincount((own[:-2] * BAG + slots)[inside], minlength=n * BAG).reshape(n, BAG)
        low, first = low + len(some), last
    out[:, :_KINDS] /= np.maximum(1, out[:, :_KINDS].sum(1, keepdims=True))
    bag /= np.maximum(1, bag.sum(1, keepdims=True))


class Bags:
    """Sums, maxima and softmax over the passages of each text; passages of a text are neighbours."""

    def __init__(self, text: np.ndarray, n: int):
        self.text, self.n = text, n
        self.first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else np.zeros(0, np.int64)
        self.present = text[self.first]

    def sum(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, *values.shape[1:]), values.dtype)
        if len(self.first):
            out[self.present] = np.add.reduceat(values, self.first, axis=0)
        return out

    def softmax(self, values: np.ndarray) -> np.ndarray:
        most = np.zeros(self.n, values.dtype)
        if len(self.first):
            most[self.present] = np.maximum.reduceat(values, self.first)
        shares = np.exp(values - most[self.text])
        return shares / self.sum(shares)[self.text]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Model:
    """``mean`` and ``scale`` of the numbers of a passage, and the parameters: encoder W b, gates V U w, score u c."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, params: list[np.ndarray]):
        self.mean, self.scale, self.params = mean, scale, params

    @classmethod
    def start(cls, numbers: np.ndarray, rng) -> Model:
        mean = numbers.mean(0) if len(numbers) else np.zeros(WIDTH)
        scale = 1 / (numbers.std(0) + 0.01) if len(numbers) else np.ones(WIDTH)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
        return cls(mean, scale, [draw(WIDTH, UNITS), np.zeros(UNITS), draw(UNITS, GATES), draw(UNITS, GATES), draw(GATES), draw(UNITS), np.zeros(1)])

    def scaled(self, numbers: np.ndarray) -> np.ndarray:
        return np.clip((numbers - self.mean) * self.scale, -8, 8).astype(np.float32)

    def forward(self, x: np.ndarray, bags: Bags) -> dict:
        w, b, v, u, gate, score, bias = self.params
        h = np.tanh(x @ w + b)
        left, right = np.tanh(h @ v), _sigmoid(h @ u)
        weights = bags.softmax((left * right) @ gate)
        z = bags.sum(h * weights[:, None])
        return {"h": h, "left": left, "right": right, "weights": weights, "z": z, "logit": z @ score + bias[0]}

    def gradients(self, x: np.ndarray, bags: Bags, made: dict, d_logit: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, gate, score, bias = self.params
        h, left, right, weights = made["h"], made["left"], made["right"], made["weights"]
        d_z = (d_logit[:, None] * score)[bags.text]
        d_weight = (d_z * h).sum(1)
        d_said = weights * (d_weight - bags.sum(weights * d_weight)[bags.text])
        d_gated = d_said[:, None] * gate
        d_left, d_right = d_gated * right * (1 - left ** 2), d_gated * left * right * (1 - right)
        d_h = (weights[:, None] * d_z + d_left @ v.T + d_right @ u.T) * (1 - h ** 2)
        return [x.T @ d_h, d_h.sum(0), h.T @ d_left, h.T @ d_right, (left * right).T @ d_said, made["z"].T @ d_logit, d_logit.sum(keepdims=True)]

    def scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of each text, attention of each passage, text of each passage)."""
        numbers, text = encode(column)
        made = self.forward(self.scaled(numbers), Bags(text, len(column)))
        return _sigmoid(made["logit"]), made["weights"], text


def fit(numbers: np.ndarray, text: np.ndarray, labels: np.ndarray, good_share: float | None = None, seed: int = 13) -> Model:
    """A model of the passages (``numbers``, ``text``) of texts with ``labels``, by Adam on the whole sample at once.

    Both classes weigh the same while training; at the end the score is moved to ``good_share``, the share of label 1 among
    all. Without both labels only their share is learnt.
    """
    rng, labels = np.random.default_rng(seed), np.asarray(labels, np.float64)
    model = Model.start(numbers, rng)
    share = (labels.sum() + 0.5) / (len(labels) + 1) if good_share is None else min(max(good_share, 1e-4), 1 - 1e-4)
    if len(set(labels.tolist())) < 2 or not len(numbers):
        model.params[5][:] = 0
        model.params[6][:] = np.log(share / (1 - share))
        return model
    x, bags = model.scaled(numbers), Bags(text, len(labels))
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in model.params]
    for step in range(1, STEPS + 1):
        made = model.forward(x, bags)
        found = model.gradients(x, bags, made, weight * (_sigmoid(made["logit"]) - labels))
        for p, g, (m, v) in zip(model.params, found, moments):
            g = g + DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    model.params[6] += np.log(share / (1 - share))
    return model


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT


class _Encode:
    """Numbers of at most TRAIN_PASSAGES passages of each row, instead of its text, the first column."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 0):
            numbers, text = encode(part.column(0))
            bounds, rows = np.searchsorted(text, np.arange(part.num_rows + 1)).tolist(), []
            for s, e in pairwise(bounds):
                n = min(e - s, TRAIN_PASSAGES)
                rows.append(numbers[s + np.arange(n) * (e - s) // max(1, n)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), *part.columns[1:]], names=["numbers", *part.schema.names[1:]])


def training_sample(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float | None]:
    """Passages, their texts, and labels of at most ``per_class`` rows of each class outside the held-out fold; share of label 1."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
             .where(~held_out(F.col("doc_id"))))
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_h"))
    ids = rows.select("doc_id", "_h").join(known, "doc_id").dropDuplicates(["doc_id", "_h"])
    chosen = [r for label in (0, 1) for r in ids.where(F.col("quality") == label).orderBy("_h", "doc_id").limit(per_class).collect()]
    some = F.broadcast(documents.sparkSession.createDataFrame(chosen, ids.schema))      # at most 2 * per_class rows
    sample = rows.join(some, ["doc_id", "_h"]).dropDuplicates(["doc_id", "_h"])
    found = (sample.select("text", "quality", "_h", F.col("doc_id").cast("bigint").alias("doc_id"))
             .mapInArrow(_Encode(), "numbers binary, quality int, _h bigint, doc_id bigint").orderBy("_h", "doc_id").toArrow())
    each = [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for x in found["numbers"].to_pylist()]
    numbers = np.concatenate([np.zeros((0, WIDTH), np.float32), *each])
    return numbers, np.repeat(np.arange(len(each)), [len(x) for x in each]), np.array(found["quality"].to_pylist(), np.int64), known.agg(F.avg("quality")).first()[0]


class _Score:
    def __init__(self, shared, attention: bool):
        self.shared, self.attention = shared, attention

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 0):
            scores, weights, text = self.shared.value.scores(part.column(0))
            more, names = [pa.array(scores)], [*part.schema.names[1:], "score"]
            if self.attention:
                cuts = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                more.append(pa.ListArray.from_arrays(cuts, pa.array(weights.astype(np.float64))))
                names.append("attention")
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *more], names=names)


def score_quality(documents: DataFrame, model: Model, keep: list[str], attention: bool = False) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1, higher: label 1 likelier) of each document row; with ``attention`` also the
    weights of its passages, in order.

    Only the text is read. Null, empty and wordless texts have no passage and get the score of an encoding of zeros.
    Repeated rows give a row each, ids may be null; no documents, no rows.
    """
    kinds = dict(documents.dtypes)
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double" + ", attention array<double>" * attention
    rows = documents.select(F.col("text").alias("_scored"), *keep)
    return rows.mapInArrow(_Score(documents.sparkSession.sparkContext.broadcast(model), attention), ddl)


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    return fit(*training_sample(documents, labels))


@query("op13_quality")
def op13(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = score_quality(documents, learn(documents, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
