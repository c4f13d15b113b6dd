"""N-gram Jaccard join, size-aware: fixed-size subsets for small sets, inverted lists for large ones.

A document's set are its distinct shingles of five words; two documents link when their sets' Jaccard similarity
is 3/4 or more. A set of n shingles and a set it links to share at least c = ceil(3n/4) shingles. Under one order
of all shingles, the first n - c + k shingles of both therefore have k in common; here k is 2:

* *large* sets (more than the boundary) put each of their first n - c + 2 shingles into that shingle's inverted list, and
  scanning the lists counts how often two sets meet: twice at least, or they do not link;
* *small* sets enumerate all subsets of two of their first n - c + 2 shingles and meet where a subset is equal.
  Sets up to 4/3 of the boundary enumerate too, so that a small and a large set meet. (Two is the subset size;
  sets of one shingle link with equal sets only.)

The boundary is where enumerating stops being cheaper than scanning, by the list lengths that the corpus has. The
order is by hash, with frequent shingles last, so passages that many documents share seldom reach a list. Which
shingles count as frequent is kept in a bitmap of fixed size: any content of it is a valid order. Shingles are counted
where they would be in front by hash alone, and then in whole sets that frequent ones are in front of.

Equal sets are one set from the start. Sets that meet are compared without listing all pairs of a group: first each
with the smallest set of its list; then, where a list still holds sets of different components, with a few others of its
sets, the same few in all lists that hold them, so that loosely linked groups grow together; in turns, as long as a turn
takes a good part off the pairs across components; and then the pairs across components that are left, first a few of each
set, in turns likewise. Three exact bounds discard pairs: sizes, places in the order, and parity sketches. What is left is compared shingle by shingle on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .stored import Bitmap, arrow_rows, components, stored

SHINGLE = 5
# The similarity asked for is SHARE[0] / SHARE[1].
SHARE = (3, 4)
# Sets a shingle is frequent from: it comes late in the order, and its list is dealt to many tasks.
FREQUENT = 64
SALTS = 64
# List entries in a bucket, on average.
BUCKET = 400_000
# Texts in an Arrow batch, and bytes of text that a task works on at once.
ARROW_ROWS = 1_000
SLICE_BYTES = 1 << 20
# Entries that a task makes at once.
ENTRIES = 1 << 17
# Comparisons with one set that one task makes.
MEMBERS = 2_000
# Turns of comparing each open list, or each set, with a few sets. A turn must leave at most this part of the pairs that the
# one before it left, or the rest is compared at once, as where few are left.
TURNS = 8
LEFT = 0.75
OTHERS = 8
BOUNDARIES = (0, 8, 16, 32, 64, 128)

_SETS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("set_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()),
                    ("prefix", pa.list_(pa.int64()))])
_COUNTS = pa.schema([("token", pa.int64()), ("n", pa.int64())])
_ENTRIES = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("frequent", pa.bool_()), ("set_id", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])
_LISTS = pa.schema([("key", pa.int64()), ("frequent", pa.bool_()), ("set_id", pa.int64()), ("n", pa.int32()), ("place", pa.int32()),
                    ("first", pa.int64()), ("first_n", pa.int32()), ("first_place", pa.int32())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_PAIRS = pa.schema([*_LINKS, ("a_row", pa.int64()), ("b_row", pa.int64())])
_ONES = pa.schema([("n", pa.int64()), ("set_id", pa.int64()), ("row", pa.int64()), ("sketch", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary", pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def shingle_sets(part: pa.RecordBatch, text: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending."""
    words = W.Words(part.column(text), W.LOWER)
    hashes, offsets, counts = words.hashes(), words.offsets, words.counts
    grams = W.gram_hashes(hashes, SHINGLE)
    out = []
    for n, start in zip(counts.tolist(), offsets[:-1].tolist()):
        if n >= SHINGLE:
            out.append(np.unique(grams[start:start + n - SHINGLE + 1]))
        else:
            out.append(W.gram_hashes(hashes[start:start + n], n) if n else grams[:0])
    return out


def set_id(tokens: np.ndarray) -> int:
    """64-bit identity of a set, from all its shingles and their number."""
    total = np.array([len(tokens)], np.uint64) * W.ROLL[1] + W.mix(tokens + W.ROLL[0]).sum(dtype=np.uint64, keepdims=True)
    return int(W.mix(total).view(np.int64)[0])


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of 2n or more slots; slots of two sets differ at most as often as the sets do."""
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    parity = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(s, np.uint8) for s in sorted((a, b), key=len))
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def least_overlap(n: int) -> int:
    return -(-SHARE[0] * n // SHARE[1])


def _needed(a, b):
    """Shingles two linked sets of these sizes share at least: ceil(num * (a + b) / (num + den)), as a column."""
    return F.ceil((a + b) * SHARE[0] / F.lit(sum(SHARE)))


def _sizes_fit(a, b):
    return (a * SHARE[0] <= b * SHARE[1]) & (b * SHARE[0] <= a * SHARE[1])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in W.slices(batches, 2, SLICE_BYTES):
        sets = shingle_sets(part, 2)
        prefixes = [s[:len(s) - least_overlap(len(s)) + 1] if len(s) else s for s in sets]
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
        flat = W.signed(np.concatenate(prefixes)) if prefixes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], schema=_SETS)


class _Touched:
    """Rows (of row, prefix) of whose prefix a third or more are frequent shingles."""

    def __init__(self, frequent: Bitmap):
        self.frequent = frequent

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column(1)
            owner = pc.list_parent_indices(prefixes).to_numpy(zero_copy_only=False)
            hit = np.bincount(owner, self.frequent(prefixes.flatten().to_numpy(zero_copy_only=False)), batch.num_rows)
            yield batch.select([0]).filter(pa.array(3 * hit >= np.maximum(1, np.bincount(owner, minlength=batch.num_rows))))


class _CountAll:
    """Counts of all shingles of the wanted rows."""

    def __init__(self, wanted: Bitmap):
        self.wanted = wanted

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(_KeepRows(self.wanted)(batches), 2, SLICE_BYTES):
            sets = [s for s in shingle_sets(part, 2) if len(s)]
            if sets:
                tokens, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(tokens)), pa.array(n.astype(np.int64))], schema=_COUNTS)


def _pairs_of(m: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  kept between calls
    if m not in cache:
        cache[m] = np.triu_indices(m, 1)
    return cache[m]


class _Enter:
    """List entries of large sets and subset entries of small ones."""

    def __init__(self, frequent: Bitmap, boundary: int, buckets: int):
        self.frequent, self.boundary, self.buckets = frequent, boundary, buckets

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2, SLICE_BYTES):
            made, held = [], 0
            for tokens in shingle_sets(part, 2):
                for entries in self._of(tokens):
                    made.append(entries)
                    held += len(entries[0])
                    if held >= ENTRIES:
                        yield self._batch(made)
                        made, held = [], 0
            if made:
                yield self._batch(made)

    def _of(self, tokens: np.ndarray) -> Iterator[tuple]:
        """(keys, frequent, places, set id, size) of a set. The place of a subset is -1 - that of its later shingle."""
        n = len(tokens)
        if n < 2:
            return              # one shingle: only equal sets link, and those are one set already
        hot = self.frequent(tokens)
        order = np.argsort(hot, kind="stable")
        tokens, hot, own, p = tokens[order], hot[order], set_id(tokens), n - least_overlap(n) + 2
        if n > self.boundary:
            yield tokens[:p], hot[:p], np.arange(min(n, p), dtype=np.int32), own, n
        if n * SHARE[0] <= self.boundary * SHARE[1]:
            i, j = _pairs_of(p)
            low, high = np.minimum(tokens[i], tokens[j]), np.maximum(tokens[i], tokens[j])
            yield W.mix(low * W.ROLL[0] + W.mix(high) * W.ROLL[1]), hot[i] & hot[j], (-1 - j).astype(np.int32), own, n

    def _batch(self, made: list[tuple]) -> pa.RecordBatch:
        key, hot, place = (np.concatenate([m[i] for m in made]) for i in range(3))
        count = [len(m[0]) for m in made]
        own, size = (np.repeat(np.array([m[i] for m in made], kind), count) for i, kind in ((3, np.int64), (4, np.int32)))
        # Entries of a frequent key are dealt to SALTS buckets by their set.
        salt = np.where(hot, W.mix(own.view(np.uint64)) % np.uint64(SALTS), np.uint64(0))
        bucket = (W.mix(key + salt * W.ROLL[1]) % np.uint64(self.buckets)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, W.signed(key), hot, own, size, place)], schema=_ENTRIES)


def _make_lists(group: pa.Table) -> pa.Table:
    """Entries of the lists that hold more than one set, each with the first set of its list."""
    key, own = group["key"].to_numpy(), group["set_id"].to_numpy()
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    order, key = order[fresh], key[fresh]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(key)))
    kept = np.repeat(size > 1, size) | group["frequent"].to_numpy()[order]
    first = order[np.repeat(at, size)][kept]
    rows, heads = group.take(pa.array(order[kept])), group.take(pa.array(first))
    return pa.Table.from_arrays([rows[c] for c in ("key", "frequent", "set_id", "n", "place")] + [heads[c] for c in ("set_id", "n", "place")], schema=_LISTS)


def _at(place):
    """Place of an entry's shingle in its set, of a subset's later one."""
    return F.when(place < 0, -1 - place).otherwise(place)


def _meeting_twice(met: DataFrame) -> DataFrame:
    """Pairs (a, b) that can link, of meetings (a, b, a_n, b_n, a_place, b_place) in lists and subsets (place under 0).

    Linked sets have ``needed`` shingles in common, so the first two of them are among the first n - needed + 2 of both.
    """
    a_n, b_n = F.col("a_n"), F.col("b_n")
    early = F.least(a_n - _at(F.col("a_place")), b_n - _at(F.col("b_place"))) >= _needed(a_n, b_n) - 1
    times = F.sum(F.when(F.col("a_place") < 0, 2).otherwise(1))
    return met.where(_sizes_fit(a_n, b_n) & early).groupBy("a", "b").agg(times.alias("times")).where("times >= 2").select("a", "b")


def _still_open(lists: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the lists that hold sets of different components, with their ``label``. Lists closed once stay closed."""
    now = lists.join(label, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return now.join(mixed, "key", "left_semi").select("key", "frequent", "set_id", "n", "place", "label")


def _left(open_lists: DataFrame) -> tuple[float, int]:
    """(meetings across components, entries) in lists of frequent shingles; the other lists are short."""
    own = open_lists.where("frequent").groupBy("key", "label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    lists = own.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    left, held = lists.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2), F.sum("n")).first()
    return left or 0.0, int(held or 0)


_MET = ("a", "b", "a_n", "b_n", "a_place", "b_place")


def _others(open_lists: DataFrame, turn: int) -> DataFrame:
    """Meetings of the sets of each list with a few others of it, which are ``a``. Which these are goes by set and turn alone:
    sets that have much in common meet the same ones, and in more than one list."""
    by = F.xxhash64("set_id", F.lit(turn))
    least = F.min(F.struct(by.alias("by"), "set_id", "n", "place", "label"))
    other = open_lists.groupBy("key", F.pmod(by, F.lit(OTHERS)).alias("part")).agg(least.alias("y")).select("key", "y")
    return (open_lists.join(other, "key").where(F.col("label") != F.col("y.label"))
            .select("y.set_id", "set_id", "y.n", "n", "y.place", "place").toDF(*_MET))


def _some(pairs: DataFrame, turn: int) -> DataFrame:
    """Of the pairs (a, b) a few for each set, different ones for different sets: of many sets that are open against a few,
    each takes a few of these, so that each of the few is compared with many."""
    ends = pairs.unionAll(pairs.select("b", "a")).toDF("x", "y")
    by = F.xxhash64("x", "y", F.lit(turn))
    least = ends.groupBy("x", F.pmod(by, F.lit(OTHERS)).alias("part")).agg(F.min(F.struct(by.alias("by"), "y")).alias("least")).select("x", "least.y")
    return least.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _not_yet(pairs: DataFrame, some: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs not among ``some`` whose sets are still of different components."""
    side = lambda x: label.select(F.col("set_id").alias(x), F.col("label").alias(f"{x}_label"))
    return (pairs.join(some, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
            .where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b"))


def _labels(links: DataFrame, label: DataFrame | None = None) -> DataFrame:
    """(set_id, label) of the components of links (a, b) and of earlier ones, which their sets' ``label`` stands for."""
    if label is not None:
        links = links.unionAll(label.select(F.col("set_id").alias("a"), F.col("label").alias("b")))
    return components(links).select(F.col("node").alias("set_id"), "label")


def _across(open_lists: DataFrame) -> DataFrame:
    """Meetings of sets of different components in lists (key, set_id, n, place, label), the smaller set on one side.

    With a set that is no smaller, a set of n shingles shares ceil(6n/7) or more if they link, so on the smaller side only
    the first seventh of a set counts. Texts of one template whose own words are more than that do not meet, however many.
    """
    n = F.col("n")
    smaller = open_lists.where(n - _at(F.col("place")) >= _needed(n, n) - 1).select("key", F.struct("set_id", "n", "place", "label").alias("y"))
    larger = (n > F.col("y.n")) | ((n == F.col("y.n")) & (F.col("set_id") > F.col("y.set_id")))
    return (open_lists.join(smaller, "key").where(larger & (F.col("label") != F.col("y.label")))
            .select(F.least("set_id", "y.set_id"), F.greatest("set_id", "y.set_id"), "n", "y.n", "place", "y.place").toDF(*_MET))


class _KeepRows:
    def __init__(self, wanted: Bitmap):
        self.wanted = wanted

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = self.wanted(batch.column(1).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(some))


def _exact_shingles(text: str) -> set[bytes]:
    words = text.encode().lower().split()
    return {b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (a, part), the text of ``a`` itself (b null) before those it is compared with."""
    now, own = None, set()
    for batch in batches:
        a_out, b_out = [], []
        for a, b, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if b is None:
                now, own = a, _exact_shingles(text)
                continue
            if a != now:
                raise ValueError("a comparison came before its text")
            other = _exact_shingles(text)
            both = len(own & other)
            if both * SHARE[1] >= (len(own) + len(other) - both) * SHARE[0]:
                a_out.append(a)
                b_out.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], schema=_LINKS)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches differ no more than those of linked sets may."""
    for batch in batches:
        n, m, x, y = (batch.column(i).to_pylist() for i in range(4, 8))
        some = [sketch_distance(x[i], y[i]) <= n[i] + m[i] - 2 * -(-SHARE[0] * (n[i] + m[i]) // sum(SHARE)) for i in range(len(n))]
        yield batch.select(_PAIRS.names).filter(pa.array(some, pa.bool_()))


def _links(rows: DataFrame, ones: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids that link, by sketch and then by text. ``ones`` has one row of each set."""
    pairs = stored(pairs, "met")
    known = ones.mapInArrow(_KeepRows(Bitmap(pairs.select(F.explode(F.array("a", "b")).alias("set_id")), "set_id")), _ddl(_ONES))
    side = lambda x: known.select(F.col("set_id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("row", "n", "sketch")])
    near = (pairs.join(side("a"), "a").join(side("b"), "b").select(*_PAIRS.names, "a_n", "b_n", "a_sketch", "b_sketch")
            .mapInArrow(_near, _ddl(_PAIRS)))
    near = stored(near, "pairs")
    # Where each text goes: that of ``a`` itself (b null) to all parts of its comparisons, that of ``b`` to one.
    parts = near.groupBy("a", "a_row").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    heads = parts.select(F.col("a_row").alias("row"), "a", F.lit(None).cast("bigint").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = near.join(parts.select("a", "parts"), "a").select(F.col("b_row").alias("row"), "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    wanted = stored(heads.unionAll(members), "wanted")
    # Equal rows would give the text twice.
    texts = rows.mapInArrow(_KeepRows(Bitmap(wanted, "row")), "doc_id bigint, row bigint, text string").select("row", "text").dropDuplicates(["row"])
    dealt = texts.join(wanted, "row").select("a", "b", "text", "part").repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return stored(dealt.select("a", "b", "text").mapInArrow(_compare, _ddl(_LINKS)), "found")


def boundary_by_cost(sizes: list[tuple[int, int]], visits: float) -> int:
    """The boundary with the least work: subsets enumerated by small sets, list entries times their lists' length else.

    ``sizes``: (set size, sets); ``visits``: entries met per list entry.
    """
    def cost(boundary: int) -> float:
        total = 0.0
        for n, sets in sizes:
            rest = n - least_overlap(n)
            if n > boundary:
                total += sets * (rest + 2) * visits
            if n * SHARE[0] <= boundary * SHARE[1]:
                total += sets * (rest + 2) * (rest + 1) / 2
        return total
    return min(BOUNDARIES, key=cost)


def near_groups(documents: DataFrame, boundary: int | None = None, frequent_from: int = FREQUENT, bucket: int = BUCKET) -> DataFrame:
    """doc_id, row (hash of id and text), n_shingles and component_id (smallest doc_id reachable by links, its own
    included) of each document row.

    Null, empty and blank texts have the empty set: they link with nothing, and component_id is their own id. A
    null id takes part in links but never is a component's id, unless all its documents have none. Equal rows give
    equal results, one each. An empty table gives no rows; other columns are not read.
    """
    with arrow_rows(documents.sparkSession, ARROW_ROWS):
        return _near_groups(documents, boundary, frequent_from, bucket)


def _near_groups(documents: DataFrame, boundary: int | None, frequent_from: int, bucket: int) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    every = stored(rows.mapInArrow(_describe, _ddl(_SETS)), "sets")
    sets = every.where("n > 0")

    counts = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = stored(counts, "counts")
    visits = counts.agg(F.sum(F.least("n", F.lit(frequent_from)) * F.least("n", F.lit(frequent_from)))).first()[0]
    # A set with many frequent shingles in front is counted whole: what it has in common with many others comes late altogether.
    touched = sets.select("row", "prefix").mapInArrow(_Touched(Bitmap(counts.where(F.col("n") >= frequent_from), "token")), "row bigint")
    whole = (rows.mapInArrow(_CountAll(Bitmap(touched, "row")), _ddl(_COUNTS)).groupBy("token").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= frequent_from).select("token"))
    frequent = Bitmap(stored(counts.where(F.col("n") >= frequent_from).select("token").unionAll(whole), "frequent"), "token")
    # Sizes up to the largest boundary only; the cost of larger sets does not depend on it.
    sizes = [tuple(r) for r in sets.where(F.col("n") <= 2 * max(BOUNDARIES)).groupBy("n").count().collect()]
    prefix = sets.agg(F.sum(F.floor(F.col("n") * (SHARE[1] - SHARE[0]) / SHARE[1]) + 1)).first()[0] or 0
    if boundary is None:
        boundary = boundary_by_cost(sizes, 1 + (visits or 0) / max(1, prefix))
    buckets = max(1, math.ceil(prefix * 1.5 / bucket))

    lists = (rows.mapInArrow(_Enter(frequent, boundary, buckets), _ddl(_ENTRIES)).groupBy("bucket")
             .applyInArrow(_make_lists, _ddl(_LISTS)))
    lists = stored(lists, "lists")
    met = lists.where(F.col("set_id") != F.col("first")).select(F.col("first").alias("a"), F.col("set_id").alias("b"), F.col("first_n").alias("a_n"), F.col("n").alias("b_n"),
                                                                 F.col("first_place").alias("a_place"), F.col("place").alias("b_place"))
    stars = _meeting_twice(met)
    # The first sets of a frequent key's parts meet in one more star.
    firsts = lists.where("frequent and set_id = first").select("key", "first", "first_n").distinct()
    lowest = firsts.groupBy("key").agg(F.min("first").alias("low"), F.min_by("first_n", "first").alias("low_n"))
    links_of_parts = (firsts.join(lowest, "key").where("first <> low").where(_sizes_fit(F.col("first_n"), F.col("low_n")))
                      .select(F.col("low").alias("a"), F.col("first").alias("b")))
    ones = sets.groupBy("set_id").agg(F.min(F.struct("doc_id", "row", "n", "sketch")).alias("one")).select("one.n", "set_id", "one.row", "one.sketch")
    ones = stored(ones, "ones")
    found = _links(rows, ones, stars.unionAll(links_of_parts).distinct())

    label = _labels(found)
    open_lists, before = lists.select("key", "frequent", "set_id", "n", "place"), math.inf
    for turn in range(TURNS + 1):
        open_lists = stored(_still_open(open_lists.drop("label"), label), "open")
        left, held = _left(open_lists)
        if turn and (turn == TURNS or left <= OTHERS * held or left > LEFT * before):
            break
        before = left
        label = _labels(_links(rows, ones, _meeting_twice(_others(open_lists, turn))), label)
    pairs = stored(_meeting_twice(_across(open_lists)), "across")
    for turn in range(TURNS + 1):
        left, before = pairs.count(), left if turn else math.inf
        few = turn == TURNS or left > LEFT * before or left <= OTHERS * pairs.select(F.explode(F.array("a", "b"))).distinct().count()
        some = pairs if few else stored(_some(pairs, turn), "some")
        label = _labels(_links(rows, ones, some), label)
        if few:
            break
        pairs = stored(_not_yet(pairs, some, label), "across")

    docs = every.select("doc_id", "row", "n", "set_id").join(label, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    smallest = docs.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return (docs.join(smallest, "label", "left")
            .select("doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id")))


def one_of_each_group(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, with all their columns, less all but one row of each group: the one with the group's
    smallest id (of equal ids, the smallest hash of id and text). Documents with an empty set all stay.
    """
    found = near_groups(documents, **options)
    single = found.where("n_shingles = 0").select("row", F.lit(False).alias("grouped"))
    first = (found.where("n_shingles > 0").groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("row")).alias("alone"))
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
             .select("first.row", F.lit(True).alias("grouped")))
    kept = stored(single.unionAll(first).distinct(), "kept")
    rows = documents.withColumn("_row", F.xxhash64("doc_id", "text"))
    rows = rows.join(kept, F.col("_row") == F.col("row")).drop("row")
    # Of equal rows of a group one stays.
    copies = F.when(F.col("grouped"), F.lit(0)).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("_copy", copies).dropDuplicates(["_row", "_copy"]).select(*documents.columns)


_SQL = """WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
c AS (WITH RECURSIVE r AS (SELECT doc_id AS v, doc_id AS m FROM w UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.v WHERE r.m < e.y) SELECT v, min(m) AS m FROM r GROUP BY v)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.v = w.doc_id"""


@query("op3_ngram_jaccard", _SQL)
def op3(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
