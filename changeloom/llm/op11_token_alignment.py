"""Alignment of two tokenizers, by whitespace-token anchors.

Each text is tokenised whole by both. Where tokens of both that begin with a space begin at the same byte, everything
before is aligned by itself: such *anchors* split a text into windows of token ids, usually one for each word. Inside a
window the byte offsets where tokens of both end cut it into groups. As the bytes of a token depend on its id alone, so
does the alignment of a window: it is memoised by the ids of its tokens, and a text is put together from its windows. The
memo is kept by the Python worker, up to a fixed number of windows.

How many documents hold a pair of ids linked is counted over the stored pairs of all documents, reduced inside each task
first. The counts are then looked up in blocks of a bounded number of pairs, each broadcast; neither texts nor pairs are
shuffled for it. The pairs that can exist are bounded by the two vocabularies, so the number of blocks does not grow with
the documents; with more than one, a few numbers of each document are added up.

The tokenizer files are read on the driver and shipped; they are parameters. A byte-level BPE file whose merges are in the
order of its ids is encoded by tiktoken from that file's own vocabulary, which is three times as fast and gives the same
ids (tests compare); any other goes through the library of the file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .stored import stored

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# How this kind of file splits a text before merging (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Longest run of characters of one kind that the fast encoder gets; it splits by backtracking.
LONGEST_RUN = 2_000
# Windows kept in the memo of a worker, and the longest one kept, in tokens; windows aligned together.
KNOWN = 400_000
KEPT_TOKENS = 64
TOGETHER = 1 << 16
# Links of a group from which they are counted by distinct ids.
LARGE_GROUP = 4_096
# Pairs of ids in one broadcast block, 17 bytes each.
BLOCK_PAIRS = 4_000_000

_SIZES = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _SIZES), ("groups_sha256", pa.string()),
                      ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_ALIGNED_DDL = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
_OUT_DDL = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable bytes are themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """A byte-level BPE file; ids of a text without special tokens, and the bytes of each id."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_buffer(data)
        self.slow.encode_special_tokens = True
        spec = json.loads(data)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}
        self.bytes = _by_id(ranks | {s.encode(): i for s, i in special.items()})
        self.fast = self._fast(spec, ranks) if self._ranked(spec, vocabulary) else None

    @staticmethod
    def _ranked(spec: dict, vocabulary: dict[str, int]) -> bool:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        return (model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel"
                and before.get("use_regex", True) and not before.get("add_prefix_space")
                and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix"))
                and [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged))))

    @staticmethod
    def _fast(spec: dict, ranks: dict[bytes, int]):
        import tiktoken
        return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and not _has_long_run(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def _has_long_run(text: str) -> bool:
    """Whether some LONGEST_RUN characters hold no change between white space and other characters."""
    if len(text) < LONGEST_RUN:
        return False
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    space = (points == 0x20) | ((points >= 9) & (points <= 13))
    at = np.flatnonzero(np.concatenate(([True], space[1:] != space[:-1], [True])))
    return bool((np.diff(at) >= LONGEST_RUN).any())


class Pieces:
    """A sentencepiece file with byte fallback."""

    def __init__(self, data: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = range(self.model.vocab_size())
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace("▁", " ").encode() for i in n]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def _by_id(ids: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ids.values(), default=-1) + 1)
    for piece, i in ids.items():
        out[i] = piece
    return out


def align_window(a: list[int], b: list[int], a_sizes: list[int], b_sizes: list[int]) -> list[tuple[list[int], list[int]]]:
    """Groups of a window: both sides are cut where tokens of both end. The sides have equally many bytes."""
    groups, i, j, x, y, s, t = [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            x += a_sizes[a[i]]
            i += 1
        else:
            y += b_sizes[b[j]]
            j += 1
        if x == y:
            groups.append((a[s:i], b[t:j]))
            s, t = i, j
    return groups


class Memo(dict):
    """Windows by the ids of their tokens, as bytes: side a, -1, side b. Values are places in the lists of results."""

    def __init__(self, a_sizes: list[int], b_sizes: list[int]):
        super().__init__()
        self.sizes = [np.array(a_sizes, np.int64), np.array(b_sizes, np.int64)]
        self.a_sizes, self.b_sizes = a_sizes, b_sizes
        # Ids as text with what follows them: another id of the group or its other side; another id, a group, the next window.
        self.written = [f"{i}{c}" for i in range(len(a_sizes)) for c in ",|"] + [f"{i}{c}" for i in range(len(b_sizes)) for c in ",;\n"]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.shown: list[str] = []          # the groups as text
        self.pairs: list[bytes] = []        # linked pairs and how often, 64-bit numbers in turn
        self.n_groups, self.n_links = array("q"), array("q")

    def places(self, keys: list[bytes]) -> np.ndarray:
        """Places of the results of all ``keys``; windows that are not known are aligned, together."""
        found = [self.get(k) for k in keys]
        if None in found:
            new = list(dict.fromkeys(k for k, place in zip(keys, found) if place is None))
            first, at = len(self.shown), 0
            now = {}
            while at < len(new):
                some = new[at:at + TOGETHER]
                now.update(zip(some, range(first + at, first + at + len(some))))
                self._align(some)
                at += len(some)
            self.update((k, place) for k, place in now.items() if len(k) <= 4 * KEPT_TOKENS)
            found = [now[k] if place is None else place for k, place in zip(keys, found)]
        return np.array(found, np.int64)

    def _align(self, keys: list[bytes]) -> None:
        """Appends the results of some windows. Both sides of a window have equally many bytes, so their ends can be counted through."""
        ids = np.frombuffer(b"".join(keys), np.int32)
        window = np.repeat(np.arange(len(keys)), [len(k) // 4 for k in keys])
        between = ids == -1
        behind = np.cumsum(between) > window
        sides, windows = [], []
        for here in (~behind, behind & ~between):
            sides.append(ids[here].astype(np.int64))
            windows.append(window[here])
        (a, b), ends = sides, [np.cumsum(size[x]) for size, x in zip(self.sizes, sides)]
        shared = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(shared, e) for e in ends]
        n = [np.bincount(g, minlength=len(shared)) for g in group]
        first = [np.cumsum(x) - x for x in n]
        own = windows[0][first[0]]                          # the window of each group
        links = np.zeros(len(keys), np.int64)
        np.add.at(links, own, n[0] * n[1])
        self.n_groups.extend(np.bincount(own, minlength=len(keys)).tolist())
        self.n_links.extend(links.tolist())
        # Text: the ids of a group's sides in turn, each with its sign.
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + first[1][group[0]]] = 2 * a + _last(group[0])
        written[np.arange(len(b)) + (first[0] + n[0])[group[1]]] = 2 * len(self.a_sizes) + 3 * b + _last(group[1]) + _last(windows[1])
        self.shown += "".join([self.written[c] for c in written.tolist()]).split("\n")[:-1]
        # Pairs: every id of side a with all of side b in its group. Very large groups are counted by distinct ids instead.
        large = set(own[n[0] * n[1] > LARGE_GROUP].tolist())
        kept = ~np.isin(windows[0], list(large)) if large else np.ones(len(a), bool)
        g = group[0][kept]
        size = n[1][g]
        pairs = np.ones((int(size.sum()), 2), np.int64)
        pairs[:, 0] = np.repeat(a[kept] << 32, size) | b[np.repeat(first[1][g] - np.cumsum(size) + size, size) + np.arange(len(pairs))]
        links[list(large)] = 0
        raw, cuts = pairs.tobytes(), [0, *(16 * np.cumsum(links)).tolist()]
        self.pairs += [raw[s:e] if w not in large else self._counted(keys[w]) for w, (s, e) in enumerate(pairwise(cuts))]

    def _counted(self, key: bytes) -> bytes:
        ids = np.frombuffer(key, np.int32).tolist()
        cut = ids.index(-1)
        links: Counter = Counter()
        for left, right in align_window(ids[:cut], ids[cut + 1:], self.a_sizes, self.b_sizes):
            on_right = Counter(right)
            for p, m in Counter(left).items():
                for q, n in on_right.items():
                    links[p << 32 | q] += m * n
        return array("q", (x for link in links.items() for x in link)).tobytes()


def _last(runs: np.ndarray) -> np.ndarray:
    """1 where a run of equal numbers ends."""
    out = np.ones(len(runs), np.int64)
    out[:-1] = runs[1:] != runs[:-1]
    return out


class Aligner:
    def __init__(self, a_data: bytes, b_data: bytes):
        self.a, self.b = ByteBpe(a_data), Pieces(b_data)
        sizes = [[len(x) for x in side.bytes] for side in (self.a, self.b)]
        self.sizes = [np.array(s, np.int64) for s in sizes]
        self.marked = [np.array([x[:1] == b" " for x in side.bytes]) for side in (self.a, self.b)]
        self.memo = Memo(*sizes)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides, or none where the bytes of either side are not those of the text."""
        if not text:
            return [], []
        spaced = f" {text}"
        want = spaced.encode()
        found = []
        for ids, side in ((self.a.encode(spaced), self.a), (self.b.encode(text), self.b)):
            if b"".join(map(side.bytes.__getitem__, ids)) != want:
                return [], []
            found.append(ids)
        return found[0], found[1]

    def windows(self, sides: list[np.ndarray], firsts: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
        """Keys of the windows of some texts, and where each begins on side a. ``firsts`` are the places of the texts' first tokens."""
        starts = []
        for ids, first, sizes, marked in zip(sides, firsts, self.sizes, self.marked):
            may = marked[ids]
            may[first] = True
            begin = np.cumsum(sizes[ids]) - sizes[ids]
            starts.append((begin, begin[may]))
        anchors = np.intersect1d(starts[0][1], starts[1][1], assume_unique=True)
        wa, wb = (np.searchsorted(s[0], anchors) for s in starts)
        a, b, w = *sides, np.arange(len(anchors))
        na, nb = np.diff(np.append(wa, len(a))), np.diff(np.append(wb, len(b)))
        keys = np.full(len(a) + len(b) + len(w), -1, np.int32)
        keys[np.arange(len(a)) + np.repeat(wb + w, na)] = a
        keys[np.arange(len(b)) + np.repeat(wa + na + w + 1, nb)] = b
        raw, cuts = keys.tobytes(), (4 * np.append(wa + wb + w, len(keys))).tolist()
        return [raw[p:q] for p, q in pairwise(cuts)], wa

    def rows(self, part: pa.RecordBatch) -> pa.RecordBatch:
        """Alignment of each row of (row, doc_id, text)."""
        n = part.num_rows
        if len(self.memo.shown) > KNOWN:
            self.memo.forget()
        both = [self.tokens(t) for t in part.column(2).to_pylist()]
        counts = [np.array([len(x[s]) for x in both], np.int64) for s in (0, 1)]
        sides = [np.fromiter(chain.from_iterable(x[s] for x in both), np.int32, int(counts[s].sum())) for s in (0, 1)]
        del both
        some = np.flatnonzero(counts[0])
        firsts = [(np.cumsum(c) - c)[some] for c in counts]
        keys, begin = self.windows(sides, firsts)
        memo = self.memo
        code = memo.places(keys)
        own = some[np.searchsorted(firsts[0], begin, "right") - 1]
        n_groups, n_links = (np.zeros(n, np.int64) for _ in range(2))
        np.add.at(n_groups, own, np.array(memo.n_groups, np.int64)[code])
        np.add.at(n_links, own, np.array(memo.n_links, np.int64)[code])
        bounds, shown, digests = np.searchsorted(own, np.arange(n + 1)).tolist(), memo.shown, []
        each = code.tolist()
        for s, e in pairwise(bounds):
            digests.append(hashlib.sha256(";".join([shown[c] for c in each[s:e]]).encode()).hexdigest() if e > s else "")
        pairs, times, cuts = self._pairs(code, own, n)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *(pa.array(x) for x in (*counts, n_groups, n_links)), pa.array(digests, pa.string()),
             pa.ListArray.from_arrays(cuts, pairs), pa.ListArray.from_arrays(cuts, times)], schema=_ALIGNED)

    def _pairs(self, code: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Distinct pairs of each of n texts, in order, and how often each is linked; offsets of the texts."""
        kinds, kind = np.unique(code, return_inverse=True)
        listed = [self.memo.pairs[c] for c in kinds.tolist()]
        held = np.frombuffer(b"".join(listed), np.int64).reshape(-1, 2)
        sizes = np.array([len(x) // 16 for x in listed], np.int64)
        starts = np.cumsum(sizes) - sizes
        # A window that a text repeats is listed once for it.
        place, repeats = np.unique(own * max(1, len(kinds)) + kind, return_counts=True)
        text, kind = np.divmod(place, max(1, len(kinds)))
        size = sizes[kind]
        at = np.repeat(starts[kind] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        pairs, pair = np.unique(held[:, 0], return_inverse=True)
        key = np.repeat(text, size) * max(1, len(pairs)) + pair[at]
        order = np.argsort(key)
        key, each = key[order], (held[at, 1] * np.repeat(repeats, size))[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        times = np.add.reduceat(each, first) if len(first) else each
        text, pair = np.divmod(key[first], max(1, len(pairs)))
        return pa.array(pairs[pair]), pa.array(times), pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32))


# The aligner of this worker, by the digest of its files.
_ALIGNER: dict[str, Aligner] = {}


class _Align:
    def __init__(self, files, digest: str):
        self.files, self.digest = files, digest

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if self.digest not in _ALIGNER:
            _ALIGNER.clear()
            _ALIGNER[self.digest] = Aligner(*map(base64.b64decode, self.files.value))
        for part in W.slices(batches, 2):
            yield _ALIGNER[self.digest].rows(part)


class _Look:
    """Adds what the pairs of one block give to a row: how many links are of a best pair, and the sum of counts."""

    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = self.shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
            each = pairs.flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(batch.num_rows), pc.list_value_length(pairs).to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(known, each), max(0, len(known) - 1))
            here = known[at] == each if len(known) else np.zeros(len(each), bool)
            sums = []
            for value in (best, count):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, own[here], value[at[here]] * times[here])
                sums.append(pa.array(total))
            kept = [n for n in batch.schema.names if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *sums], names=[*kept, "n_best", "count_sum"])


def align(documents: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and for the pairs of ids that the document links: ``pairs``
    (id of a * 2^32 + id of b, in order) and ``times``; stored, one row for each document row.

    Null and empty texts, and those whose tokens do not give their bytes back, have no tokens: zeros, an empty digest and no
    pairs. Repeated rows are documents of their own, ids may be null, and other columns are not read.
    """
    files = []
    for path in (byte_bpe, pieces):
        with open(path, "rb") as file:
            files.append(base64.b64encode(file.read()))
    digest = hashlib.sha256(b" ".join(files)).hexdigest()
    shared = documents.sparkSession.sparkContext.broadcast(files)
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = stored(rows.mapInArrow(_Align(shared, digest), _ALIGNED_DDL), "aligned")
    shared.destroy()
    return out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked) and best (1 if no pair of its id of a has more)."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))        # at most a row for each id of a vocabulary
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("bigint").alias("best"))


def link_counts(aligned: DataFrame, counts: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum over the links of each row."""
    spark, base = aligned.sparkSession, [c for c in aligned.columns if c not in ("pairs", "times")]
    blocks = max(1, math.ceil(counts.count() / block_pairs))
    out = None
    for b in range(blocks):
        block = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == b).toArrow()
        columns = [block[c].to_numpy() for c in ("pair", "n", "best")]
        order = np.argsort(columns[0])
        shared = spark.sparkContext.broadcast((columns[0][order], columns[1][order], columns[2][order].astype(np.int8)))
        part = aligned.mapInArrow(_Look(shared), _OUT_DDL)
        if blocks > 1:
            part = stored(part, "looked-up")
            shared.destroy()
        out = part if out is None else out.unionAll(part)
    if blocks > 1:
        out = out.groupBy("row").agg(*(F.first(c).alias(c) for c in base[1:]), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out


@query("op11_token_alignment")
def op11(spark, sf_dir):
    aligned = align(table(spark, sf_dir, "documents"))
    return link_counts(aligned, pair_counts(aligned)).select("doc_id", *_SIZES, "n_best", "count_sum", "groups_sha256")
