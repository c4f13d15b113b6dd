"""Words and word hashes of whole Arrow text columns, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Text handled at once inside a task. Longer texts are handled alone, but whole.
SLICE_BYTES = 2 << 20

_SPACE = [0x20, *range(0x09, 0x0E)]
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 0x20
# Lower case; everything in ASCII that is not a letter or a digit separates words.
LETTERS = LOWER.copy()
for _low, _high in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    LETTERS[_low:_high] = 0x20


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that column ``text`` holds about ``size`` bytes or a single row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """Words of every text of ``column``; null texts have none.

    ``offsets[i]:offsets[i + 1]`` are the words of text i in ``flat``; ``table`` maps each byte first,
    then ASCII white space separates words.
    """

    def __init__(self, column: pa.Array, table: np.ndarray = AS_IS):
        text = pc.fill_null(column, "").cast(pa.large_string())
        text = pa.concat_arrays([text]) if text.offset else text
        _, starts, data = text.buffers()
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        mapped = pa.py_buffer(table[raw].tobytes())
        text = pa.LargeStringArray.from_buffers(len(text), starts, mapped)
        lists = pc.ascii_split_whitespace(text)
        bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        filled = pc.greater(pc.binary_length(flat), 0)
        kept = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
        self.flat = flat.filter(filled)
        self.offsets = kept[bounds - bounds[0]].astype(np.int64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, wide: bool = False):
        """64-bit hash of every word; with ``wide`` a second, independent one as well."""
        coded = self.flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary.to_pylist()
        both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), np.uint64).reshape(-1, 2)
        return (both[codes, 0], both[codes, 1]) if wide else both[codes, 0]


# Odd multipliers of the sequence hashes and the finaliser.
ROLL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int, roll: np.uint64 = ROLL[0]) -> np.ndarray:
    """Hash of the k words from each position on (the last k - 1 positions have none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= roll
        out += words[j:j + n]
    return mix(out)


def room(offsets: np.ndarray) -> np.ndarray:
    """For each word, how many words its text has from it on."""
    total = int(offsets[-1])
    return np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)
