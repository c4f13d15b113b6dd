"""Token counts under a unigram model, by dynamic programming shared along a trie.

A pre-token is a word with the word mark in front. Its tokens are the pieces of the segmentation with the highest total
score. The best score of a prefix depends on the prefix alone, so the distinct pre-tokens are inserted in a trie and the
forward step is made once per node; nodes where a pre-token ends store its number of pieces. The trie is walked in
sorted order with the current path on a stack, so its memory is that of the longest word, and finished counts are kept
for later texts of the task, up to a fixed number. Texts are never shuffled.

Pieces come from a vocabulary file that is a parameter; as it has ranks and no probabilities, a piece's log-probability is
set by Zipf's law, -ln(rank + ZIPF). Characters without a piece cost one token per UTF-8 byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
ZIPF = 2.7
# Counts kept between slices of a task.
KNOWN = 300_000

_OUT = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])


def read_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Log-probability of each piece of a sentencepiece file, control and byte pieces left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): -math.log(i + ZIPF) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


class Trie:
    """Counts pieces of pre-tokens; ``scores`` are the log-probabilities of the pieces."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        # A byte token is rarer than any piece.
        self.byte = min(scores.values(), default=0.0) - 1.0
        self.nodes = 0

    def count(self, pretokens: Iterable[str]) -> dict[str, int]:
        """Number of pieces of each distinct pre-token."""
        found, path = {}, ""
        best, pieces = [0.0], [0]       # per depth: best score of the path's prefix, and its pieces
        scores, longest = self.scores.get, self.longest
        for word in sorted(set(pretokens)):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1:], pieces[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                n = len(word[end - 1].encode("utf-8", "surrogatepass"))
                top, k = best[end - 1] + n * self.byte, pieces[end - 1] + n
                for start in range(max(0, end - longest), end):
                    score = scores(word[start:end])
                    if score is not None:
                        total = best[start] + score
                        # Of equal scores the one with fewer pieces.
                        if total > top or (total == top and pieces[start] + 1 < k):
                            top, k = total, pieces[start] + 1
                best.append(top)
                pieces.append(k)
                self.nodes += 1
            path = word
            found[word] = pieces[-1]
        return found


class _Count:
    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(self.shared.value), {}
        for part in W.slices(batches, 1):
            words = W.Words(part.column(1))
            coded = words.flat.dictionary_encode()
            distinct = [WORD_MARK + w for w in coded.dictionary.to_pylist()]
            if len(known) > KNOWN:
                known = {}
            known |= trie.count(w for w in distinct if w not in known)
            each = np.fromiter((known[w] for w in distinct), np.int64, len(distinct))
            total = np.concatenate(([0], np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.counts, pa.int64()), pa.array(np.diff(total[words.offsets]), pa.int64())],
                                             schema=_OUT)


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of each document row.

    The vocabulary is read on the driver and broadcast; it is as large as its file. Words are separated by ASCII white space. Null
    and empty texts count 0. Repeated rows give a row each, ids may be null, no documents give no rows, and other columns
    are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_pieces(vocabulary))
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_Count(shared), "doc_id bigint, n_pretokens bigint, n_tokens bigint")


@query("op7_token_counts")
def op7(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"))
