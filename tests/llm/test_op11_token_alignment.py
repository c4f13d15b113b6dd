"""Alignment against a byte-by-byte version with the plain libraries, the fast encoder, and the cases of the docstrings."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from changeloom.llm import op11_token_alignment as A

DOC = "doc_id bigint, text string, n_a string"


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=A.PIECES)


def brute(docs, plain):
    a, b = plain
    letters = A.byte_letters()
    listed = []
    for doc_id, text, *_ in docs:
        groups = []
        if text:
            want = f" {text}".encode()
            left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
            right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
            if b"".join(x for _, x in left) == b"".join(x for _, x in right) == want:
                ends = []
                for side in (left, right):
                    at, own = 0, {}
                    for i, x in side:
                        at += len(x)
                        own[at] = i
                    ends.append(own)
                group = ([], [])
                for at in range(1, len(want) + 1):
                    for side, own in zip(group, ends):
                        if at in own:
                            side.append(own[at])
                    if at in ends[0] and at in ends[1]:
                        groups.append(group)
                        group = ([], [])
        listed.append((doc_id, groups))
    count = Counter(p for _, groups in listed for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, groups in listed:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((doc_id, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def cases():
    rng = random.Random(3)
    parts = ["the", "Ünd", " ", "  ", "\n", "\t", "don't", "naïve", "中文字", "😀👍🏽", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "aaaa", "1234567", "...", "!!!???", " ", "é", "é", " ", "x" * 40, "Straße", "\r\n", "\x00", "ﬁ"]
    docs = [(i, "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 40))), "x") for i in range(150)]
    docs += [(i + 1000, d[1], "y") for i, d in enumerate(docs[:20])] + [docs[0], docs[0]]
    return docs + [(2000, None, None), (2001, "", "x"), (2002, "a▁b c", "x"), (2003, "▁", "x"), (2004, " ", "x"), (2005, "   lead", "x"), (None, "the the", "x"),
                   (2006, "é" * 5000, "x"), (2007, "ab" * 3000 + " end", "x"), (2008, " " * 4000 + "z", "x"), (2009, "the cat " * 20_000, "x")]


@pytest.mark.parametrize("block_pairs", [A.BLOCK_PAIRS, 300])
def test_against_bytes(spark, plain, block_pairs):
    docs = cases()
    aligned = A.align(spark.createDataFrame(docs, DOC).repartition(3))
    got, want = rows(A.link_counts(aligned, A.pair_counts(aligned), block_pairs)), brute(docs, plain)
    assert got == want and sum(r[1] == 0 for r in want) >= 3
    assert (2002, 0, 0, 0, 0, 0, 0, "") in got          # U+2581 does not come back


def test_documents_of_the_test_data(spark, plain):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert rows(A.op11(spark, path)) == brute(docs, plain)


def test_empty_table(spark):
    aligned = A.align(spark.createDataFrame([], DOC))
    assert A.link_counts(aligned, A.pair_counts(aligned)).count() == 0
    aligned = A.align(spark.createDataFrame([(1, None, "x")], DOC))
    assert rows(A.link_counts(aligned, A.pair_counts(aligned))) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_fast_encoder_gives_the_ids_of_the_file(plain):
    with open(A.BYTE_BPE, "rb") as file:
        own = A.ByteBpe(file.read())
    assert own.fast is not None
    rng = random.Random(11)
    kinds = ["ab", "aeiounrst", "the and ing ", "áéñü ", "0123456789 ", "!?.,- ", " \n\t", "'sdmtlvre ", "中文日本語", "अआइ", "ⅷ½²", "".join(map(chr, range(32, 0x250)))]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(1, 120)))
        assert own.fast.encode_ordinary(text) == plain[0].encode(text, add_special_tokens=False).ids, text
    # Each token of several bytes is what its own merge makes of it.
    vocabulary = [x for x in own.bytes[:-1] if len(x) > 1]
    for piece in rng.sample(vocabulary, 3000):
        text = piece.decode("utf-8", "ignore")
        if text.encode() == piece:
            assert own.fast.encode_ordinary(text) == plain[0].encode(text, add_special_tokens=False).ids


def test_long_runs_take_the_library_of_the_file():
    assert A._has_long_run("x" * 2000) and A._has_long_run(" " * 3000) and A._has_long_run("a b " * 9 + "y" * 2500)
    assert not A._has_long_run("ab " * 5000) and not A._has_long_run("")


def test_windows_are_words_and_are_kept():
    with open(A.BYTE_BPE, "rb") as a, open(A.PIECES, "rb") as b:
        aligner = A.Aligner(a.read(), b.read())
    import pyarrow as pa
    part = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([5, 6]), pa.array(["the cat sat. " * 50, "the cat"])], names=["row", "doc_id", "text"])
    out = aligner.rows(part)
    assert 4 <= len(aligner.memo) <= 6 and out.column(2).to_pylist()[1] == 2
    before = len(aligner.memo.shown)
    assert before == len(aligner.memo.pairs) == len(aligner.memo.n_groups) == len(aligner.memo.n_links)
    assert aligner.rows(part).equals(out) and len(aligner.memo.shown) == before


def test_groups_of_a_window():
    sizes = [0, 1, 2, 3, 4]
    assert A.align_window([1, 2, 1], [3, 1], sizes, sizes) == [([1, 2], [3]), ([1], [1])]
    assert A.align_window([4], [1, 1, 2], sizes, sizes) == [([4], [1, 1, 2])]


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    """Windows of made-up ids: with and without the limit the same pairs, as often."""
    rng = random.Random(6)
    sizes = [1, 2, 3, 5, 7]
    keys = []
    for _ in range(400):
        left, right = [rng.randrange(5) for _ in range(rng.randrange(1, 30))], []
        rest = sum(sizes[i] for i in left)
        while rest:
            i = rng.choice([j for j in range(5) if sizes[j] <= rest])
            right.append(i)
            rest -= sizes[i]
        keys.append(A.array("i", [*left, -1, *right]).tobytes())
    found = []
    for limit in (0, 3, 10 ** 9):
        monkeypatch.setattr(A, "LARGE_GROUP", limit)
        memo = A.Memo(sizes, sizes)
        place = memo.places(keys)
        pairs = []
        for p in place.tolist():
            counted = Counter()
            for pair, n in A.np.frombuffer(memo.pairs[p], A.np.int64).reshape(-1, 2).tolist():
                counted[pair] += n
            pairs.append(counted)
        found.append((pairs, [memo.shown[p] for p in place.tolist()]))
    assert found[0] == found[1] == found[2]
    for key, shown, pairs in zip(keys, found[0][1], found[0][0]):
        ids = A.np.frombuffer(key, A.np.int32).tolist()
        cut = ids.index(-1)
        groups = A.align_window(ids[:cut], ids[cut + 1:], sizes, sizes)
        assert shown == ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        assert pairs == Counter(x << 32 | y for p, q in groups for x in p for y in q)
