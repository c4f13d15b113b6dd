"""Event folding, the round trip through the template, and the cases of the docstrings."""

import hashlib
import random

from changeloom.llm import op10_chat as C

LOG = "conv_id bigint, message bigint, seq bigint, kind string, turn bigint, role string, data string, text string"
TABLE = "conv_id bigint, turn bigint, role string, text string, seq int"


def test_fold(spark):
    def e(message, seq, kind, data, conv=1, turn=0, role="user"):
        return (conv, message, seq, kind, turn, role, data, "x")
    log = [e(1, 0, "start", ""), e(1, 1, "delta", "wrong"), e(1, 2, "edit", "He"), e(1, 4, "delta", "o"), e(1, 3, "delta", "ll"),
           e(2, 0, "start", "", turn=1, role="assistant"), e(2, 1, "delta", "no"), e(2, 2, "regenerate", None), e(2, 3, "delta", "yes"), e(2, 3, "delta", "yes"),
           e(3, 0, "start", ""), e(3, 1, "delta", "gone"), e(3, 2, "delete", ""), e(4, None, "start", None, conv=None), e(4, 5, "delta", None, conv=None)]
    random.Random(1).shuffle(log)
    rows = {(r.conv_id, r.message): (r.turn, r.role, r.text) for r in C.reconstruct(spark.createDataFrame(log, LOG)).collect()}
    assert rows == {(1, 1): (0, "user", "Hello"), (1, 2): (1, "assistant", "yes"), (None, 4): (0, "user", "")}


def test_template_round_trip():
    rng = random.Random(2)
    pieces = ["<", "|", "\\", C.START, C.END, "\n", "a", "é", "😀", "<\\|", "%", "%0A", "assistant"]
    for _ in range(3000):
        said = ["".join(rng.choice(pieces) for _ in range(rng.randrange(8))) for _ in range(rng.randrange(5))]
        turns = [{"role": rng.choice(["user", "assistant", "x\ny%", C.START, ""]), "text": t} for t in said]
        text, spans = C.render(turns)
        assert C.parse(text) == [(t["role"], t["text"]) for t in turns]
        assert text.count(C.START) == text.count(C.END) == len(turns)
        assert [C.unescape(text[a:b]) for a, b in spans] == [t["text"] for t in turns if t["role"] == "assistant"]


def test_table_to_digests(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), i if rng.random() < .9 else None, rng.choice(["user", "assistant", "system", None]),
             rng.choice([None, "", "a", "x|<|im_end|>" * 9, "é😀" * 50]), 0) for i in range(60)]
    rows += [rows[0], rows[1], (9, 0, "assistant", "long " * 100_000, 0)]
    df = spark.createDataFrame(rows, TABLE)
    out = {r.conv_id: r for r in C.format_chats(C.reconstruct(C.event_log(df))).mapInArrow(
        C._read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint").collect()}
    none_first = lambda r: tuple((x is not None, x if x is not None else "") for x in (r[1], r[2], r[3] or ""))
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=none_first)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert out[conv].n_turns == len(own) and out[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert out[conv].loss_chars == len(loss) and out[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert len(out) == len({r[0] for r in rows})
    empty = spark.createDataFrame([], TABLE)
    assert C.format_chats(C.reconstruct(C.event_log(empty))).count() == 0
