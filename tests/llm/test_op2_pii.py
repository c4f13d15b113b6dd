"""Spans against the regular expressions of the contract, and hand-made cases."""

import random
import re

import pytest

from changeloom.llm import op2_pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOC = "doc_id bigint, text string, spans string"


def digits(s):
    return "".join(c for c in s if c in "0123456789")


def brute(text):
    keep = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
            "card": lambda s: 16 <= len(digits(s)) <= 19 and P.luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15}
    return [(k, m.start(), m.end()) for k, r in zip(P.BASE, (EMAIL, IP, CARD, PHONE)) for m in r.finditer(text or "") if keep[k](m[0])]


def spans(df):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in df.collect()}


PIECES = ["@", ".", "+", "-", " ", "(", ")", "a", "B", "é", "İ", "😀", "x@y.z", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111",
          "4111-1111-1111-1112", "+49 30 1234567", "+1", "0", "12", "999", "\n", "iban ", "http://", "acct: ", "_%", "a@b", "...", "--"]


@pytest.mark.parametrize("seed", range(3))
def test_base_kinds_are_those_of_the_expressions(spark, seed):
    rng = random.Random(seed)
    docs = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(30))), "x") for i in range(3000)]
    got = spans(P.find_pii(spark.createDataFrame(docs, DOC)))
    for i, text, _ in docs:
        assert [s for s in got[i] if s[0] in P.BASE] == brute(text), text


def test_added_kinds_and_masking(spark):
    text = "See https://a.example/x?y=1, IBAN DE89 3704 0044 0532 0130 00; iban DE00 3704 0044 0532 0130 00. Account no: 12345-678 x"
    df = spark.createDataFrame([(1, text, "x")], DOC)
    row = P.find_pii(df).first()
    found = [(s.kind, text[s.start:s.end]) for s in row.spans]
    assert ("url", "https://a.example/x?y=1") in found
    assert ("account", "DE89 3704 0044 0532 0130 00") in found and ("account", "12345-678") in found
    assert P.mask_pii(df).first().text == "See [URL], IBAN [ACCOUNT]; iban DE00 3704 0044 0532 0130 00. Account no: [ACCOUNT] x"


# Numbers that their countries publish as examples.
IBANS = ["GB82 WEST 1234 5698 7654 32", "NL91 ABNA 0417 1643 00", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "NO93 8601 1117 947",
         "FR14 2004 1010 0505 0001 3M02 606", "mt84-malt-0110-0001-2345-mtlc-ast0-01s"]


@pytest.mark.parametrize("code", IBANS)
@pytest.mark.parametrize("text", ["IBAN: {} 2nd line", "Our IBAN {}, and more", "iban no. {}", "IBAN {} or GB82 WEST 1234 5698 7654 32", "IBAN is {}\nnext"])
def test_account_numbers_end_where_their_country_says(code, text):
    text, automaton = text.format(code), P._automaton()
    assert [text[a:b] for k, a, b in P.find_spans(text, automaton) if P.KINDS[k] == "account"] == [code]
    # One wrong digit, or one character more, is no account number.
    swapped = text.replace(code, code[:-1] + ("1" if code[-1] != "1" else "2"))
    for wrong in (swapped, text.replace(code, code + "7")):
        assert not [s for s in P.find_spans(wrong, automaton) if P.KINDS[s[0]] == "account"]


def test_edges(spark):
    docs = [(1, None, None), (2, "", "x"), (None, "a@b.co", "x"), (3, "q " * 500_000 + "a@b.co", "x"), (4, "a@b.co", "x"), (4, "a@b.co", "x")]
    df = spark.createDataFrame(docs, DOC)
    rows, masked = P.find_pii(df).collect(), P.mask_pii(df).collect()
    by, text = {r.doc_id: r for r in rows}, {r.doc_id: r.text for r in masked}
    assert len(rows) == len(masked) == 6 and text[1] is None and text[2] == "" and by[1].spans == by[2].spans == []
    assert tuple(by[3].spans[0]) == ("email", 1_000_000, 1_000_006) and text[3] == "q " * 500_000 + "[EMAIL]"
    assert sum(r.doc_id == 4 and r.text == "[EMAIL]" and r.spans == "x" for r in masked) == 2
    assert P.find_pii(spark.createDataFrame([], DOC)).count() == 0


def test_very_long_digit_runs(spark):
    """Longer than the 4,300 digits that Python reads as one number."""
    docs = [(1, "mail a@b.c and 10.0.0.1 " + "9" * 5000 + ".1.2.3", "x"), (2, "0" * 5000 + "7.1.2.3", "x"), (3, "1.2.3." + "0" * 5000, "x")]
    found = spans(P.find_pii(spark.createDataFrame(docs, DOC)))
    assert [k for k, *_ in found[1]] == ["email", "ip"] and found[2] == [("ip", 0, 5007)] and found[3] == [("ip", 0, 5006)]
