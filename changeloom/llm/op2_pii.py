"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, URL schemes and identifier cues. At each
anchor a small deterministic parser expands to both sides and validates what it found:

* email: local part back to its first character, domain labels forward;
* ip: four numbers joined by points, each at most 255;
* card: 16 to 19 digits with single spaces or hyphens between, Luhn checksum;
* phone: a plus sign and 8 to 15 digits;
* url: scheme to the end of its visible characters, closing punctuation left out;
* account: an identifier cue (such as "IBAN" or "account no") followed by a code with at least four digits;
  a code behind "IBAN" has the length of its country and passes the checksum, whatever follows it.

The first four kinds are what their regular expressions, searched left to right without overlap, give
(a match that fails validation is passed over whole); url and account are the method's own additions.
Spans of different kinds may overlap. One pass inside the tasks, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "url", "account"]
# Anchors.
SCHEMES = ["http://", "https://", "ftp://", "mailto:"]
CUES = ["iban", "account no", "account number", "acct", "konto", "kontonummer", "cuenta", "compte", "ssn",
        "social security", "passport", "customer id", "user id"]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'\x60{}|\\^]+")
# Characters of an account number by country.
IBAN_SIZE = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}
_CUE_END = r"[ \t]*(?:(?:no|nr|number|id|#|is)\b\.?)?[ \t]*[:#=]?[ \t]*"
_IBAN = re.compile(_CUE_END + r"([A-Za-z]{2}[0-9]{2}(?:[ -]?[A-Za-z0-9]){11,30})")
_CODE = re.compile(_CUE_END + r"([A-Za-z]{0,4}[0-9][A-Za-z0-9]*(?:[ -]?[A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)")


def _automaton():
    found = ahocorasick.Automaton()
    for word in ["@", "+", *_DIGITS]:
        found.add_word(word, (word if word in "@+" else "0", 1))
    for word in SCHEMES:
        found.add_word(word, ("s", len(word)))
    for word in CUES:
        found.add_word(word, ("c", len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(code: str) -> bool:
    code = code.replace(" ", "").replace("-", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def iban_end(text: str, start: int, stop: int) -> int | None:
    """End of the account number that starts at ``start``: as long as its country says, or for a country without a known
    length the longest that passes the checksum. A letter or digit right behind it makes it something else."""
    size, found, chars = IBAN_SIZE.get(text[start:start + 2].upper()), None, 0
    for at in range(start, stop):
        if text[at] in " -":
            continue
        chars += 1
        if (chars == size if size else chars >= 15) and not text[at + 1:at + 2].isalnum() and iban(text[start:at + 1]):
            found = at + 1
        if chars == size:
            break
    return found


def _lowered(text: str) -> str:
    """Lower case with every code point in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def find_spans(text: str, automaton) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, in the order of KINDS and then of the text."""
    spans: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)         # where the search of each kind goes on
    for last, (anchor, size) in automaton.iter(_lowered(text)):
        at = last - size + 1
        if anchor == "0":
            if at >= done[1]:
                # At a digit not passed over yet, so at the first of its run.
                m = _NUMBERS.match(text, at)
                if m:
                    done[1] = m.end()
                    # Long runs of digits are no number that int() reads.
                    if all(len(n := part.lstrip("0")) <= 3 and int(n or 0) <= 255 for part in m[0].split(".")):
                        spans.append((1, at, m.end()))
                else:
                    end = at + 1
                    while end < len(text) and text[end] in _DIGITS:
                        end += 1
                    done[1] = end
            if at >= done[2]:
                m = _GROUPS.match(text, at)
                done[2] = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans.append((2, at, m.end()))
        elif anchor == "@":
            start = at
            while start > done[0] and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                done[0] = m.end()
                spans.append((0, start, m.end()))
        elif anchor == "+":
            if at >= done[3] and (m := _PHONE.match(text, at)):
                done[3] = m.end()
                if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    spans.append((3, at, m.end()))
        elif anchor == "s":
            if at >= done[4] and (m := _URL.match(text, last + 1)):
                end = m.end()
                while end > last + 1 and text[end - 1] in ".,;:!?)]":
                    end -= 1
                if end > last + 1:
                    done[4] = end
                    spans.append((4, at, end))
        elif at >= done[5] and not (at and text[at - 1].isalnum()):
            numbered = text[at:last + 1].lower() == "iban"
            m = (_IBAN if numbered else _CODE).match(text, last + 1)
            end = m and (iban_end(text, m.start(1), m.end(1)) if numbered else m.end(1) if sum(c in _DIGITS for c in m[1]) >= 4 else None)
            if end:
                done[5] = end
                spans.append((5, m.start(1), end))
    return sorted(spans)


class _Find:
    """Adds ``spans`` to rows with a text at position ``at``, or (``mask``) replaces the text by its masked form."""

    def __init__(self, at: int, mask: bool):
        self.at, self.mask = at, mask

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for part in W.slices(batches, self.at):
            texts = part.column(self.at).to_pylist()
            found = [find_spans(t, automaton) if t else [] for t in texts]
            if self.mask:
                yield part.set_column(self.at, part.schema.field(self.at), pa.array([masked(t, f) for t, f in zip(texts, found)], part.schema.field(self.at).type))
            else:
                spans = pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in f] for f in found], _SPANS)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], names=[*part.schema.names, "spans"])


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each stretch of overlapping spans replaced by the kind of its first, longest span."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_pii(documents: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end; code points, end exclusive) of each document, in the order of KINDS and
    then of the text.

    Null and empty texts have no spans. Repeated rows give a row each, ids may be null or equal, an empty table gives
    no rows, and other columns are not read.
    """
    ddl = "doc_id bigint, text string, spans array<struct<kind:string,start:bigint,end:bigint>>"
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_Find(1, False), ddl).drop("text")


def mask_pii(documents: DataFrame) -> DataFrame:
    """``documents`` with all columns, each span in ``text`` replaced by the name of its kind; null stays null."""
    return documents.mapInArrow(_Find(documents.columns.index("text"), True), documents.schema)


def joined(spans, separator: str = ","):
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, separator)


@query("op2_pii")
def op2(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
