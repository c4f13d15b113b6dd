"""Bits, booleans, sets, JSON and character sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F, types as T

# Database character set -> Java name where the engine decodes it itself, and
# -> Python codec for the others.
ENGINE_CHARSETS = {"ascii": "US-ASCII", "utf8": "UTF-8", "utf8mb4": "UTF-8",
                   "utf16": "UTF-16BE", "ucs2": "UTF-16BE", "utf16le": "UTF-16LE", "utf32": "UTF-32"}
TABLE_CHARSETS = {"big5": "big5", "gbk": "gbk", "sjis": "shift_jis", "cp932": "cp932",
                  "gb2312": "gb2312", "gb18030": "gb18030", "ujis": "euc_jp", "eucjpms": "euc_jp",
                  "euckr": "euc_kr", "latin2": "iso8859_2", "latin5": "iso8859_9",
                  "latin7": "iso8859_13", "greek": "iso8859_7", "hebrew": "iso8859_8",
                  "cp850": "cp850", "cp852": "cp852", "cp866": "cp866", "tis620": "tis_620",
                  "cp1250": "cp1250", "cp1251": "cp1251", "cp1256": "cp1256", "cp1257": "cp1257",
                  "macroman": "mac_roman", "macce": "mac_latin2", "koi8r": "koi8_r",
                  "koi8u": "koi8_u"}

# The database's latin1 is the Windows code page: bytes 0x80 to 0x9F are these characters, where it has any.
_WINDOWS = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decode_bits(bits: Column, n: int) -> Column:
    """Bit text: one bit to a boolean, more to ceil(n/8) big-endian bytes."""
    if n == 1:
        return to_boolean(bits)
    width = (n + 7) // 8 * 8
    padded = F.lpad(bits, width, "0")
    bytes_ = [F.lpad(F.conv(F.substring(padded, i, 8), 2, 16), 2, "0") for i in range(1, width, 8)]
    return F.unhex(F.concat(*bytes_))


def to_boolean(value: Column) -> Column:
    """A number other than 0, else the word true."""
    text = value.cast("string")
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int") != 0)
    return F.when(text.isNotNull(), F.coalesce(number, F.lower(text) == "true"))


def set_to_array(value: Column) -> Column:
    """``a,b`` to [a, b]; the empty set to an empty array."""
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, ","))


def json_text(value: Column) -> Column:
    """JSON in one spelling, so that texts that differ in blanks or key order compare equal."""
    return F.to_json(F.try_parse_json(value))


def decode_charset(raw: Column, charset: str) -> Column:
    """Bytes in a database character set to text."""
    name = charset.lower()
    if name == "latin1":
        return F.translate(F.decode(raw, "ISO-8859-1"), "".join(_WINDOWS), "".join(_WINDOWS.values()))
    if name in ENGINE_CHARSETS:
        return F.decode(raw, ENGINE_CHARSETS[name])
    codec = TABLE_CHARSETS[name]

    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(codec, "replace"))
    return decode(raw)
