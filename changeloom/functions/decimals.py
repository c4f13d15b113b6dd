"""Exact numbers from their wire forms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F, types as T

def _limbs(b64: Column) -> tuple[Column, Column, Column]:
    """Signed big-endian bytes as 128 bits: signed high half, unsigned and signed low half."""
    digits = F.hex(F.unbase64(b64))
    fill = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    digits = F.lpad(digits, F.lit(32), fill)
    low = F.substring(digits, 17, 16)
    # A negative target base makes conv read two's complement.
    return F.conv(F.substring(digits, 1, 16), 16, -10), F.conv(low, 16, 10), F.conv(low, 16, -10)


def _point(unscaled: Column, scale: int) -> Column:
    """Digits of an unscaled integer with the decimal point put in (and leading zeros)."""
    if scale == 0:
        return unscaled
    padded = F.regexp_replace(unscaled, "^(-?)", "$1" + "0" * (scale + 1))
    return F.regexp_replace(padded, f"(\\d{{{scale}}})$", r".$1")


def decode_decimal(b64: Column, precision: int = 38, scale: int = 0) -> Column:
    """Base64 of signed big-endian unscaled bytes to a decimal; over 38 digits to a string."""
    if precision > 38:
        text = _point(_wide_integer(F.unbase64(b64)), scale)
        return F.regexp_replace(text, r"^(-?)0+(?=\d)", "$1")
    target = T.DecimalType(precision, scale)
    high, low, small = _limbs(b64)
    if precision <= 18:
        return (small.cast("bigint").cast("decimal(20,0)") / F.lit(10 ** scale).cast(T.DecimalType(scale + 1, 0))).cast(target)
    if precision <= 36:
        # |high * 2^64| < 10^36 + 2^64, so nothing overflows 38 digits.
        weight = F.lit(str(1 << 64)).cast("decimal(20,0)")
        whole = ((high.cast("decimal(19,0)") * weight).cast("decimal(38,0)") + low.cast("decimal(20,0)")).cast("decimal(38,0)")
        return _point(whole.cast("string"), scale).cast(target)
    return _point(_wide_integer(F.unbase64(b64)), scale).cast(target)


@F.pandas_udf(T.StringType())
def _wide_integer(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else str(int.from_bytes(b, "big", signed=True)))


def encode_decimal(value: Column, scale: int) -> Column:
    """Inverse of :func:`decode_decimal`, for all 38 digits: eight bytes where they suffice, else sixteen."""
    unscaled = F.replace(value.cast(f"decimal(38,{scale})").cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)")
    small = unscaled.try_cast("bigint")
    # value = high * 2^64 + low with 0 <= low < 2^64.
    weight = F.lit(str(1 << 64)).cast("decimal(20,0)")
    low = F.pmod(unscaled, weight)
    # Integer division cuts towards zero; the high half is rounded down.
    high = F.call_function("div", unscaled, weight) - F.when((unscaled < 0) & (low != 0), 1).otherwise(0)
    wide = F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.conv(low.cast("string"), 10, 16), 16, "0"))
    return F.base64(F.unhex(F.when(small.isNotNull(), F.lpad(F.hex(small), 16, "0")).otherwise(wide)))


def unsigned_bigint(b64: Column) -> Column:
    """Unsigned 64-bit number, never through a signed one."""
    return decode_decimal(b64, 20, 0)


def to_decimal(text: Column, scale: int | None = None) -> Column:
    """Trimmed number text as a decimal rounded half up. Without a scale no decimal type fits all numbers, so the number stays
    text, as it stands. Bad text is null."""
    if scale is None:
        return F.when(F.trim(text).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), F.trim(text))
    return F.trim(text).try_cast(f"decimal(38,{scale})")


def to_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")
