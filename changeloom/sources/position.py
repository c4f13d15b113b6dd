"""One sortable value for the place of an event in a log: a number, or a text where a number is too small."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places in a file are below 2^32; file numbers may take the 31 bits above.
FILE_SHIFT = 32
# Digits of a counter in a wide position; 80 bits take 25.
DIGITS = 25


def _checked(value: Column, outside: Column, what: str) -> Column:
    return F.when(outside, F.raise_error(F.lit(f"a position does not fit: {what}"))).otherwise(value)


def packed(high: Column, low: Column) -> Column:
    """Two counters, the first one leading, as one number. Counters of more than 31 and 32 bits are an error."""
    high, low = high.cast("bigint"), low.cast("bigint")
    outside = ~high.between(0, (1 << 31) - 1) | ~low.between(0, (1 << FILE_SHIFT) - 1)
    return _checked(F.shiftleft(high, FILE_SHIFT) + low, outside, "31 and 32 bits are packed, wide=True takes more")


def log_position(file: str | int | None, pos: int) -> int:
    """The packed number of a place, for start positions. ``file`` is a number or a name that ends in one."""
    if isinstance(file, str):
        file = int(re.search(r"(\d+)$", file)[1])
    if not (0 <= (file or 0) < 1 << 31 and 0 <= pos < 1 << FILE_SHIFT):
        raise ValueError(f"file {file} and place {pos} do not fit 31 and 32 bits")
    return ((file or 0) << FILE_SHIFT) + pos


def wide_position(*counters: str | int | None) -> str:
    """The text of a wide position, for start positions: numbers, colon-separated hexadecimal counters, or names that
    end in a number."""
    def number(c):
        if isinstance(c, str) and ":" in c:
            parts = [int(x, 16) for x in c.split(":")] + [0]
            if parts[0] >> 32 or parts[1] >> 32 or parts[2] >> 16:
                raise ValueError(f"{c} does not fit 32, 32 and 16 bits")
            return (parts[0] << 48) + (parts[1] << 16) + parts[2]
        return int(re.search(r"(\d+)$", c)[1]) if isinstance(c, str) else c or 0
    numbers = [number(c) for c in counters]
    if not all(0 <= n < 10 ** DIGITS for n in numbers):
        raise ValueError(f"{counters} do not fit {DIGITS} digits")
    return "".join(str(n).zfill(DIGITS) for n in numbers)


def file_number(name: Column) -> Column:
    """Number a log file's name ends in; null without a name."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("bigint")


def is_wide(fields: list[str]) -> bool:
    """Whether a number may be too small for the fields: for several, except a file and a place in it."""
    return len(fields) > 1 and not (len(fields) == 2 and fields[0] == "file")


def of_source(source: Column, fields: list[str], wide: bool) -> Column:
    """Position from the named fields of an event's source: ``file`` and a place in it, or counters of which the first
    leads. Text is a number, or in fields whose name has ``lsn`` in it colon-separated hexadecimal counters of 32, 32
    and 16 bits, which are read as one number. Null where the last field is missing; another missing one counts as 0.

    The position is a bigint, and a part that does not fit is an error; or, if ``wide``, a text of DIGITS digits for each
    field, whose order is that of the fields.
    """
    def number(name):
        value = source[name].cast("string")
        kind = f"decimal({DIGITS},0)" if wide else "bigint"
        if name == "file":
            return file_number(value).cast(kind)
        plain = value.try_cast(kind)
        if "lsn" not in name.lower():
            # Text that is no number of this size would otherwise count as missing.
            outside = value.isNotNull() & F.coalesce(plain < 0, F.lit(True))
            return _checked(plain, outside, f"{name} is no number of type {kind}")
        parts = F.split(value, ":")
        counters = [F.conv(F.get(parts, F.lit(i)), 16, 10).cast("decimal(20,0)") for i in range(3)]
        counters[2] = F.coalesce(counters[2], F.lit(0).cast("decimal(20,0)"))
        # A bigint keeps the second counter in 24 bits and the third one in 8.
        bits = (32, 32, 16) if wide else (31, 24, 8)
        outside = F.lit(False)
        for c, b in zip(counters, bits):
            outside = outside | (c >= F.lit(1 << b))
        first, second, third = (_checked(c, outside, f"{name} has counters of more than {bits} bits").cast("bigint") for c in counters)
        if wide:
            hexa = first.cast("decimal(10,0)") * F.lit(1 << 48).cast("decimal(15,0)") + (F.shiftleft(second, 16) + third).cast("decimal(15,0)")
        else:
            hexa = F.shiftleft(first, 32) + F.shiftleft(second, 8) + third
        plain = _checked(plain, value.isNotNull() & ~value.contains(":") & (plain.isNull() | (plain < 0)), f"{name} is no number of type {kind}")
        return F.when(value.contains(":"), hexa.cast(kind)).otherwise(plain)
    numbers = [number(f) for f in fields]
    numbers = [F.coalesce(n, F.lit(0).cast(f"decimal({DIGITS},0)" if wide else "bigint")) for n in numbers[:-1]] + numbers[-1:]
    if wide:
        return F.concat(*[F.lpad(n.cast("string"), DIGITS, "0") for n in numbers])
    if len(fields) > 2:
        raise ValueError("more than two position fields need wide=True")
    return numbers[0] if len(fields) == 1 else packed(*numbers)
