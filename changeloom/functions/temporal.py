"""Dates, times and timestamps from their wire forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
# Texts that stand for the epoch.
EPOCH_DATE, EPOCH_TIMESTAMP = "1970-01-01", "1970-01-01 00:00:00"
# Fixed value: microseconds of an average month (365.25 / 12 days).
MONTH_MICROS = 2_629_800_000_000


def decode_date(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def decode_time(micros: Column) -> Column:
    """Microseconds of the day; null stays null, a value outside one day is an error."""
    bad = (micros < 0) | (micros > DAY_MICROS)
    message = F.concat(F.lit("time of day out of range: "), micros.cast("string"))
    return F.when(bad, F.raise_error(message).cast("bigint")).otherwise(micros)


def format_time(micros: Column, digits: int = 6) -> Column:
    """HH:mm:ss, with fractional digits when asked for. A whole day prints as 00:00:00."""
    at = F.pmod(micros, F.lit(DAY_MICROS))
    clock = F.date_format(F.timestamp_micros(at).cast("timestamp_ntz"), "HH:mm:ss")
    if not digits:
        return clock
    return F.concat(clock, F.lit("."), F.substring(F.lpad((at % 1_000_000).cast("string"), 6, "0"), 1, digits))


def decode_timestamp(value: Column, unit: str = "millis") -> Column:
    instant = {"millis": F.timestamp_millis, "micros": F.timestamp_micros}[unit](value)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def decode_zoned(text: Column, server_zone: str = "UTC") -> Column:
    """ISO instant text to the wall clock of the server's zone."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.cast("timestamp").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(server_zone), utc)


def to_local_datetime(value: Column, kind: str) -> Column:
    """date -> midnight; time (micros) -> that time on 1970-01-01; instant (millis) -> UTC."""
    if kind == "date":
        return value.cast("timestamp_ntz")
    if kind == "time":
        return decode_timestamp(decode_time(value), "micros")
    if kind == "instant":
        return decode_timestamp(value, "millis")
    raise ValueError(f"unknown temporal kind {kind!r}")


def zero_date(text: Column, nullable: bool, kind: str = "date") -> Column:
    """Text to a date (or ``timestamp`` / ``zoned``); zero dates become null, or the epoch where
    null is not allowed."""
    # yyyy-MM-dd, and for a timestamp midnight behind it: zero when any of the three parts is.
    day, clock = F.split_part(text, F.lit(" "), F.lit(1)), F.split_part(text, F.lit(" "), F.lit(2))
    parts = [F.split_part(day, F.lit("-"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    no_day = day.rlike(r"^\d{4}-\d\d-\d\d$") & ((parts[0] == 0) | (parts[1] == 0) | (parts[2] == 0))
    midnight = clock.rlike(r"^00:00:00(\.\d{1,6})?$")
    zero = (text == "0") | (no_day & midnight)
    if kind == "date":
        zero = zero | (no_day & (clock == ""))
    elif kind == "zoned":
        zero = zero | (text == EPOCH_TIMESTAMP)
    target = "date" if kind == "date" else "timestamp_ntz"
    value = clean_timestamp(text) if kind == "zoned" else text
    epoch = F.lit(None if nullable else EPOCH_TIMESTAMP).cast(target)
    return F.when(zero, epoch).otherwise(value.try_cast(target))


def clean_timestamp(text: Column) -> Column:
    """Any separators to ``yyyy-MM-dd HH:mm:ss[.f]``, missing time parts 0; impossible dates null."""
    t = F.trim(text)
    # year, month, day, then optional hour, minute, second; the first runs of non-digits between
    # them are the separators, whatever they are. A fraction follows a dot.
    pattern = r"^(\d+)\D+(\d+)\D+(\d+)(?:\D+(\d+)(?:\D+(\d+)(?:\D+(\d+)(?:\.(\d+))?)?)?)?\D*$"

    def part(i, width):
        found = F.regexp_extract(t, pattern, i)
        return F.lpad(F.when(found == "", "0").otherwise(found.try_cast("int").cast("string")), width, "0")

    month, day = (F.regexp_extract(t, pattern, i).try_cast("int") for i in (2, 3))
    valid = t.rlike(pattern) & month.between(1, 12) & day.between(1, 31)
    fraction = F.regexp_extract(t, pattern, 7)
    clean = F.concat(part(1, 4), F.lit("-"), part(2, 2), F.lit("-"), part(3, 2), F.lit(" "),
                     part(4, 2), F.lit(":"), part(5, 2), F.lit(":"), part(6, 2),
                     F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))
    return F.when(valid, clean)


def interval_to_long(text: Column) -> Column:
    """``+02-06`` (year-month) or ``+05 10:20:30.123456`` (day-second) to microseconds."""
    t = F.trim(text)
    year_month = r"^([+-]?)(\d+)-(\d+)$"
    day_second = r"^([+-]?)(\d+) (\d+):(\d+):(\d+)(?:\.(\d{1,6})\d*)?$"

    def number(pattern, i):
        return F.regexp_extract(t, pattern, i).try_cast("bigint")

    months = number(year_month, 2) * 12 + number(year_month, 3)
    seconds = ((number(day_second, 2) * 24 + number(day_second, 3)) * 60
               + number(day_second, 4)) * 60 + number(day_second, 5)
    fraction = F.rpad(F.regexp_extract(t, day_second, 6), 6, "0").try_cast("bigint")
    sign = F.when(t.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    return (F.when(t.rlike(year_month), sign * months * MONTH_MICROS)
            .when(t.rlike(day_second), sign * (seconds * 1_000_000 + fraction)))
