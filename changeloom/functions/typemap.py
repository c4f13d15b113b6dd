"""Vendor column types to Spark types, as data.

A rule is (pattern, target). The pattern must match the whole type text, in any case; its groups
p and s are precision and scale. The first rule that matches wins. ``decimal`` becomes a string
beyond 38 digits, ``bits`` a boolean for one bit and binary otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from . import decimals, temporal, text

_U = r"( UNSIGNED)( ZEROFILL)?"
_N = r"(\(\d+\))?"                                   # display width or length
_PS = r"(\((?P<p>\d+)( ?, ?(?P<s>-?\d+))?\))?"
_P = r"( ?\(\d+\))?"

# Type mappings per source.
MYSQL = [
    (r"TINYINT\(1\)|BOOLEAN|BOOL", "boolean"),
    (r"BIT(\((?P<p>\d+)\))?", "bits"),
    (rf"TINYINT{_N}", "tinyint"),
    (rf"SMALLINT{_N}|TINYINT{_N}{_U}", "smallint"),
    (rf"(INT|INTEGER|MEDIUMINT){_N}|SMALLINT{_N}{_U}|YEAR{_N}", "int"),
    (rf"BIGINT{_N}|(INT|INTEGER|MEDIUMINT){_N}{_U}", "bigint"),
    (rf"BIGINT{_N}{_U}|SERIAL", "decimal(20,0)"),
    (rf"FLOAT{_PS}({_U})?", "float"),
    (rf"(REAL|DOUBLE|DOUBLE PRECISION){_PS}({_U})?", "double"),
    (rf"(NUMERIC|DECIMAL|FIXED){_PS}({_U})?", "decimal"),
    (r"DATE", "date"),
    (rf"TIME{_P}", "time"),
    (rf"(TIMESTAMP|DATETIME){_P}", "timestamp_ntz"),
    (rf"(CHAR|VARCHAR){_N}|(TINY|MEDIUM|LONG)?TEXT|ENUM(\(.*\))?|JSON", "string"),
    (rf"(BINARY|VARBINARY){_N}|(TINY|MEDIUM|LONG)?BLOB", "binary"),
    (r"SET(\(.*\))?", "set"),
    (r"GEOMETRY|POINT|LINESTRING|POLYGON|MULTIPOINT|MULTILINESTRING|MULTIPOLYGON|GEOMETRYCOLLECTION", "geometry"),
]
TIDB = [(rf"TIMESTAMP{_P}", "timestamp"),
        *[rule for rule in MYSQL if rule[1] != "geometry"]]
OCEANBASE = [(rf"TIMESTAMP{_P}", "timestamp"), (rf"REAL{_PS}({_U})?", "float"),
             *[rule for rule in MYSQL if rule[1] != "geometry"]]
POSTGRES = [
    (r"TINYINT|SMALLINT|INT2|SMALLSERIAL|SERIAL2", "smallint"),
    (r"INTEGER|INT|INT4|SERIAL|SERIAL4", "int"),
    (r"BIGINT|INT8|BIGSERIAL|SERIAL8", "bigint"),
    (r"REAL|FLOAT4", "float"),
    (r"FLOAT8|DOUBLE PRECISION", "double"),
    (rf"(NUMERIC|DECIMAL){_PS}", "decimal"),
    (r"BOOLEAN|BOOL", "boolean"),
    (r"DATE", "date"),
    (rf"TIME{_P}( WITHOUT TIME ?ZONE)?", "time"),
    (rf"TIMESTAMP{_P}( WITHOUT TIME ?ZONE)?", "timestamp_ntz"),
    (rf"(CHAR|CHARACTER|VARCHAR|CHARACTER VARYING){_N}|TEXT", "string"),
    (r"BYTEA", "binary"),
]
ORACLE = [
    (r"NUMBER\(1\)", "boolean"),
    (rf"NUMBER{_PS}", "number"),
    (rf"FLOAT{_N}|BINARY_FLOAT", "float"),
    (r"DOUBLE PRECISION|BINARY_DOUBLE", "double"),
    (rf"TIMESTAMP{_P} WITH LOCAL TIME ZONE", "timestamp"),
    (rf"TIMESTAMP{_P} WITH TIME ZONE", "timestamp"),
    (rf"DATE|TIMESTAMP{_P}( WITHOUT TIME ?ZONE)?", "timestamp_ntz"),
    (rf"(CHAR|NCHAR|NVARCHAR2|VARCHAR|VARCHAR2){_N}|N?CLOB|(SYS\.)?XMLTYPE", "string"),
    (r"BLOB|ROWID", "binary"),
    (rf"INTERVAL DAY{_P} TO SECOND{_P}|INTERVAL YEAR{_P} TO MONTH", "interval"),
]
SQLSERVER = [
    (rf"(CHAR|VARCHAR|NVARCHAR|NCHAR)(\((\d+|MAX)\))?|N?TEXT|XML", "string"),
    (rf"(DECIMAL|NUMERIC){_PS}", "decimal"),
    (r"MONEY", "decimal(19,4)"),
    (r"SMALLMONEY", "decimal(10,4)"),
    (rf"FLOAT{_N}|REAL", "double"),
    (r"BIT", "boolean"),
    (r"INT", "int"),
    (r"TINYINT|SMALLINT", "smallint"),
    (r"BIGINT", "bigint"),
    (r"DATE", "date"),
    (rf"TIME{_P}", "time"),
    (rf"DATETIME2{_P}|DATETIME|SMALLDATETIME", "timestamp_ntz"),
    (rf"DATETIMEOFFSET{_P}", "timestamp"),
]
DB2 = [
    (r"SMALLINT", "smallint"),
    (r"INTEGER|INT", "int"),
    (r"BIGINT", "bigint"),
    (r"REAL", "float"),
    (r"DOUBLE", "double"),
    (rf"(NUMERIC|DECIMAL){_PS}", "decimal"),
    (r"DATE", "date"),
    (r"TIME", "time"),
    (rf"TIMESTAMP{_P}", "timestamp_ntz"),
    (rf"(CHARACTER|CHAR|VARCHAR){_N}|VARGRAPHIC{_N}|XML", "string"),
    (rf"(BINARY|VARBINARY){_N}|(BLOB|CLOB|DBCLOB){_N}", "binary"),
]
MONGODB = [
    (r"INT", "int"),
    (r"LONG", "bigint"),
    (r"DOUBLE", "double"),
    (rf"DECIMAL128{_PS}", "decimal"),
    (r"BOOLEAN", "boolean"),
    (r"DATE", "timestamp_ntz"),
    (r"TIMESTAMP", "timestamp_ntz"),
    (r"STRING|OBJECTID|UUID|SYMBOL|MD5|JAVASCRIPT|REGEX", "string"),
    (r"BINDATA", "binary"),
]
DIALECTS = {"mysql": MYSQL, "tidb": TIDB, "oceanbase": OCEANBASE, "postgres": POSTGRES,
            "oracle": ORACLE, "sqlserver": SQLSERVER, "db2": DB2, "mongodb": MONGODB}
# Oracle integers by number of digits (p - s), largest first bound that fits.
NUMBER_STEPS = [(3, "tinyint"), (5, "smallint"), (10, "int"), (19, "bigint")]
DEFAULT_PRECISION = 38
# Sources whose number type without a precision holds any number of digits and a fraction: no decimal type does,
# so such numbers stay text, unless the caller declares a precision.
UNBOUNDED = ("postgres", "oracle")
# Sources with zero dates and boolean words in defaults.
LENIENT = ("mysql", "tidb", "oceanbase")


def _decimal(p: int, s: int) -> str:
    return f"decimal({p},{s})" if p <= 38 else "string"


def _number(p: int, s: int) -> str:
    if s > 0:
        return _decimal(p, s)
    digits = p - s
    return next((name for bound, name in NUMBER_STEPS if digits < bound), _decimal(digits, 0))


def logical_type(dialect: str, source_type: str) -> str:
    """Target of a vendor type: a Spark type name, or one of time, bits, set, geometry, interval."""
    name = re.sub(r"\s+", " ", source_type.strip())
    for pattern, target in DIALECTS[dialect]:
        found = re.fullmatch(pattern, name, re.IGNORECASE)
        if not found:
            continue
        groups = found.groupdict()
        p = int(groups.get("p") or (1 if target == "bits" else DEFAULT_PRECISION))
        s = int(groups.get("s") or 0)
        if target in ("decimal", "number") and groups.get("p") is None and dialect in UNBOUNDED:
            return "string"
        if target == "decimal":
            return _decimal(p, s)
        if target == "number":
            return _number(p, s)
        if target == "bits":
            return "boolean" if p == 1 else f"bits({p})"
        return target
    raise ValueError(f"{dialect} has no type {source_type!r}")


# Spark types of the targets that are not Spark type names themselves.
_CARRIED = {"time": "bigint", "set": "array<string>", "geometry": "string", "interval": "bigint"}


def spark_type(dialect: str, source_type: str) -> str:
    target = logical_type(dialect, source_type)
    return "binary" if target.startswith("bits") else _CARRIED.get(target, target)


def _clock_micros(value: Column) -> Column:
    """``HH:mm:ss[.f]`` to microseconds of the day."""
    pattern = r"^(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?$"

    def part(i):
        found = F.regexp_extract(value, pattern, i)
        return F.when(found == "", F.lit(0)).otherwise(found.try_cast("bigint"))
    fraction = F.rpad(F.substring(F.regexp_extract(value, pattern, 4), 1, 6), 6, "0").try_cast("bigint")
    micros = ((part(1) * 60 + part(2)) * 60 + part(3)) * 1_000_000 + fraction
    return F.when(value.rlike(pattern) & (micros < temporal.DAY_MICROS), micros)


def cast_expression(value: Column, dialect: str, source_type: str) -> Column:
    """Text of a vendor column to its Spark type; text that does not fit is null."""
    target = logical_type(dialect, source_type)
    if target == "boolean":
        plain = F.lower(value).isin("true", "false") | value.rlike(r"^[+-]?\d+$")
        return F.when(plain, text.to_boolean(value))
    if target.startswith("bits"):
        return F.when(value.rlike("^[01]+$"), text.decode_bits(value, int(target[5:-1])))
    if target == "time":
        return _clock_micros(value)
    if target == "set":
        return text.set_to_array(value)
    if target == "interval":
        return temporal.interval_to_long(value)
    if target == "binary":
        return F.try_to_binary(value, F.lit("base64"))
    if target in ("string", "geometry"):
        return value
    if target in ("date", "timestamp", "timestamp_ntz"):
        return value.try_cast(target)
    return F.trim(value).try_cast(target)


def cast_from_source(df: DataFrame, dialect: str, source_types: dict[str, str],
                     bad_count: str | None = None) -> DataFrame:
    """Cast text columns from their vendor types in one projection. Text that does not fit its type
    becomes null; ``bad_count`` names a column that counts such values per row."""
    made = {c: cast_expression(F.col(c), dialect, t) for c, t in source_types.items()}
    out = [(made[c].alias(c) if c in made else F.col(c)) for c in df.columns]
    if bad_count:
        bad = [(F.col(c).isNotNull() & e.isNull()).cast("int") for c, e in made.items()]
        total = bad[0]
        for b in bad[1:]:
            total = total + b
        out.append(total.alias(bad_count))
    return df.select(*out)


def default_expression(value: Column, dialect: str, source_type: str, nullable: bool = True) -> Column:
    """Text of a column default to its Spark type. Sources with zero dates take them as null, or the epoch where null
    is not allowed, accept any separators in timestamps, and boolean words for numbers."""
    target = logical_type(dialect, source_type)
    plain = cast_expression(value, dialect, source_type)
    if dialect not in LENIENT:
        return plain
    if target == "date":
        return temporal.zero_date(value, nullable, "date")
    if target in ("timestamp", "timestamp_ntz"):
        zoned = re.match("TIMESTAMP", source_type.strip(), re.IGNORECASE)
        return F.coalesce(temporal.zero_date(value, nullable, "zoned" if zoned else "timestamp").cast(target), plain)
    if target in ("tinyint", "smallint", "int", "bigint"):
        word = F.lower(F.trim(value))
        return F.when(word == "true", F.lit(1)).when(word == "false", F.lit(0)).otherwise(plain).cast(target)
    return plain


def apply_defaults(df: DataFrame, defaults: dict[str, tuple],
                   present: Column | None = None) -> DataFrame:
    """Typed defaults for columns a row did not carry: column -> (dialect, vendor type, default text[, nullable]).

    ``present`` is an array of the field names a row carried, so that an explicit null stays null.
    Without it only columns the whole frame lacks are filled. A null default stays null.
    """
    out = []
    for c, (dialect, kind, default, *rest) in defaults.items():
        value = default_expression(F.lit(default).cast("string"), dialect, kind, *rest)
        if c in df.columns:
            own = cast_expression(F.col(c), dialect, kind)
            value = own if present is None else F.when(F.array_contains(present, c), own).otherwise(value)
        out.append(value.alias(c))
    return df.select(*[c for c in df.columns if c not in defaults], *out)
