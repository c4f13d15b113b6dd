"""Documents in extended JSON to plain Spark columns.

The text is parsed once into a variant; every field is then a cheap lookup in its binary form. A value
may be plain (``5``) or wrapped (``{"$numberLong": "5"}``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F, types as T

# Wrapper fields that hold a text or a number.
TEXT_WRAPPERS = ("$oid", "$symbol", "$code", "$uuid", "$regex", "$numberDecimal", "$numberLong",
                 "$numberInt", "$numberDouble")
NUMBER_WRAPPERS = ("$numberLong", "$numberInt", "$numberDecimal", "$numberDouble")


def get(value: Column, path: list[str], kind: str) -> Column:
    """A field of a variant, null when it is absent or does not fit."""
    return F.try_variant_get(value, "$" + "".join(f"['{name}']" for name in path), kind)


def _scalar(value: Column, path: list[str], kind: T.DataType) -> Column:
    def at(*names, as_="string"):
        return get(value, [*path, *names], as_)

    if isinstance(kind, T.BinaryType):
        return F.unbase64(F.coalesce(at("$binary", "base64"), at("$binary"), at()))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        millis = F.coalesce(at("$date", "$numberLong", as_="bigint"), at("$date", as_="bigint"), at(as_="bigint"))
        instant = F.coalesce(F.timestamp_millis(millis),
                             F.timestamp_seconds(at("$timestamp", "t", as_="bigint")),
                             at("$date").try_cast("timestamp"))
        # The session zone is UTC (session.DEFAULTS), so the cast keeps the instant's UTC clock.
        return instant.cast(kind)
    if isinstance(kind, T.StringType):
        return F.coalesce(at("$regularExpression", "pattern"), *[at(n) for n in TEXT_WRAPPERS], at())
    name = kind.simpleString()
    if isinstance(kind, T.BooleanType):
        return at(as_=name)
    return F.coalesce(at(as_=name), *[at(n, as_=name) for n in NUMBER_WRAPPERS])


def _typed(value: Column, path: list[str], kind: T.DataType, where: str, hints: dict[str, str]) -> Column:
    if hints.get(where) == "dbref":
        ref = get(value, [*path, "$ref"], "string")
        key = F.coalesce(get(value, [*path, "$id", "$oid"], "string"), get(value, [*path, "$id"], "string"))
        return F.when(ref.isNotNull(), F.struct(ref.alias("$ref"), key.alias("$id")))
    if isinstance(kind, T.StructType):
        fields = [_typed(value, [*path, f.name], f.dataType, f"{where}.{f.name}".lstrip("."), hints).alias(f.name)
                  for f in kind.fields]
        found = get(value, path, "variant") if path else value
        return F.when(found.isNotNull() & ~F.is_variant_null(found), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(get(value, path, "array<variant>"),
                           lambda x: _typed(x, [], kind.elementType, f"{where}[]", hints))
    if isinstance(kind, T.MapType):
        return F.transform_values(get(value, path, "map<string,variant>"),
                                  lambda _, x: _typed(x, [], kind.valueType, f"{where}{{}}", hints))
    return _scalar(value, path, kind)


def decode_document(value: Column, schema, hints: dict[str, str] | None = None) -> Column:
    """A parsed document (variant) to a struct of ``schema``. ``hints`` marks reference fields:
    path -> ``dbref``."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return _typed(value, [], kind, "", hints or {})


def decode_bson_json(text: Column, schema, hints: dict[str, str] | None = None) -> Column:
    """Extended-JSON text to a struct of ``schema``."""
    return decode_document(F.try_parse_json(text), schema, hints)
