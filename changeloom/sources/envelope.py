"""JSON change envelopes: text to change rows and back."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from ..functions import decimals, temporal
from ..functions.text import set_to_array
from .position import is_wide, of_source

SOURCE_FIELDS = "db:string,schema:string,table:string,ts_ms:bigint,row:bigint,part:bigint"
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
SET = T.ArrayType(T.StringType())
# Fields of an event's source that say where it is in its log, the leading one first.
POSITION = ("file", "pos")


def _row_type(row_schema) -> T.StructType:
    return row_schema if isinstance(row_schema, T.StructType) else T.StructType.fromDDL(row_schema)


def _wire_type(row: T.StructType, decimal_mode: str) -> T.StructType:
    """Type of a payload in the JSON: base64 decimals, binaries, dates, timestamps and sets are read as text first."""
    def wire(t):
        if isinstance(t, (T.BinaryType, *TEMPORAL)) or t == SET or (isinstance(t, T.DecimalType) and decimal_mode == "base64"):
            return T.StringType()
        return t
    return T.StructType([T.StructField(f.name, wire(f.dataType)) for f in row.fields])


def _temporal(value: Column, kind: T.DataType, unit: str) -> Column:
    """Days, or ``unit`` since the epoch, or text, as a date or timestamp."""
    number = F.when(value.rlike(r"^-?\d+$"), value.cast("bigint"))
    if isinstance(kind, T.DateType):
        return F.coalesce(temporal.decode_date(number), value.try_cast("date"))
    moment = temporal.decode_timestamp(number, unit)
    if isinstance(kind, T.TimestampNTZType):
        text = F.when(value.rlike(r"(Z|[+-]\d\d:?\d\d)$"), temporal.decode_zoned(value)).otherwise(value.try_cast("timestamp_ntz"))
        return F.when(number.isNotNull(), moment).otherwise(text)
    instant = {"millis": F.timestamp_millis, "micros": F.timestamp_micros}[unit](number)
    return F.when(number.isNotNull(), instant).otherwise(value.try_cast("timestamp"))


def _typed(image: Column, row: T.StructType, decimal_mode: str, units: dict[str, str]) -> Column:
    """Payload struct in its declared types."""
    fields = []
    for f in row.fields:
        value = image[f.name]
        if isinstance(f.dataType, T.BinaryType):
            value = F.unbase64(value)
        elif isinstance(f.dataType, TEMPORAL):
            value = _temporal(value, f.dataType, units.get(f.name, "micros"))
        elif units.get(f.name) == "time millis":
            value = value * 1000
        elif f.dataType == SET:
            value = F.when(value.startswith("["), F.from_json(value, "array<string>")).otherwise(set_to_array(value))
        elif isinstance(f.dataType, T.DecimalType) and decimal_mode == "base64":
            value = decimals.decode_decimal(value, f.dataType.precision, f.dataType.scale)
        fields.append(value.alias(f.name))
    return F.when(image.isNotNull(), F.struct(*fields))


def decode_envelope(raw: DataFrame, row_schema, key: list[str], column: str = "value",
                    decimal_mode: str = "native", position: Sequence[str] = POSITION,
                    units: dict[str, str] | None = None, wrapped: bool = False, wide: bool | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Envelope texts to change rows.

    ``position`` names the source's position fields (see ``position.of_source``); a change without them is an
    error, as its order would be unknown, and only snapshot rows (op ``r``) may lack them. Dates may be days,
    timestamps numbers since the epoch in the column's ``units`` (micros unless named), or text; sets may be arrays
    or comma-separated. Times of the day in ``time millis`` become microseconds. ``wrapped`` texts hold the envelope as
    their ``payload``. ``wide`` positions are texts that hold counters of up to 80 bits; unless given, they are used for
    several fields that are not a file and a place. ``keep`` names further text fields of the source, such as ``gtid``,
    that become columns behind the others.

    ``decimal_mode`` says how decimals are written: ``native`` and ``numeric`` as JSON numbers (read
    straight into the declared type, never through a double), ``base64`` as unscaled bytes.
    """
    row = _row_type(row_schema)
    wire = _wire_type(row, decimal_mode).simpleString()
    source = ",".join([SOURCE_FIELDS, *[f"{f}:string" for f in dict.fromkeys([*position, *keep])]])
    envelope = (f"struct<before:{wire},after:{wire},source:struct<{source}>,op:string,ts_ms:bigint>")
    if wrapped:
        envelope = f"struct<payload:{envelope}>"
    df = raw.withColumn("_e", F.from_json(column, envelope))
    return _change_rows(df, F.col("_e.payload") if wrapped else F.col("_e"), row, key, decimal_mode, list(position), units or {},
                        is_wide(position) if wide is None else wide, list(keep))


def _change_rows(df, e, row, key, decimal_mode, position, units, wide, keep=()):
    before, after = (_typed(e[side], row, decimal_mode, units) for side in ("before", "after"))
    df = df.select(e["source"].alias("_s"), e["op"].alias("op"), e["ts_ms"].alias("_ts"),
                   before.alias("before"), after.alias("after"))
    payload = F.coalesce("after", "before")
    # In a projection of its own, so that it is worked out once.
    df, at = df.withColumn("_at", of_source(F.col("_s"), position, wide)), F.col("_at")
    kind = "string" if wide else "bigint"
    missing = F.raise_error(F.lit(f"a change has no position in {position}")).cast(kind)
    at = F.when(at.isNotNull(), at).when((F.col("op") == "r") | F.col("op").isNull(), F.lit(0).cast(kind)).otherwise(missing)
    return df.select(
        F.col("_s.db").alias("db"), F.col("_s.schema").alias("schema"), F.col("_s.table").alias("table"),
        "op", at.alias("pos"),
        (F.coalesce("_s.row", F.lit(0)) * 2 + F.coalesce("_s.part", F.lit(0))).cast("int").alias("sub"),
        F.col("_s.ts_ms").alias("event_ts"), F.col("_ts").alias("fetch_ts"),
        F.struct(*[payload[k].alias(k) for k in key]).alias("key"), "before", "after", *[F.col(f"_s.{c}").alias(c) for c in keep])


# ---------------------------------------------------------------- embedded schema

# Wire type names of an embedded schema.
WIRE_TYPES = {
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "float": T.FloatType(), "float32": T.FloatType(), "double": T.DoubleType(),
    "float64": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(),
    "bytes": T.BinaryType(),
}


# Ends of the logical type names of an embedded schema, what they are, and their unit.
LOGICAL_TYPES = [
    ("time.Date", T.DateType(), None), ("data.Date", T.DateType(), None), ("time.MicroTimestamp", T.TimestampNTZType(), "micros"),
    ("time.Timestamp", T.TimestampNTZType(), "millis"), ("data.Timestamp", T.TimestampNTZType(), "millis"),
    ("time.MicroTime", T.LongType(), "time micros"),
    ("time.Time", T.LongType(), "time millis"), ("data.Time", T.LongType(), "time millis"),
    ("time.ZonedTimestamp", T.TimestampType(), None), ("data.EnumSet", SET, None),
]


def embedded_type(field: dict) -> T.DataType:
    """Spark type of one field of an embedded schema."""
    if field["type"] == "struct":
        return T.StructType([T.StructField(f["field"], embedded_type(f)) for f in field["fields"]])
    if field["type"] == "array":
        return T.ArrayType(embedded_type(field["items"]))
    if field["type"] == "map":
        return T.MapType(embedded_type(field["keys"]), embedded_type(field["values"]))
    if field.get("name", "").endswith("data.Decimal"):
        extra = field.get("parameters", {})
        return T.DecimalType(int(extra.get("connect.decimal.precision", 38)), int(extra.get("scale", 0)))
    logical = next((kind for end, kind, _ in LOGICAL_TYPES if field.get("name", "").endswith(end)), None)
    return logical or WIRE_TYPES[field["type"]]


# Numbers that hold all values of those before them.
_WIDER = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both on the wire: the wider number, text for what is written as text or as a
    number, decimals of one scale. None where there is none."""
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        return max(a, b, key=_WIDER.index)
    if {a, b} == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return T.DecimalType(max(a.precision, b.precision), a.scale)
    if T.StringType() in (a, b) and {a, b} <= {T.StringType(), T.BooleanType(), *_WIDER}:
        return T.StringType()
    return None


def embedded_row_type(*schema_jsons: str) -> tuple[T.StructType, dict[str, str]]:
    """(row type, timestamp units) of one or more embedded schemas of a table: the union of their columns, each of a type
    that holds all its values (``wider_type``). A change to a type that is written in another way is an error."""
    found, units = {}, {}
    for text in schema_jsons:
        after = next(f for f in json.loads(text)["fields"] if f["field"] == "after")
        for f in after["fields"]:
            name, kind = f["field"], embedded_type(f)
            unit = next((u for end, _, u in LOGICAL_TYPES if f.get("name", "").endswith(end)), None)
            wide = wider_type(found.setdefault(name, kind), kind)
            if wide is None:
                raise ValueError(f"column {name!r} is {found[name].simpleString()} in one schema and {kind.simpleString()} in another")
            if units.setdefault(name, unit) != unit:
                raise ValueError(f"column {name!r} is in {units[name] or 'no unit'} in one schema and in {unit or 'no unit'} in another")
            found[name] = wide
    return T.StructType([T.StructField(n, t) for n, t in found.items()]), {f: u for f, u in units.items() if u}


def _schema_or_head(column: str):
    """What tells the schema of an event: where the text begins with it, all before the payload, which is cheap to find;
    else the schema, by parsing the text."""
    text = F.col(column)
    ahead = text.startswith('{"schema":') & text.contains('"payload":')
    return F.when(ahead, F.substring_index(text, '"payload":', 1)).otherwise(F.get_json_object(text, "$.schema"))


def _schema_of(text: str) -> str | None:
    """The schema in what ``_schema_or_head`` gives; None where the head ends inside it."""
    if not text.startswith('{"schema":'):
        return text
    try:
        return json.dumps(json.loads(text.rstrip().removesuffix(",") + "}")["schema"])
    except ValueError:
        return None


def schema_samples(raw: DataFrame, column: str = "value") -> DataFrame:
    """The embedded schemas of each table: table, schema_json. Reduced map-side to the distinct texts."""
    text = F.col(column)
    return (raw.select(F.get_json_object(text, "$.payload.source.table").alias("table"),
                       F.get_json_object(text, "$.schema").alias("schema_json"))
            .where(F.col("schema_json").isNotNull()).distinct())


def decode_envelope_with_schema(raw: DataFrame, key: list[str], table: str | None = None,
                                schema_json: str | Sequence[str] | None = None, column: str = "value") -> DataFrame:
    """``{schema, payload}`` texts of one table, typed by the schema they carry.

    Schemas may differ from event to event: rows have the columns of all of them, of types that hold the values of all. The
    driver reads the distinct schemas, of which a table has one per change of its columns, unless the caller passes one.
    """
    rows = raw if table is None else raw.where(
        F.get_json_object(column, "$.payload.source.table") == table)
    schemas = [schema_json] if isinstance(schema_json, str) else schema_json
    if schemas is None:
        found = [_schema_of(r.s) for r in rows.select(_schema_or_head(column).alias("s")).where("s is not null").distinct().collect()]
        if None in found:
            found = [r.s for r in rows.select(F.get_json_object(column, "$.schema").alias("s")).where("s is not null").distinct().collect()]
        schemas = sorted(set(found))
        if not schemas:
            raise ValueError("no row to take a schema from; pass schema_json")
    row, units = embedded_row_type(*schemas)
    return decode_envelope(rows, row, key, column, "base64", units=units, wrapped=True)


def decode_tables_with_schema(raw: DataFrame, keys: dict[str, list[str]], column: str = "value") -> dict[str, DataFrame]:
    """One typed frame per table named in ``keys``. The driver sees each table's distinct schema texts."""
    found = {}
    for r in schema_samples(raw, column).where(F.col("table").isin(*keys)).sort("table", "schema_json").collect():
        found.setdefault(r.table, []).append(r.schema_json)
    return {t: decode_envelope_with_schema(raw, keys[t], t, schemas, column) for t, schemas in found.items()}


# ---------------------------------------------------------------- output

def wire_schema(row: T.StructType) -> dict:
    """The embedded-schema form of an envelope over ``row``."""
    names = {t: n for n, t in reversed(WIRE_TYPES.items())}

    def field(f):
        if isinstance(f.dataType, T.DecimalType):
            return {"type": "bytes", "optional": True, "field": f.name,
                    "name": "org.apache.kafka.connect.data.Decimal",
                    "parameters": {"scale": str(f.dataType.scale),
                                   "connect.decimal.precision": str(f.dataType.precision)}}
        logical = {T.DateType(): ("int32", "time.Date"), T.TimestampNTZType(): ("int64", "time.MicroTimestamp"), T.TimestampType(): ("string", "time.ZonedTimestamp")}
        if f.dataType in logical:
            kind, name = logical[f.dataType]
            return {"type": kind, "optional": True, "field": f.name, "name": name}
        return {**plain(f.dataType), "optional": True, "field": f.name}

    def plain(kind):
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": plain(kind.elementType)}
        if isinstance(kind, T.MapType):
            return {"type": "map", "keys": plain(kind.keyType), "values": plain(kind.valueType)}
        if isinstance(kind, T.StructType):
            return {"type": "struct", "fields": [field(f) for f in kind.fields]}
        return {"type": names[kind]}
    image = [field(f) for f in row.fields]
    return {"type": "struct", "optional": False, "fields": [
        {"type": "struct", "fields": image, "optional": True, "field": "before"},
        {"type": "struct", "fields": image, "optional": True, "field": "after"},
        {"type": "string", "optional": False, "field": "op"},
        {"type": "int64", "optional": True, "field": "ts_ms"}]}


def changes_to_json(df: DataFrame, with_schema: bool = False, decimal_mode: str = "native",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Change rows to one ``value`` text per event (plus the ``keep`` columns)."""
    row = df.schema["after"].dataType

    def image(side):
        fields = []
        for f in row.fields:
            value = F.col(side)[f.name]
            if isinstance(f.dataType, T.DecimalType) and decimal_mode == "base64":
                value = decimals.encode_decimal(value, f.dataType.scale)
            elif with_schema and isinstance(f.dataType, T.DateType):
                value = F.unix_date(value)
            elif with_schema and isinstance(f.dataType, T.TimestampNTZType):
                value = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), value).cast("timestamp"))
            elif with_schema and isinstance(f.dataType, T.TimestampType):
                value = F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
            fields.append(value.alias(f.name))
        return F.when(F.col(side).isNotNull(), F.struct(*fields)).alias(side)

    source = F.struct("db", "schema", "table", F.col("event_ts").alias("ts_ms"), "pos",
                      F.shiftright("sub", 1).alias("row"), (F.col("sub") % 2).alias("part")).alias("source")
    envelope = F.struct(image("before"), image("after"), source, "op",
                        F.col("fetch_ts").alias("ts_ms"))
    keep_null = {"ignoreNullFields": "false"}
    text = F.to_json(envelope, keep_null)
    if with_schema:
        head = json.dumps(wire_schema(row), separators=(",", ":"))
        text = F.concat(F.lit('{"schema":' + head + ',"payload":'), text, F.lit("}"))
    return df.select(*keep, text.alias("value"))
