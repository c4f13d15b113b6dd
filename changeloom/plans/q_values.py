"""Queries over value normalisation. Each writes table columns in a vendor's spelling and reads them back."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import decimals as D, documents as B, geometry as G, temporal as T, text as X, typemap as M
from . import orders_log as O
from .log_sql import IMG
from .registry import query

IMAGES = f"WITH {IMG}"


def _bytes64(n):
    """Base64 of the eight big-endian bytes of a bigint."""
    return F.base64(F.unhex(F.lpad(F.hex(n), 16, "0")))


def _clock(ts):
    """Microseconds of the day of a timestamp without zone."""
    return F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(T.DAY_MICROS))


_TYPED = """SELECT e.event_id, CAST(e.event_id % 120 AS INT) AS small, e.user_id * 1000003 AS big, CAST(e.value AS DOUBLE) AS dbl,
CAST(CAST(e.event_id AS VARCHAR) || '.' || lpad(CAST(e.user_id % 100 AS VARCHAR), 2, '0') AS VARCHAR) AS amount,
CAST(e.event_id % 2 AS INT) AS flag, strftime(e.ts, '%Y-%m-%d') AS day, strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS moment,
e.event_type AS txt, CASE WHEN e.event_id % 10 = 0 THEN 1 ELSE 0 END AS bad FROM events e"""

# Vendor type of each logical column, per dialect.
DIALECT_COLUMNS = {
    "mysql": ("TINYINT", "BIGINT", "DOUBLE PRECISION", "DECIMAL(20, 2)", "TINYINT(1)", "DATE", "DATETIME(6)", "VARCHAR(20)"),
    "tidb": ("TINYINT", "BIGINT", "DOUBLE", "NUMERIC(20, 2)", "BOOLEAN", "DATE", "DATETIME(6)", "VARCHAR(20)"),
    "oceanbase": ("TINYINT", "BIGINT", "DOUBLE", "DECIMAL(20, 2)", "BIT(1)", "DATE", "DATETIME(6)", "VARCHAR(20)"),
    "postgres": ("SMALLINT", "BIGSERIAL", "FLOAT8", "NUMERIC(20, 2)", "BOOLEAN", "DATE", "TIMESTAMP(6)", "CHARACTER VARYING(20)"),
    "oracle": ("NUMBER(3)", "NUMBER(18)", "BINARY_DOUBLE", "NUMBER(20, 2)", "NUMBER(1)", None, "TIMESTAMP(6)", "VARCHAR2(20)"),
    "sqlserver": ("tinyint", "bigint", "float", "decimal(20, 2)", "bit", "date", "datetime2(7)", "nvarchar(20)"),
    "db2": ("SMALLINT", "BIGINT", "DOUBLE", "DECIMAL(20, 2)", None, "DATE", "TIMESTAMP(6)", "VARCHAR(20)"),
    "mongodb": ("Int", "Long", "Double", "Decimal128(20, 2)", "Boolean", None, "Timestamp", "String"),
}
LOGICAL = ("small", "big", "dbl", "amount", "flag", "day", "moment", "txt")


def _raw_events(spark, sf):
    """Events with every column as the text a vendor would write; each tenth ``day`` is impossible."""
    e = O.read(spark, sf, "events")
    i = F.col("event_id")
    return e.select(
        "event_id", (i % 120).cast("string").alias("small"), (F.col("user_id") * 1000003).cast("string").alias("big"),
        F.col("value").cast("string").alias("dbl"),
        F.concat(i.cast("string"), F.lit("."), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0")).alias("amount"),
        F.when(i % 4 == 1, "true").when(i % 4 == 2, "false").otherwise((i % 2).cast("string")).alias("flag"),
        F.when(i % 10 == 0, "2024-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"), F.col("event_type").alias("txt"))


def _typed_query(dialect):
    kinds = dict(zip(LOGICAL, DIALECT_COLUMNS[dialect]))
    given = {c: t for c, t in kinds.items() if t}

    def run(spark, sf):
        df = M.cast_from_source(_raw_events(spark, sf), dialect, given, "bad")
        shown = {"small": F.col("small").cast("int"), "big": F.col("big").cast("bigint"), "dbl": F.col("dbl"),
                 "amount": F.col("amount").cast("string"), "flag": F.col("flag").cast("int"),
                 "day": F.col("day").cast("string"),
                 "moment": F.date_format("moment", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "txt": F.col("txt")}
        return df.select("event_id", *[e.alias(c) for c, e in shown.items() if c in given], "bad")

    cols = ", ".join(c if c != "day" else "CASE WHEN bad = 1 THEN NULL ELSE day END AS day" for c in given)
    bad = "bad" if "day" in given else "0 AS bad"
    return run, f"SELECT event_id, {cols}, {bad} FROM ({_TYPED})"


for _dialect in DIALECT_COLUMNS:
    _run, _sql = _typed_query(_dialect)
    query(f"t1_cast_from_{_dialect}", _sql)(_run)


@query("t2_decode_decimal", f"""{IMAGES} SELECT k, cents - 30000000 AS unscaled,
CASE WHEN cents < 30000000 THEN '-' ELSE '' END || CAST(abs(cents - 30000000) // 100 AS VARCHAR) || '.' || lpad(CAST(abs(cents - 30000000) % 100 AS VARCHAR), 2, '0') AS amount,
CASE WHEN cents < 30000000 THEN '-' ELSE '' END || CAST(abs(cents - 30000000) // 10 AS VARCHAR) || '.' || CAST(abs(cents - 30000000) % 10 AS VARCHAR) AS wide FROM img""")
def t2(spark, sf):
    n = F.col("cents") - 30_000_000
    df = O.order_images(spark, sf).withColumn("b64", _bytes64(n))
    return df.select("k", D.decode_decimal(F.col("b64"), 20, 0).cast("bigint").alias("unscaled"),
                     D.decode_decimal(F.col("b64"), 12, 2).cast("string").alias("amount"),
                     D.decode_decimal(F.col("b64"), 65, 1).alias("wide"))


@query("t3_decode_date", "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def t3(spark, sf):
    df = O.read(spark, sf, "orders").select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("d"))
    return df.select(F.col("o_orderkey").alias("k"), T.decode_date(F.col("d")).cast("string").alias("day"))


@query("t4_decode_time", "SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS clock, strftime(ts, '%H:%M:%S') AS seconds FROM events")
def t4(spark, sf):
    t = T.decode_time(_clock(F.col("ts")))
    return O.read(spark, sf, "events").select("event_id", T.format_time(t).alias("clock"), T.format_time(t, 0).alias("seconds"))


@query("t5_decode_timestamp", """SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS millis,
strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS micros FROM events""")
def t5(spark, sf):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    form = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return O.read(spark, sf, "events").select(
        "event_id", F.date_format(T.decode_timestamp(F.expr("unix_millis(cast(ts as timestamp))")), form).alias("millis"),
        F.date_format(T.decode_timestamp(micros, "micros"), form).alias("micros"))


@query("t6_decode_zoned", "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS wall FROM events")
def t6(spark, sf):
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return O.read(spark, sf, "events").select(
        "event_id", F.date_format(T.decode_zoned(raw, "Asia/Shanghai"), "yyyy-MM-dd HH:mm:ss").alias("wall"))


@query("t7_to_local_datetime", """SELECT event_id, strftime(ts, '%Y-%m-%d') || ' 00:00:00.000000' AS from_date,
'1970-01-01 ' || strftime(ts, '%H:%M:%S.%f') AS from_time, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS from_instant FROM events""")
def t7(spark, sf):
    form = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    kinds = {"date": F.col("ts").cast("date"), "time": _clock(F.col("ts")), "instant": F.expr("unix_millis(cast(ts as timestamp))")}
    return O.read(spark, sf, "events").select(
        "event_id", *[F.date_format(T.to_local_datetime(c, k), form).alias(f"from_{k}") for k, c in kinds.items()])


_ZERO = "CASE event_id % 5 WHEN 0 THEN '0000-00-00' WHEN 1 THEN '2024-00-17' WHEN 2 THEN '0' ELSE strftime(ts, '%Y-%m-%d') END"


@query("t8_zero_date", f"""WITH z AS (SELECT event_id, {_ZERO} AS d, event_id % 5 < 3 AS zero FROM events)
SELECT event_id, CASE WHEN NOT zero THEN d END AS nullable_day, CASE WHEN zero THEN '1970-01-01' ELSE d END AS strict_day,
CASE WHEN event_id % 5 = 2 OR event_id % 5 = 4 THEN '1970-01-01 00:00:00' WHEN event_id % 5 = 3 THEN d || ' 00:00:00' ELSE '1970-01-01 00:00:00' END AS strict_zoned FROM z""")
def t8(spark, sf):
    i = F.col("event_id") % 5
    day = F.date_format("ts", "yyyy-MM-dd")
    raw = F.when(i == 0, "0000-00-00").when(i == 1, "2024-00-17").when(i == 2, "0").otherwise(day)
    zoned = (F.when(i == 2, "0").when(i == 4, "1970-01-01 00:00:00").when(i == 3, day)
             .otherwise(F.concat(raw, F.lit(" 00:00:00.000"))))
    return O.read(spark, sf, "events").select(
        "event_id", T.zero_date(raw, True).cast("string").alias("nullable_day"),
        T.zero_date(raw, False).cast("string").alias("strict_day"),
        F.date_format(T.zero_date(zoned, False, "zoned"), "yyyy-MM-dd HH:mm:ss").alias("strict_zoned"))


@query("t9_clean_timestamp", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00' WHEN 1 THEN strftime(ts, '%Y-%m-%d %H') || ':00:00'
WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS clean FROM events""")
def t9(spark, sf):
    i = F.col("event_id") % 5
    forms = ["yyyy/M/d", "yyyy.MM.dd'T'HH", "yyyy/MM/dd  H-m-s", "yyyy-MM-dd HH:mm:ss.SSSSSS"]
    raw = F.when(i == 4, "2024-13-01 10:00")
    for n, form in enumerate(forms):
        raw = raw.when(i == n, F.date_format("ts", form))
    return O.read(spark, sf, "events").select("event_id", T.clean_timestamp(raw).alias("clean"))


@query("t10_decode_bits", f"{IMAGES} SELECT k, lpad(to_hex(cents), 8, '0') AS bits, CAST(k % 2 AS INT) AS bit FROM img")
def t10(spark, sf):
    return O.order_images(spark, sf).select(
        "k", F.hex(X.decode_bits(F.bin("cents"), 32)).alias("bits"),
        X.decode_bits((F.col("k") % 2).cast("string"), 1).cast("int").alias("bit"))


@query("t11_to_boolean", "SELECT event_id, CASE WHEN event_id % 6 IN (1, 2, 4) THEN 1 WHEN event_id % 6 = 5 THEN NULL ELSE 0 END AS flag FROM events")
def t11(spark, sf):
    i = F.col("event_id") % 6
    raw = F.when(i == 0, "0").when(i == 1, "7").when(i == 2, "TRUE").when(i == 3, "no").when(i == 4, "-1")
    return O.read(spark, sf, "events").select("event_id", X.to_boolean(raw).cast("int").alias("flag"))


@query("t12_to_decimal", f"""{IMAGES} SELECT k, CAST((cents + 5) // 10 // 10 AS VARCHAR) || '.' || CAST((cents + 5) // 10 % 10 AS VARCHAR) AS rounded, CAST(cents AS DOUBLE) / 100 AS dbl FROM img""")
def t12(spark, sf):
    raw = F.concat(F.lit("  "), F.expr("cast(cents div 100 as string)"), F.lit("."),
                   F.lpad((F.col("cents") % 100).cast("string"), 2, "0"), F.lit(" "))
    return O.order_images(spark, sf).select("k", D.to_decimal(raw, 1).cast("string").alias("rounded"), D.to_double(raw).alias("dbl"))


@query("t13_apply_defaults", """SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN NULL ELSE 42 END AS qty,
CASE WHEN o_orderkey % 3 = 2 THEN '1970-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, 'none' AS note FROM orders""")
def t13(spark, sf):
    i = F.col("o_orderkey") % 3
    # Carried and set, carried as null, not carried at all.
    raw = O.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.when(i == 0, F.col("o_custkey").cast("string")).alias("qty"),
        F.when(i != 2, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(i == 2, F.array(F.lit("k"))).otherwise(F.array(F.lit("k"), F.lit("qty"), F.lit("day"))).alias("present"))
    defaults = {"qty": ("mysql", "BIGINT", " 42 "), "day": ("mysql", "DATE", "1970-01-01"), "note": ("mysql", "VARCHAR(8)", "none")}
    df = M.apply_defaults(raw, defaults, F.col("present"))
    return df.select("k", "qty", F.col("day").cast("string").alias("day"), "note")


@query("t14_set_to_array", """SELECT p_partkey, len(string_split(p_name, ' ')) AS members, string_split(p_name, ' ')[1] AS first, p_type AS enum_text FROM part""")
def t14(spark, sf):
    members = X.set_to_array(F.translate("p_name", " ", ","))
    return O.read(spark, sf, "part").select("p_partkey", F.size(members).cast("bigint").alias("members"),
                                            members[0].alias("first"), F.col("p_type").alias("enum_text"))


@query("t15_unsigned_bigint", f"{IMAGES} SELECT k, CAST(CAST(cents AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS value FROM img")
def t15(spark, sf):
    # The signed minimum plus cents has the bits of 2^63 + cents; a zero byte in front makes it unsigned.
    bits = F.expr("cents + (-9223372036854775807 - 1)")
    b64 = F.base64(F.unhex(F.concat(F.lit("00"), F.hex(bits))))
    return O.order_images(spark, sf).select("k", D.unsigned_bigint(b64).cast("string").alias("value"))


CHARSETS = {"utf8": "utf-8", "ucs2": "utf-16-be", "gb18030": "gb18030"}


@query("t16_decode_charset", "SELECT doc_id, md5(text) AS utf8, md5(text) AS ucs2, md5(text) AS gb18030 FROM documents")
def t16(spark, sf):
    def encoder(codec):
        @F.pandas_udf("binary")
        def encode(values: pd.Series) -> pd.Series:
            return values.map(lambda t: t.encode(codec))
        return encode
    docs = O.read(spark, sf, "documents")
    return docs.select("doc_id", *[F.md5(X.decode_charset(encoder(codec)("text"), cs)).alias(cs) for cs, codec in CHARSETS.items()])


@F.pandas_udf(BinaryType())
def _line(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
    return pd.Series([struct.pack("<BII4d", 1, 2, 2, a, b, c, a) for a, b, c in zip(x, y, z)])


@F.pandas_udf(BinaryType())
def _point(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([struct.pack(">BI2d", 0, 1, a, b) for a, b in zip(x, y)])


@query("t17_geometry_to_json", """SELECT o_orderkey AS k, '{"coordinates":[' || o_orderkey || ',' || (o_custkey // 2) || CASE WHEN o_custkey % 2 = 1 THEN '.5' ELSE '' END || '],"type":"Point","srid":4326}' AS point,
'{"coordinates":[[' || o_orderkey || ',' || o_custkey || '],[7,' || o_orderkey || ']],"type":"LineString","srid":0}' AS line FROM orders""")
def t17(spark, sf):
    k, cust = F.col("o_orderkey").cast("double"), F.col("o_custkey").cast("double")
    return O.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), G.geometry_to_json(_point(k, cust / 2), F.lit(4326)).alias("point"),
        G.geometry_to_json(_line(k, cust, F.lit(7.0))).alias("line"))


@query("t18_decode_bson_json", """SELECT lpad(lower(to_hex(event_id)), 24, '0') AS id, user_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS at,
strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS stamp, CAST(event_id AS VARCHAR) || '.25' AS price, event_type AS kind,
event_id % 2 AS flag, CAST(user_id AS BIGINT) AS first, 'users' AS ref FROM events""")
def t18(spark, sf):
    e = O.read(spark, sf, "events")
    oid = F.lpad(F.lower(F.hex("event_id")), 24, "0")

    def wrap(name, value):
        return F.struct(value.cast("string").alias(name))
    millis = F.expr("unix_millis(cast(ts as timestamp))")
    doc = F.to_json(F.struct(
        wrap("$oid", oid).alias("_id"), wrap("$numberLong", F.col("user_id")).alias("user"),
        F.struct(wrap("$numberLong", millis).alias("$date")).alias("at"),
        F.struct(F.struct(F.expr("millis_s").alias("t"), F.lit(1).alias("i")).alias("$timestamp")).alias("stamp"),
        F.struct(wrap("$numberDecimal", F.concat(F.col("event_id").cast("string"), F.lit(".25"))).alias("price"),
                 F.col("event_type").alias("kind")).alias("item"),
        (F.col("event_id") % 2 == 1).alias("flag"),
        F.array(wrap("$numberInt", F.col("user_id")), wrap("$numberInt", F.lit(5))).alias("list"),
        F.struct(F.lit("users").alias("$ref"), wrap("$oid", oid).alias("$id")).alias("owner")))
    df = e.withColumn("millis_s", F.expr("unix_seconds(cast(ts as timestamp))")).select(F.try_parse_json(doc).alias("doc"))
    schema = ("_id string, user bigint, at timestamp_ntz, stamp timestamp_ntz, item struct<price:decimal(20,2),kind:string>, "
              "flag boolean, list array<int>, owner struct<`$ref`:string,`$id`:string>")
    df = df.select(B.decode_document(F.col("doc"), schema, {"owner": "dbref"}).alias("d"))
    return df.select(F.col("d._id").alias("id"), F.col("d.user").alias("user_id"),
                     F.date_format("d.at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
                     F.date_format("d.stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                     F.col("d.item.price").cast("string").alias("price"), F.col("d.item.kind").alias("kind"),
                     F.col("d.flag").cast("bigint").alias("flag"), F.col("d.list")[0].cast("bigint").alias("first"),
                     F.col("d.owner.$ref").alias("ref"))


@query("t19_interval_to_long", """SELECT event_id, -(CAST(user_id AS BIGINT) * 12 + event_id % 12) * 2629800000000 AS months,
(user_id * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * 1000000 + microsecond(ts) % 1000000 AS micros FROM events""")
def t19(spark, sf):
    months = F.format_string("-%02d-%02d", F.col("user_id"), F.col("event_id") % 12)
    span = F.concat(F.format_string("+%02d ", F.col("user_id")), F.date_format("ts", "HH:mm:ss.SSSSSS"))
    return O.read(spark, sf, "events").select("event_id", T.interval_to_long(months).alias("months"),
                                              T.interval_to_long(span).alias("micros"))


@query("t21_json_text", "SELECT event_id, 1 AS same, replace(props, ' ', '') AS text FROM events")
def t21(spark, sf):
    one, other = X.json_text(F.col("props")), X.json_text(F.translate("props", " ", ""))
    return O.read(spark, sf, "events").select("event_id", (one == other).cast("int").alias("same"), one.alias("text"))
