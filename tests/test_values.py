"""Decoding of single values."""

import base64
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from changeloom.functions import decimals as D, documents as B, geometry as G, temporal as TM, text as X, typemap as M


def one(spark, *columns, sql="select 1 as one"):
    return tuple(spark.sql(sql).select(*columns).first())


def b64(n):
    return base64.b64encode(n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big", signed=True)).decode()


@pytest.mark.parametrize("precision, scale", [(6, 0), (8, 4), (18, 2), (18, 18), (20, 0), (30, 10), (36, 36), (38, 10), (38, 0), (65, 1)])
def test_decode_decimal(spark, precision, scale):
    rng = random.Random(precision)
    top = 10 ** precision - 1
    values = {0, 1, -1, top, -top, 127, 128, -128, -129, 255, -256} | {rng.randint(-top, top) for _ in range(40)}
    values = [v for v in values if abs(v) <= top]
    df = spark.createDataFrame([(b64(v), str(v)) for v in values], "b string, v string")
    for r in df.select("v", D.decode_decimal(F.col("b"), precision, scale).cast("string").alias("d")).collect():
        assert int(Decimal(r.d) * 10 ** scale if precision <= 20 else r.d.replace(".", "") if scale else r.d) == int(r.v)


def test_decimal_goldens(spark):
    got = one(spark, *[e.cast("string") for e in (
        D.decode_decimal(F.lit("AQ=="), 20, 0), D.unsigned_bigint(F.lit("AP//////////")), D.decode_decimal(F.lit("EtaH"), 8, 4),
        D.decode_decimal(F.lit("AVo="), 6, 0), D.decode_decimal(F.lit("FJqkSQ=="), 65, 1), D.decode_decimal(F.lit("/w=="), 38, 0),
        D.decode_decimal(F.lit(None).cast("string"), 8, 4))])
    assert got == ("1", "18446744073709551615", "123.4567", "346", "34567892.1", "-1", None)


def test_temporal_goldens(spark):
    text = [TM.decode_date(F.lit(18460)), TM.format_time(TM.decode_time(F.lit(64822000000)), 0),
            TM.format_time(F.lit(0), 3), TM.format_time(F.lit(TM.DAY_MICROS), 0),
            TM.decode_timestamp(F.lit(1595008822123)), TM.decode_timestamp(F.lit(1595008822123456), "micros"),
            TM.decode_zoned(F.lit("2020-07-17T18:00:22Z"), "Asia/Shanghai"),
            TM.to_local_datetime(F.lit("2020-07-17").cast("date"), "date"), TM.to_local_datetime(F.lit(64822000000), "time")]
    assert one(spark, *[t.cast("string") for t in text]) == (
        "2020-07-17", "18:00:22", "00:00:00.000", "00:00:00", "2020-07-17 18:00:22.123", "2020-07-17 18:00:22.123456",
        "2020-07-18 02:00:22", "2020-07-17 00:00:00", "1970-01-01 18:00:22")
    for bad in (-1, TM.DAY_MICROS + 1):
        with pytest.raises(Exception, match="time of day out of range"):
            one(spark, TM.decode_time(F.lit(bad).cast("bigint")))


def test_decoding_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, TM.decode_timestamp(F.lit(1595008822123)).cast("string"),
                  TM.decode_zoned(F.lit("2020-07-17T18:00:22Z"), "Asia/Shanghai").cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ("2020-07-17 18:00:22.123", "2020-07-18 02:00:22")


@pytest.mark.parametrize("text, kind, nullable, want", [
    ("0000-00-00", "date", True, None), ("0000-00-00", "date", False, "1970-01-01"), ("2020-00-10", "date", False, "1970-01-01"),
    ("2020-10-00 00:00:00", "date", False, "1970-01-01"), ("0", "date", False, "1970-01-01"), ("2020-10-11", "date", True, "2020-10-11"),
    ("0000-00-00 00:00:00.000", "timestamp", False, "1970-01-01 00:00:00"), ("0000-00-00 00:00:00", "timestamp", True, None),
    ("1970-01-01 00:00:00", "timestamp", True, "1970-01-01 00:00:00"), ("1970-01-01 00:00:00", "zoned", True, None),
    ("2020-2-3", "zoned", False, "2020-02-03 00:00:00"),
])
def test_zero_date(spark, text, kind, nullable, want):
    assert one(spark, TM.zero_date(F.lit(text), nullable, kind).cast("string")) == (want,)


@pytest.mark.parametrize("text, want", [
    ("2020-1-2", "2020-01-02 00:00:00"), ("2020/01/02", "2020-01-02 00:00:00"), ("2020-01-02 3", "2020-01-02 03:00:00"),
    ("2020-01-02T03:04", "2020-01-02 03:04:00"), ("2020.01.02 03-04-05", "2020-01-02 03:04:05"), ("  2020-01-02 03:04:05.67 ", "2020-01-02 03:04:05.67"),
    ("2020-13-02", None), ("2020-01-32", None), ("20200102", None), ("2020-01", None),
])
def test_clean_timestamp(spark, text, want):
    assert one(spark, TM.clean_timestamp(F.lit(text))) == (want,)


@pytest.mark.parametrize("text, want", [
    ("+02-06", 30 * 2629800000000), ("-00-01", -2629800000000), ("+05 10:20:30.123456", 469230123456), ("-1 00:00:00.5", -86400500000), ("soon", None)])
def test_intervals(spark, text, want):
    assert one(spark, TM.interval_to_long(F.lit(text))) == (want,)


def test_bits_and_booleans(spark):
    got = one(spark, F.hex(X.decode_bits(F.lit("1" * 9), 16)), F.hex(X.decode_bits(F.lit("101"), 3)), X.decode_bits(F.lit("1"), 1),
              X.to_boolean(F.lit("0")), X.to_boolean(F.lit("-3")), X.to_boolean(F.lit("TRUE")), X.to_boolean(F.lit("yes")),
              X.to_boolean(F.lit(None).cast("string")))
    assert got == ("01FF", "05", True, False, True, True, False, None)


def test_numbers(spark):
    got = one(spark, D.to_decimal(F.lit(" 12.345 "), 2).cast("string"), D.to_decimal(F.lit("-12.345"), 2).cast("string"),
              D.to_decimal(F.lit("nope"), 2), D.to_double(F.lit(" 1.5 ")))
    assert got == ("12.35", "-12.35", None, 1.5)


def test_sets_and_json(spark):
    got = one(spark, X.set_to_array(F.lit("a,b")), X.set_to_array(F.lit("")),
              X.json_text(F.lit('{"key1": "value1"}')) == X.json_text(F.lit('{"key1":"value1"}')), X.json_text(F.lit("{broken")))
    assert got == (["a", "b"], [], True, None)


SAMPLES = {"ascii": "ascii test!?", "big5": "大五碼", "gbk": "简体中文", "sjis": "ひびぴ", "cp932": "ひびぴ", "gb2312": "国家标准", "ujis": "日本語",
           "euckr": "죠주쥬", "latin1": "ÀÆÉ€„Ÿ", "latin2": "ÓÔŐÖ", "greek": "ΦΧΨΩ", "hebrew": "בבקשה", "cp866": "твой", "tis620": "ภาษาไทย",
           "cp1250": "ÓÔŐÖ", "cp1251": "твой", "cp1257": "piedzimst brīvi", "macroman": "ÀÆÉ", "macce": "ÓÔŐÖ", "utf8": "测试数据", "ucs2": "测试数据"}


def test_charsets(spark):
    for name, sample in SAMPLES.items():
        codec = X.TABLE_CHARSETS.get(name) or {"ucs2": "utf-16-be", "utf8": "utf-8", "latin1": "cp1252", "ascii": "ascii"}[name]
        df = spark.createDataFrame([(bytearray(sample.encode(codec)),), (None,)], "raw binary")
        got = [r[0] for r in df.select(X.decode_charset(F.col("raw"), name)).collect()]
        assert got == [sample, None], name


WKB = {
    "AQEAAAAAAAAAAADwPwAAAAAAAPA/": '{"coordinates":[1,1],"type":"Point","srid":0}',
    "AQIAAAADAAAAAAAAAAAACEAAAAAAAAAAAAAAAAAAAAhAAAAAAAAACEAAAAAAAAAIQAAAAAAAABRA": '{"coordinates":[[3,0],[3,3],[3,5]],"type":"LineString","srid":0}',
    "AQMAAAABAAAABQAAAAAAAAAAAPA/AAAAAAAA8D8AAAAAAAAAQAAAAAAAAPA/AAAAAAAAAEAAAAAAAAAAQAAAAAAAAPA/AAAAAAAAAEAAAAAAAADwPwAAAAAAAPA/":
        '{"coordinates":[[[1,1],[2,1],[2,2],[1,2],[1,1]]],"type":"Polygon","srid":0}',
    "AQQAAAACAAAAAQEAAAAAAAAAAADwPwAAAAAAAPA/AQEAAAAAAAAAAAAAQAAAAAAAAABA": '{"coordinates":[[1,1],[2,2]],"type":"MultiPoint","srid":0}',
    "AQUAAAACAAAAAQIAAAADAAAAAAAAAAAA8D8AAAAAAADwPwAAAAAAAABAAAAAAAAAAEAAAAAAAAAIQAAAAAAAAAhAAQIAAAACAAAAAAAAAAAAEEAAAAAAAAAQQAAAAAAAABRAAAAAAAAAFEA=":
        '{"coordinates":[[[1,1],[2,2],[3,3]],[[4,4],[5,5]]],"type":"MultiLineString","srid":0}',
    "AQcAAAADAAAAAQEAAAAAAAAAAAAkQAAAAAAAACRAAQEAAAAAAAAAAAA+QAAAAAAAAD5AAQIAAAACAAAAAAAAAAAALkAAAAAAAAAuQAAAAAAAADRAAAAAAAAANEA=":
        '{"geometries":[{"type":"Point","coordinates":[10,10]},{"type":"Point","coordinates":[30,30]},{"type":"LineString","coordinates":[[15,15],[20,20]]}],"type":"GeometryCollection","srid":0}',
}


def test_geometry(spark):
    df = spark.createDataFrame(list(WKB.items()), "wkb string, want string")
    for r in df.select("want", G.geometry_to_json(F.unbase64("wkb")).alias("got")).collect():
        assert r.got == r.want


FULL = """{"_id": {"$oid": "5d505646cf6d4fe581014ab2"}, "stringField": "hello", "dateField": {"$date": {"$numberLong": "1565546054692"}},
"before": {"$date": "1960-08-11T17:54:14.692Z"}, "stamp": {"$timestamp": {"t": 1565545664, "i": 1}}, "flag": true,
"dec": {"$numberDecimal": "10.99"}, "dbl": 10.5, "i": 10, "l": {"$numberLong": "50"}, "doc": {"a": "hello", "b": {"$numberLong": "50"}},
"map": {"inner_map": {"key": {"$numberLong": "234"}}}, "arr": ["hello", "world"], "nums": [1.0, 1.1, null],
"docs": [{"a": "hello0", "b": {"$numberLong": "51"}}, {"a": "hello1", "b": 53}], "re": {"$regularExpression": {"pattern": "^H", "options": "i"}},
"nothing": null, "bin": {"$binary": {"base64": "AQID", "subType": "00"}}, "ref": {"$ref": "ref_doc", "$id": {"$oid": "5d505646cf6d4fe581014ab3"}}}"""
FULL_SCHEMA = ("_id string, stringField string, dateField timestamp_ntz, before timestamp_ntz, stamp timestamp_ntz, flag boolean, dec decimal(5,2), "
               "dbl double, i int, l bigint, doc struct<a:string,b:bigint>, map map<string,map<string,bigint>>, arr array<string>, nums array<double>, "
               "docs array<struct<a:string,b:bigint>>, re string, nothing string, bin binary, ref struct<`$ref`:string,`$id`:string>, absent int")


def test_document_types(spark):
    row = one(spark, B.decode_bson_json(F.lit(FULL), FULL_SCHEMA, {"ref": "dbref"}))[0]
    assert (row._id, row.stringField, row.flag, row.dbl, row.i, row.l) == ("5d505646cf6d4fe581014ab2", "hello", True, 10.5, 10, 50)
    assert [str(row[c]) for c in ("dateField", "before", "stamp")] == ["2019-08-11 17:54:14.692000", "1960-08-11 17:54:14.692000", "2019-08-11 17:47:44"]
    assert row.dec == Decimal("10.99") and tuple(row.doc) == ("hello", 50) and row.map == {"inner_map": {"key": 234}}
    assert row.arr == ["hello", "world"] and row.nums == [1.0, 1.1, None] and [tuple(d) for d in row.docs] == [("hello0", 51), ("hello1", 53)]
    assert row.re == "^H" and row.nothing is None and bytes(row.bin) == b"\x01\x02\x03" and row.absent is None
    assert tuple(row.ref) == ("ref_doc", "5d505646cf6d4fe581014ab3")


@pytest.mark.parametrize("dialect, kind, want", [
    ("mysql", "TINYINT", "tinyint"), ("mysql", "tinyint(4) unsigned zerofill", "smallint"), ("mysql", "MEDIUMINT UNSIGNED", "bigint"),
    ("mysql", "SMALLINT UNSIGNED", "int"), ("mysql", "BIGINT UNSIGNED", "decimal(20,0)"), ("mysql", "SERIAL", "decimal(20,0)"),
    ("mysql", "FLOAT UNSIGNED", "float"), ("mysql", "REAL", "double"), ("mysql", "DOUBLE PRECISION UNSIGNED ZEROFILL", "double"),
    ("mysql", "DECIMAL(8, 4) UNSIGNED", "decimal(8,4)"), ("mysql", "DECIMAL(65, 1)", "string"), ("mysql", "FIXED(38,2)", "decimal(38,2)"),
    ("mysql", "TINYINT(1)", "boolean"), ("mysql", "BIT(1)", "boolean"), ("mysql", "BIT", "boolean"), ("mysql", "BIT(64)", "binary"), ("mysql", "DATETIME(3)", "timestamp_ntz"),
    ("mysql", "TIMESTAMP", "timestamp_ntz"), ("mysql", "TIME(3)", "bigint"), ("mysql", "ENUM('red','white')", "string"), ("mysql", "SET('a','b')", "array<string>"),
    ("mysql", "YEAR", "int"), ("mysql", "LONGBLOB", "binary"), ("mysql", "MEDIUMTEXT", "string"), ("mysql", "JSON", "string"), ("mysql", "POINT", "string"),
    ("tidb", "TIMESTAMP(3)", "timestamp"), ("tidb", "DATETIME", "timestamp_ntz"), ("tidb", "REAL", "double"),
    ("oceanbase", "TIMESTAMP", "timestamp"), ("oceanbase", "REAL", "float"), ("oceanbase", "BIT(9)", "binary"),
    ("postgres", "SMALLSERIAL", "smallint"), ("postgres", "SERIAL", "int"), ("postgres", "NUMERIC(10, 5)", "decimal(10,5)"), ("postgres", "BYTEA", "binary"),
    ("postgres", "TIMESTAMP(3) WITHOUT TIME ZONE", "timestamp_ntz"), ("postgres", "CHARACTER VARYING(20)", "string"),
    ("oracle", "NUMBER(1)", "boolean"), ("oracle", "NUMBER(2)", "tinyint"), ("oracle", "NUMBER(4)", "smallint"), ("oracle", "NUMBER(9)", "int"),
    ("oracle", "NUMBER(8, -1)", "int"), ("oracle", "NUMBER(18)", "bigint"), ("oracle", "NUMBER(20)", "decimal(20,0)"), ("oracle", "NUMBER(38, -2)", "string"),
    ("oracle", "NUMBER(10, 2)", "decimal(10,2)"), ("oracle", "DATE", "timestamp_ntz"), ("oracle", "TIMESTAMP(6) WITH LOCAL TIME ZONE", "timestamp"),
    ("oracle", "INTERVAL DAY(3) TO SECOND(2)", "bigint"), ("oracle", "ROWID", "binary"), ("oracle", "NVARCHAR2(30)", "string"),
    ("sqlserver", "tinyint", "smallint"), ("sqlserver", "real", "double"), ("sqlserver", "money", "decimal(19,4)"), ("sqlserver", "datetimeoffset(7)", "timestamp"),
    ("sqlserver", "varchar(max)", "string"), ("sqlserver", "bit", "boolean"), ("db2", "REAL", "float"), ("db2", "CLOB", "binary"), ("db2", "VARGRAPHIC(10)", "string"),
    ("mongodb", "ObjectId", "string"), ("mongodb", "Decimal128(5, 2)", "decimal(5,2)"), ("mongodb", "BinData", "binary"),
])
def test_type_map(dialect, kind, want):
    assert M.spark_type(dialect, kind) == want


def test_unknown_type_is_an_error():
    with pytest.raises(ValueError):
        M.spark_type("db2", "BOOLEAN")


def test_bad_values_become_null_and_are_counted(spark):
    df = spark.createDataFrame([("1", "2020-01-02", "12:30:00.5"), ("x", "2020-13-02", "25:00:00"), (None, None, None), ("300", "0000-00-00", "00:00:00")],
                               "a string, b string, c string")
    got = M.cast_from_source(df, "mysql", {"a": "TINYINT", "b": "DATE", "c": "TIME(3)"}, "bad").collect()
    assert [(r.a, r.c, r.bad) for r in got] == [(1, 45000500000, 0), (None, None, 3), (None, None, 0), (None, 0, 2)]
    assert got[0].b.isoformat() == "2020-01-02" and got[3].b is None


def test_defaults_only_fill_absent_columns(spark):
    df = spark.createDataFrame([("1", None, ["a", "b"]), (None, None, ["a"])], "a string, b string, present array<string>")
    got = M.apply_defaults(df, {"a": ("mysql", "INT", "7"), "b": ("mysql", "INT", " 8 "), "c": ("mysql", "INT", None)}, F.col("present")).collect()
    assert [(r.a, r.b, r.c) for r in got] == [(1, None, None), (None, 8, None)]


def test_numbers_without_a_precision_keep_their_fraction(spark):
    for dialect, kind in (("postgres", "NUMERIC"), ("postgres", "DECIMAL"), ("oracle", "NUMBER")):
        assert M.spark_type(dialect, kind) == "string"
    assert M.spark_type("mysql", "DECIMAL") == "decimal(38,0)" and M.spark_type("oracle", "NUMBER(10, 2)") == "decimal(10,2)"
    assert one(spark, D.to_decimal(F.lit(" 12345678901234567890123.5 ")), D.to_decimal(F.lit("nope"))) == ("12345678901234567890123.5", None)


@pytest.mark.parametrize("kind, text, nullable, want", [
    ("DATE", "0000-00-00", False, "1970-01-01"), ("DATE", "0000-00-00", True, None), ("DATETIME", "0", False, "1970-01-01 00:00:00"),
    ("TIMESTAMP", "2024.5.6 10", True, "2024-05-06 10:00:00"), ("TINYINT", "true", True, "1"), ("TINYINT(1)", "true", True, "true"), ("INT", "7", True, "7")])
def test_defaults_follow_the_rules_of_their_type(spark, kind, text, nullable, want):
    assert one(spark, M.default_expression(F.lit(text), "mysql", kind, nullable).cast("string")) == (want,)


def test_wide_decimals_encode_and_decode(spark):
    values = ["0", "-1", "99999999999999999999999999999999999999", "-99999999999999999999999999999999999999", "18446744073709551616", "-18446744073709551615", "9223372036854775808"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", D.decode_decimal(D.encode_decimal(F.col("v").cast("decimal(38,0)"), 0), 38, 0).cast("string").alias("w"))
    assert all(r.v == r.w for r in out.collect())
