"""Queries over sources: snapshots, logs, capture, envelopes, document and key/value logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changelog as L, chunks as C
from ..operators.progress import commit_progress
from ..session import scratch_dir
from ..sources import capture, changestream, envelope, keyvalue, log as logs, snapshot as snaps
from ..streaming import streams
from . import orders_log as O
from .common import FLAT, everything, finish, flat, log_directory, split_log
from .log_sql import BASE
from .registry import query

ALL_RAW = f"SELECT {FLAT} FROM snap UNION ALL SELECT {FLAT} FROM rawlog"


@query("s1_decode_envelope", f"{BASE} SELECT *, pos + 1700000000000 AS event_ts FROM ({ALL_RAW})")
def s1(spark, sf):
    texts = envelope.changes_to_json(O.orders_changes(spark, sf))
    return flat(envelope.decode_envelope(texts, O.IMAGE[7:-1], ["k"]), "event_ts")


def _priced(spark, sf):
    """The log with the money column as an exact decimal."""
    def image(side):
        s = F.col(side)
        return F.when(s.isNotNull(), F.struct(
            s["k"].alias("k"), s["st"].alias("st"),
            (s["cents"].cast("decimal(18,0)") / 100).cast("decimal(20,2)").alias("price")))
    return O.orders_changes(spark, sf).withColumns({"before": image("before"), "after": image("after")})


def _prices(df):
    return df.select("op", "pos", F.col("key.k").alias("k"), F.col("before.price").cast("string").alias("bprice"),
                     F.col("after.price").cast("string").alias("aprice"), F.col("after.st").alias("ast"))


_MONEY = "CAST({0} // 100 AS VARCHAR) || '.' || lpad(CAST({0} % 100 AS VARCHAR), 2, '0')"
_PRICES = f"""{BASE} SELECT op, pos, k, {_MONEY.format('bcents')} AS bprice, {_MONEY.format('acents')} AS aprice, ast
FROM ({ALL_RAW})"""


@query("s2_decode_envelope_with_schema", _PRICES)
def s2(spark, sf):
    texts = envelope.changes_to_json(_priced(spark, sf), with_schema=True, decimal_mode="base64")
    return _prices(envelope.decode_envelope_with_schema(texts, ["k"]))


@query("s3_decimal_base64", _PRICES)
def s3(spark, sf):
    texts = envelope.changes_to_json(_priced(spark, sf), decimal_mode="base64")
    return _prices(envelope.decode_envelope(texts, "k bigint, st string, price decimal(20,2)", ["k"],
                                            decimal_mode="base64"))


@query("s3_decimal_numeric", _PRICES)
def s3n(spark, sf):
    texts = envelope.changes_to_json(_priced(spark, sf))
    return _prices(envelope.decode_envelope(texts, "k bigint, st string, price decimal(20,2)", ["k"],
                                            decimal_mode="numeric"))


@query("s4_scan_snapshot", """SELECT 'shop' AS db, 'customer' AS tbl, 'r' AS op, CAST(0 AS BIGINT) AS pos,
c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer""")
def s4(spark, sf):
    df = snaps.scan_snapshot(O.read(spark, sf, "customer"), ["c_custkey"], "shop", "customer")
    return df.select("db", F.col("table").alias("tbl"), "op", "pos", F.col("key.c_custkey").alias("k"),
                     F.col("after.c_name").alias("name"), F.col("after.c_mktsegment").alias("segment"))


@query("s5_scan_snapshot_chunks", """WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi, count(*) AS n FROM lineitem),
p AS (SELECT lo, hi, n, CAST(greatest(floor(CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 * 8096), 1) AS BIGINT) AS step FROM b),
c AS (SELECT l_orderkey, CASE WHEN n <= 8096 THEN 0 ELSE (l_orderkey - lo) // step END AS chunk_id FROM lineitem, p)
SELECT chunk_id, count(*) AS row_count, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM c GROUP BY chunk_id""")
def s5(spark, sf):
    rows = O.read(spark, sf, "lineitem")
    plan = C.plan_chunks(rows, ["l_orderkey", "l_linenumber"])
    return (snaps.scan_snapshot_chunks(rows, plan).groupBy("chunk_id")
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("l_orderkey").alias("min_key"),
                 F.max("l_orderkey").alias("max_key")))


@query("s6_read_log", f"{BASE} SELECT 'table' AS via, {FLAT} FROM rawlog UNION ALL SELECT 'stream' AS via, {FLAT} FROM rawlog")
def s6(spark, sf):
    from .common import finish
    rows = O.orders_changes(spark, sf, snapshot=False)
    path, out, state = log_directory(spark, rows), scratch_dir(spark, "out"), scratch_dir(spark, "state")
    stream = logs.read_log(spark, path, rows.schema, stream=True, files_per_trigger=8)
    finish(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
           .trigger(availableNow=True).start())
    table = flat(logs.read_log(spark, path, rows.schema)).withColumn("via", F.lit("table"))
    streamed = flat(spark.read.schema(rows.schema).parquet(out)).withColumn("via", F.lit("stream"))
    return table.unionByName(streamed)


_SHARDED = f"""{BASE}, sharded AS (SELECT *, 'db_' || (coalesce(acust, bcust) % 2) AS db,
'orders_' || (coalesce(acust, bcust) // 2 % 2) AS tbl FROM ({ALL_RAW}))"""


@query("s7_capture_tables", f"{_SHARDED} SELECT db, tbl, op, pos, k FROM sharded WHERE db = 'db_1' OR tbl = 'orders_9'")
def s7(spark, sf):
    df = capture.capture_tables(O.sharded_changes(spark, sf), ["db_1", "b_0|d", "shard-[a-f]+"], ["orders_[0-1]"])
    return df.select("db", F.col("table").alias("tbl"), "op", "pos", F.col("key.k").alias("k"))


@query("s8_capture_table_list", f"""{_SHARDED} SELECT db, tbl, op, pos, k FROM sharded
WHERE (db = 'db_0' AND tbl = 'orders_1') OR (db = 'db_1' AND tbl = 'orders_0')""")
def s8(spark, sf):
    df = capture.capture_tables(O.sharded_changes(spark, sf), ["db_0"], [".*_1"], ["db_1.orders_0"])
    return df.select("db", F.col("table").alias("tbl"), "op", "pos", F.col("key.k").alias("k"))


@query("s9_merge_shards", f"""{BASE} SELECT 'db_' || (cust % 2) AS database_name, 'orders_' || (cust // 2 % 2) AS table_name, k, cust,
CASE WHEN cust % 4 = 0 THEN NULL ELSE st END AS st, CASE WHEN cust % 4 = 3 THEN cents END AS cents FROM img""")
def s9(spark, sf):
    images = O.order_images(spark, sf)
    parts = [["k", "cust"], ["k", "cust", "st"], ["k", "cust", "st"], ["k", "cust", "st", "cents"]]
    shards = [images.where(F.col("cust") % 4 == i).select(
        F.lit(f"db_{i % 2}").alias("database_name"), F.lit(f"orders_{i // 2}").alias("table_name"), *cols)
        for i, cols in enumerate(parts)]
    return snaps.merge_shards(*shards)


@query("s10_with_metadata", f"""{_SHARDED} SELECT k, pos, db AS database_name, 'public' AS schema_name, tbl AS table_name,
tbl AS collection_name, db AS tenant_name, CASE WHEN op = 'r' THEN 0 ELSE pos + 1700000000000 END AS op_ts FROM sharded""")
def s10(spark, sf):
    names = list(capture.METADATA)
    df = capture.with_metadata(O.sharded_changes(spark, sf), names)
    return df.select(F.col("key.k").alias("k"), "pos", *names)


_MODE = "SELECT '{0}' AS mode, op, pos, sub, k FROM allrows WHERE {1}"
_MODES = {"initial": "true", "initial-only": "op = 'r'", "earliest-offset": "op <> 'r'",
          "latest-offset": "op <> 'r' AND pos > 250000000", "specific-offset": "op <> 'r' AND pos >= 200000500",
          "timestamp": "op <> 'r' AND pos >= 300000000"}


@query("s11_start_from", f"{BASE}, allrows AS (SELECT * FROM snap UNION ALL SELECT * FROM log) "
       + " UNION ALL ".join(_MODE.format(m, w) for m, w in _MODES.items()))
def s11(spark, sf):
    rows = everything(spark, sf)
    given = {"latest-offset": {"now_pos": 250_000_000}, "specific-offset": {"offset": 200_000_500},
             "timestamp": {"timestamp_ms": O.T0 + O.CREATE_AT}}
    out = None
    for mode in _MODES:
        part = capture.start_from(rows, mode, **given.get(mode, {})).select(
            F.lit(mode).alias("mode"), "op", "pos", "sub", F.col("key.k").alias("k"))
        out = part if out is None else out.unionByName(part)
    return out


@query("s12_skip_events_and_rows", f"""{BASE}, r AS (SELECT *, dense_rank() OVER (ORDER BY pos) AS e,
row_number() OVER (PARTITION BY pos ORDER BY sub) AS n FROM log WHERE pos >= 400000000)
SELECT op, pos, sub, k FROM r WHERE e > 4 OR (e = 4 AND n > 1)""")
def s12(spark, sf):
    df = capture.start_from(split_log(spark, sf), "specific-offset", offset=O.MOVE_AT, skip_events=3, skip_rows=1)
    return df.select("op", "pos", "sub", F.col("key.k").alias("k"))


@query("s13_snapshot_override", f"""{BASE} SELECT op, pos, k FROM snap WHERE acents > 10000000
UNION ALL SELECT op, pos, k FROM rawlog""")
def s13(spark, sf):
    df = snaps.snapshot_override(O.orders_changes(spark, sf), "shop.orders", "after.cents > 10000000")
    return df.select("op", "pos", F.col("key.k").alias("k"))


@query("s14_newly_added_tables", f"""{_SHARDED} SELECT db, tbl, op, pos, k FROM sharded
WHERE (db = 'db_1' AND tbl = 'orders_1') OR (NOT (db = 'db_1' AND tbl = 'orders_1') AND op <> 'r' AND pos > 250000000)""")
def s14(spark, sf):
    rows = O.sharded_changes(spark, sf)
    # Saved state: three of the four tables, all read up to one position.
    catalog = rows.select("db", "table").distinct()
    state = (catalog.where("not (db = 'db_1' and table = 'orders_1')")
             .select("db", "table", F.lit(250_000_000).cast("bigint").alias("pos"), F.lit(0).alias("sub")))
    added = capture.newly_added_tables(state, catalog, ["db_.*"], ["orders_.*"])
    df = capture.read_with_new_tables(O.sharded_changes(spark, sf, log=False),
                                      O.sharded_changes(spark, sf, snapshot=False), state, added)
    return df.select("db", F.col("table").alias("tbl"), "op", "pos", F.col("key.k").alias("k"))


@query("s14_new_table_overlaps_log", f"""{BASE}, t AS (SELECT 'orders_' || (coalesce(acust, bcust) % 2) AS tbl, * FROM ({ALL_RAW}) x),
c AS (SELECT tbl, count(*) AS n, sum(acents) AS total FROM (
  SELECT 'orders_' || (cust % 2) AS tbl, ucents AS acents FROM upd WHERE k % 11 <> 0 AND k % 17 <> 0
  UNION ALL SELECT 'orders_' || (cust % 2), cents FROM upd WHERE k % 13 = 0
  UNION ALL SELECT 'orders_' || (cust % 2), ucents FROM upd WHERE k % 17 = 0 AND k % 11 <> 0) GROUP BY tbl)
SELECT tbl, n, CAST(total AS BIGINT) AS total FROM c WHERE tbl = 'orders_1'""")
def s14n(spark, sf):
    """A table added while the log runs: its snapshot holds the log up to a position, and each change counts once."""
    def shard(df):
        return df.withColumn("table", F.format_string("orders_%d", F.coalesce("after", "before")["cust"] % 2))
    snap = shard(O.orders_changes(spark, sf, log=False))
    log = shard(L.split_key_updates(O.orders_changes(spark, sf, snapshot=False)))
    state = spark.createDataFrame([("shop", "orders_0", 10 ** 18, 0)], "db string, table string, pos bigint, sub int")
    added = spark.createDataFrame([("shop", "orders_1")], "db string, table string")
    # What was read as the snapshot is the state at 250,000,000.
    seen = L.latest_changes(snap.unionByName(log.where("pos <= 250000000")), ("db", "table", "key")).where("op <> 'd'")
    seen = seen.withColumns({"op": F.lit("r"), "before": F.lit(None).cast(O.IMAGE), "pos": F.lit(0).cast("bigint"), "sub": F.lit(0)})
    high = added.withColumn("pos", F.lit(250_000_000).cast("bigint"))
    rows = capture.read_with_new_tables(seen, log, state, added, high)
    signed = rows.withColumn("n", F.when(F.col("op").isin("r", "c"), 1).when(F.col("op") == "d", -1).otherwise(0))
    cents = F.coalesce("after.cents", F.lit(0)) - F.when(F.col("op").isin("u", "d"), F.col("before.cents")).otherwise(0)
    return signed.groupBy(F.col("table").alias("tbl")).agg(F.sum("n").alias("n"), F.sum(cents).cast("bigint").alias("total"))


# Envelopes put together by plain text functions, as a source writes them: positions start again in every file, and
# an event holds several rows.
_LOGGED = """SELECT o_orderkey AS k, o_orderkey // 500 AS f, o_orderkey % 500 AS p FROM orders"""


@query("s1_files_and_rows", f"""WITH o AS ({_LOGGED})
SELECT k, 'file' || (f + 2) AS st FROM o WHERE k % 5 <> 0 UNION ALL SELECT -k, 'moved' FROM o WHERE k % 5 = 0
UNION ALL SELECT k + 500000000, 'next row' FROM o WHERE k % 5 = 0""")
def s1f(spark, sf):
    """Each order is written in one file and again, at a smaller position, in the next one. Every fifth one is then moved to
    another key by row 0 of an event whose row 1 changes one more key."""
    orders = O.read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    k, f, p = F.col("k"), F.floor(F.col("k") / 500), F.col("k") % 500

    def image(key, text):
        return F.concat(F.lit('{"k":'), key.cast("string"), F.lit(',"st":"'), text, F.lit('"}'))

    def event(op, file, pos, row, before, after):
        source = F.concat(F.lit('"source":{"db":"shop","table":"orders","file":"log.'), F.lpad(file.cast("string"), 6, "0"),
                          F.lit('","pos":'), pos.cast("string"), F.lit(f',"row":{row}}}'))
        return F.concat(F.lit('{"before":'), before, F.lit(',"after":'), after, F.lit(f',"op":"{op}",'), source, F.lit("}"))
    null, old, new = F.lit("null"), image(k, F.lit("old")), image(k, F.concat(F.lit("file"), (f + 2).cast("string")))
    fifth, other = k % 5 == 0, k + 500_000_000
    texts = F.array_compact(F.array(
        event("c", f + 1, p + 1000, 0, null, old), event("u", f + 2, p, 0, old, new),
        F.when(fifth, event("c", f + 2, p + 500, 0, null, image(other, F.lit("first")))),
        F.when(fifth, event("u", f + 3, p, 0, new, image(-k, F.lit("moved")))),
        F.when(fifth, event("u", f + 3, p, 1, image(other, F.lit("first")), image(other, F.lit("next row"))))))
    raw = orders.select(F.explode(texts).alias("value"))
    return L.materialize(L.split_key_updates(envelope.decode_envelope(raw, "k bigint, st string", ["k"])))


@query("s11_start_in_file", f"""WITH o AS ({_LOGGED}), lo AS (SELECT min(f) AS f FROM o)
SELECT k FROM o, lo WHERE o.f > lo.f + 1 OR (o.f = lo.f + 1 AND o.p >= 100)""")
def s11f(spark, sf):
    """Start at a file and a place in it."""
    orders = O.read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    first = orders.agg(F.min(F.floor(F.col("k") / 500))).first()[0]
    raw = orders.select(F.format_string('{"op":"c","after":{"k":%d},"source":{"file":"log.%06d","pos":%d}}', F.col("k"), F.floor(F.col("k") / 500).cast("bigint"),
                                        (F.col("k") % 500).cast("bigint")).alias("value"))
    rows = envelope.decode_envelope(raw, "k bigint", ["k"])
    return capture.start_from(rows, "specific-offset", offset=(f"log.{first + 1:06d}", 100)).select("key.k")


@query("s16_cluster_time", """SELECT doc_id AS id, 'v2' AS st FROM documents""")
def s16c(spark, sf):
    """Two events of one second per document, told apart by the counter; the key is an object or a text."""
    docs = O.read(spark, sf, "documents").select("doc_id")
    key = F.format_string('{"_id":%d}', "doc_id")
    key = F.when(F.col("doc_id") % 2 == 0, key).otherwise(F.to_json(F.struct(key.alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(key.alias("k")))) - 6))

    def event(kind, i, st):
        return F.concat(F.lit(f'{{"operationType":"{kind}","ns":{{"db":"d","coll":"c"}},"documentKey":'), key,
                        F.format_string(f',"fullDocument":{{"_id":%d,"st":"{st}"}},"clusterTime":{{"$timestamp":{{"t":170,"i":{i}}}}}}}', "doc_id"))
    raw = docs.select(F.explode(F.array(event("update", 2, "v2"), event("insert", 1, "v1"))).alias("value"))
    rows = changestream.decode_change_stream(raw, "_id bigint, st string")
    return L.materialize(rows).select(F.col("_id").alias("id"), "st")


_LAST = "CASE WHEN doc_id % 3 = 0 THEN 'd' ELSE 'u' END"


@query("s2_type_change", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey * 3000000000 END AS n,
CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderstatus END AS st FROM orders""")
def s2t(spark, sf):
    """Two columns change their type in the log: int to bigint, and int to text."""
    orders, k = O.read(spark, sf, "orders"), F.col("o_orderkey")

    def schema(n, st):
        image = f'{{"type":"int64","field":"k"}},{{"type":"{n}","field":"n"}},{{"type":"{st}","field":"st"}}'
        return '{"schema":{"type":"struct","fields":[' + ",".join(f'{{"type":"struct","optional":true,"field":"{side}","fields":[{image}]}}' for side in ("before", "after")) + ']},"payload":{"op":"c","after":{"k":%d,"n":%d,"st":%s},"source":{"table":"orders","pos":%d}}}'
    text = F.when(k % 2 == 0, F.format_string(schema("int32", "int32"), k, k, k.cast("string"), k)).otherwise(
        F.format_string(schema("int64", "string"), k, k * 3_000_000_000, F.concat(F.lit('"'), "o_orderstatus", F.lit('"')), k))
    return envelope.decode_envelope_with_schema(orders.select(text.alias("value")), ["k"]).select("after.k", "after.n", "after.st")


@query("s16_transaction_order", f"""SELECT doc_id AS id, 1 AS n, 'c' AS op, NULL AS bst, 'v1' AS ast FROM documents
UNION ALL SELECT doc_id, 2, 'u', 'v1', 'v2' FROM documents UNION ALL SELECT doc_id, 3, {_LAST}, 'v2', CASE WHEN doc_id % 3 <> 0 THEN 'v3' END FROM documents""")
def s16t(spark, sf):
    """Three changes of each document in one transaction, at one cluster time, read in any order and normalised as a stream."""
    docs, i = O.read(spark, sf, "documents").select("doc_id"), F.col("i")
    last = F.when(F.col("doc_id") % 3 == 0, "delete").otherwise("update")
    # Resume token: a mark, the cluster time in 16 hexadecimal digits, and the place in the transaction.
    token = F.format_string("82%08X%08X2B%02X29296E04", F.lit(1700), F.col("doc_id"), i + 250)
    whole = F.format_string(',"fullDocument":{"_id":%d,"st":"v%d"}', "doc_id", i)
    text = F.format_string('{"_id":{"_data":"%s"},"operationType":"%s","ns":{"db":"d","coll":"c"},"documentKey":{"_id":%d},"txnNumber":7,"clusterTime":{"$timestamp":{"t":1700,"i":%d}}',
                           token, F.when(i == 1, "insert").when(i == 2, "update").otherwise(last), "doc_id", "doc_id")
    raw = docs.withColumn("i", F.explode(F.array(*map(F.lit, (1, 2, 3))))).select(
        F.concat(text, F.when((i < 3) | (last != "delete"), whole).otherwise(""), F.lit("}")).alias("value"))
    rows = changestream.decode_change_stream(raw, "_id bigint, st string", wide=True)
    source, held, out, state = (scratch_dir(spark, n) for n in ("log", "held", "changes", "state"))
    rows.repartition(3, F.xxhash64("pos")).sortWithinPartitions(F.xxhash64("pos", F.lit(1))).write.parquet(source)
    finish(streams.stream_normalize(logs.read_log(spark, source, rows.schema, stream=True), held, out, state))
    done = spark.read.schema(rows.schema).parquet(out)
    return done.select(F.col("key._id").alias("id"), (F.conv(F.substring("pos", 41, 2), 16, 10).cast("int") - 250).alias("n"), "op",
                       F.col("before.st").alias("bst"), F.col("after.st").alias("ast"))


# Three servers; the set has gaps, single numbers, an interval in two pieces, and a server that is not in the log.
_GTIDS = "aa-1:1-300:302-400:700, BB-2:5-2000,aa-1:401-450, dd-9:1-10"
_SID = "CASE k % 3 WHEN 0 THEN 'aa-1' WHEN 1 THEN 'bb-2' ELSE 'cc-3' END"


@query("s11_start_by_gtid_set", f"""WITH o AS (SELECT o_orderkey AS k FROM orders), g AS (SELECT k, {_SID} AS sid, k // 3 + 1 AS n FROM o)
SELECT k, sid, n FROM g WHERE NOT (sid = 'aa-1' AND (n BETWEEN 1 AND 300 OR n BETWEEN 302 AND 450 OR n = 700)) AND NOT (sid = 'bb-2' AND n BETWEEN 5 AND 2000)""")
def s11g(spark, sf):
    k = F.col("k")
    sid = F.when(k % 3 == 0, "aa-1").when(k % 3 == 1, "bb-2").otherwise("cc-3")
    number = F.floor(k / 3).cast("bigint") + 1
    raw = O.read(spark, sf, "orders").select(F.col("o_orderkey").alias("k")).select(
        F.format_string('{"op":"c","after":{"k":%d},"source":{"file":"log.000001","pos":%d,"gtid":"%s:%d"}}', k, k, sid, number).alias("value"))
    rows = envelope.decode_envelope(raw, "k bigint", ["k"], keep=["gtid"])
    parts = F.split("gtid", ":")
    return capture.start_after_gtids(rows, _GTIDS).select("key.k", parts[0].alias("sid"), parts[1].cast("bigint").alias("n"))


# Values as the wire has them: days, milliseconds and microseconds since the epoch, ISO instants, sets as text, base64.
@query("s1_wire_values", """SELECT event_id AS id, CAST(CAST(event_id % 20000 AS INTEGER) + DATE '1970-01-01' AS VARCHAR) AS d, epoch_ms(TIMESTAMP '2001-02-03 04:05:06') + event_id AS ms,
epoch_ms(TIMESTAMP '2001-02-03 04:05:06') * 1000 + event_id AS us, CAST(978307200 + event_id AS BIGINT) AS zoned, CASE WHEN event_id % 3 = 0 THEN 'a|b' WHEN event_id % 3 = 1 THEN 'a' ELSE '' END AS s FROM events""")
def s1w(spark, sf):
    base = 981173106
    i = F.col("event_id")
    zoned = F.date_format(F.timestamp_seconds(i + 978307200), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.concat(F.lit('{"op":"c","after":{"id":'), i.cast("string"), F.lit(',"d":'), (i % 20000).cast("string"), F.lit(',"ms":'),
                    (i + base * 1000).cast("string"), F.lit(',"us":'), (i + base * 1_000_000).cast("string"), F.lit(',"zoned":"'), zoned, F.lit('","s":"'),
                    F.when(i % 3 == 0, "a,b").when(i % 3 == 1, "a").otherwise(""), F.lit('"},"source":{"file":"log.000001","pos":'), i.cast("string"), F.lit("}}"))
    rows = envelope.decode_envelope(O.read(spark, sf, "events").select(text.alias("value")), "id bigint, d date, ms timestamp_ntz, us timestamp_ntz, zoned timestamp, s array<string>",
                                    ["id"], units={"ms": "millis"})
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return rows.select("after.*").select("id", F.col("d").cast("string").alias("d"), (micros("ms") / 1000).cast("bigint").alias("ms"), micros("us").alias("us"),
                                         F.unix_seconds("zoned").alias("zoned"), F.array_join("s", "|").alias("s"))


@query("s2_schema_per_event", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS st FROM orders""")
def s2e(spark, sf):
    """Even orders carry a status, odd ones, written after a column was dropped and another added, a date."""
    orders = O.read(spark, sf, "orders")

    def schema(*fields):
        image = ",".join(fields)
        return '{"schema":{"type":"struct","fields":[' + ",".join(f'{{"type":"struct","optional":true,"field":"{side}","fields":[{image}]}}' for side in ("before", "after")) + ']},"payload":{"op":"c","after":{"k":'
    key = '{"type":"int64","field":"k"}'
    even = F.concat(F.lit(schema(key, '{"type":"string","optional":true,"field":"st"}')), F.col("o_orderkey").cast("string"), F.lit(',"st":"'), "o_orderstatus", F.lit('"}'))
    odd = F.concat(F.lit(schema(key, '{"type":"int32","name":"time.Date","optional":true,"field":"day"}')), F.col("o_orderkey").cast("string"), F.lit(',"day":'),
                   F.unix_date(F.col("o_orderdate").cast("date")).cast("string"), F.lit("}"))
    tail = F.concat(F.lit(',"source":{"table":"orders","pos":'), F.col("o_orderkey").cast("string"), F.lit("}}}"))
    raw = orders.select(F.concat(F.when(F.col("o_orderkey") % 2 == 0, even).otherwise(odd), tail).alias("value"))
    return envelope.decode_envelope_with_schema(raw, ["k"]).select("after.k", F.col("after.day").cast("string").alias("day"), "after.st")


@query("s15_snapshot_as_insert", f"{BASE} SELECT 'c' AS op, pos, k FROM snap UNION ALL SELECT op, pos, k FROM rawlog")
def s15(spark, sf):
    df = snaps.snapshot_as_insert(O.orders_changes(spark, sf))
    return df.select("op", "pos", F.col("key.k").alias("k"))


DOC_SCHEMA = "_id string, doc_id bigint, text string, lang string, n_chars int, meta struct<source:string,chars:bigint>"


def document_events(spark, sf):
    """Change-stream texts over all documents: insert, then update (doc_id % 5), then delete (% 7)."""
    docs = O.read(spark, sf, "documents")
    oid = F.lpad(F.lower(F.hex("doc_id")), 24, "0")

    def event(kind, at, text):
        full = F.struct(F.struct(oid.alias("$oid")).alias("_id"),
                        F.struct(F.col("doc_id").cast("string").alias("$numberLong")).alias("doc_id"),
                        text.alias("text"), F.col("lang"),
                        F.struct(F.col("n_chars").cast("string").alias("$numberInt")).alias("n_chars"),
                        F.struct(F.col("source"), F.struct(F.col("n_chars").cast("string").alias("$numberLong"))
                                 .alias("chars")).alias("meta"))
        pos = F.col("doc_id") + at
        return F.to_json(F.struct(
            F.lit(kind).alias("operationType"),
            F.struct(F.lit("wiki").alias("db"), F.lit("documents").alias("coll")).alias("ns"),
            F.struct(F.struct(oid.alias("$oid")).alias("_id")).alias("documentKey"),
            *([] if kind == "delete" else [full.alias("fullDocument")]),
            F.struct(F.struct((F.lit(1_700_000_000) + F.col("doc_id")).alias("t"), F.lit({"insert": 1, "update": 2, "delete": 3}[kind]).alias("i"))
                     .alias("$timestamp")).alias("clusterTime"),
            (F.lit(O.T0) + pos).alias("ts_ms")))
    events = F.array_compact(F.array(
        event("insert", 0, F.col("text")),
        F.when(F.col("doc_id") % 5 == 0, event("update", O.UPDATE_AT, F.concat(F.lit("v2 "), F.col("text")))),
        F.when(F.col("doc_id") % 7 == 0, event("delete", O.DELETE_AT, F.col("text")))))
    return docs.select(F.explode(events).alias("value"))


_OID = "lpad(lower(to_hex(doc_id)), 24, '0')"


@query("s16_decode_change_stream", f"""SELECT 'c' AS op, (1700000000 + doc_id) * 4294967296 + 1 AS pos, (1700000000 + doc_id) * 1000 AS event_ts, {_OID} AS id, md5(text) AS text_md5, lang, n_chars, source, n_chars AS chars FROM documents
UNION ALL SELECT 'u', (1700000000 + doc_id) * 4294967296 + 2, (1700000000 + doc_id) * 1000, {_OID}, md5('v2 ' || text), lang, n_chars, source, n_chars FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT 'd', (1700000000 + doc_id) * 4294967296 + 3, (1700000000 + doc_id) * 1000, {_OID}, NULL, NULL, NULL, NULL, NULL FROM documents WHERE doc_id % 7 = 0""")
def s16(spark, sf):
    df = changestream.decode_change_stream(document_events(spark, sf), DOC_SCHEMA)
    return df.select("op", "pos", "event_ts", F.col("key._id").alias("id"), F.md5("after.text").alias("text_md5"),
                     "after.lang", F.col("after.n_chars").cast("bigint").alias("n_chars"), "after.meta.source",
                     "after.meta.chars")


def kv_log(spark, sf):
    """Transaction log rows of the split change log."""
    k = F.coalesce("after", "before")["k"]
    base = split_log(spark, sf).select(
        (k % 8).alias("region"), F.encode(F.format_string("t_%020d", k), "UTF-8").alias("key"), k.alias("k"),
        F.col("pos").alias("start_ts"), "op", F.coalesce("after.cents", F.lit(0)).alias("value"), "sub")

    direct = (F.col("op") == "c") & (F.col("sub") == 0)
    kinds = (F.when(direct, F.array(F.lit("COMMITTED")))
             .when(F.col("k") % 19 == 0, F.array(F.lit("PREWRITE"), F.lit("ROLLBACK")))
             .when(F.col("k") % 23 != 0, F.array(F.lit("PREWRITE"), F.lit("COMMIT")))
             .otherwise(F.array(F.lit("PREWRITE"))))
    rows = base.withColumn("log_type", F.explode(kinds))
    done = F.when(F.col("log_type").isin("COMMIT", "COMMITTED"), F.col("start_ts") + 1)
    return rows.select("region", "log_type", "key", "start_ts", done.alias("commit_ts"), "op", "value")


_KV = f"""{BASE}, kv AS (SELECT k % 8 AS region, 't_' || lpad(CAST(k AS VARCHAR), 20, '0') AS key, k, pos AS start_ts, pos + 1 AS commit_ts,
op, coalesce(acents, 0) AS value FROM log WHERE (op = 'c' AND sub = 0) OR (k % 19 <> 0 AND k % 23 <> 0))"""


@query("s18_committed_changes", f"{_KV} SELECT region, key, start_ts, commit_ts, op, value FROM kv")
def s18(spark, sf):
    return keyvalue.committed_changes(kv_log(spark, sf)).withColumn("key", F.decode("key", "UTF-8"))


@query("s19_resolved_frontier", f"""{_KV}, p AS (SELECT k % 8 AS region, max(pos) AS ts FROM log GROUP BY 1),
f AS (SELECT min(ts) AS safe, max(ts) AS seen FROM p)
SELECT region, key, commit_ts, safe AS safe_ts, seen AS seen_ts FROM kv, f WHERE commit_ts <= safe""")
def s19(spark, sf):
    log = kv_log(spark, sf)
    progress = log.select("region", F.col("start_ts").alias("resolved_ts"))
    front = keyvalue.resolved_frontier(progress).first()
    safe = keyvalue.safe_to_emit(keyvalue.committed_changes(log), progress)
    return safe.select("region", F.decode("key", "UTF-8").alias("key"), "commit_ts",
                       F.lit(front.safe_ts).alias("safe_ts"), F.lit(front.seen_ts).alias("seen_ts"))


@query("s20_key_range_filter", f"""{_KV} SELECT key, start_ts FROM kv
WHERE key >= 't_00000000000000000500' AND key < 't_00000000001000000100'""")
def s20(spark, sf):
    rows = keyvalue.committed_changes(kv_log(spark, sf))
    df = keyvalue.key_range_filter(rows, b"t_00000000000000000500", b"t_00000000001000000100")
    return df.select(F.decode("key", "UTF-8").alias("key"), "start_ts")


# ---------------------------------------------------------------- projections and record kinds

@query("p1_project", f"{BASE} SELECT op, pos, bk AS bid, upper('st_' || bst) AS bstatus, ak AS aid, upper('st_' || ast) AS astatus FROM ({ALL_RAW})")
def p1(spark, sf):
    df = capture.project(O.orders_changes(spark, sf), {"id": "k", "status": lambda r: F.upper(F.concat(F.lit("st_"), r["st"]))})
    return df.select("op", "pos", F.col("before.id").alias("bid"), F.col("before.status").alias("bstatus"),
                     F.col("after.id").alias("aid"), F.col("after.status").alias("astatus"))


@query("p2_declare", """SELECT CAST(c_custkey AS VARCHAR) AS C_CUSTKEY, c_name, CAST(round(c_acctbal) AS BIGINT) AS bal FROM
(SELECT c_custkey, c_name, round(c_acctbal) AS c_acctbal FROM customer)""")
def p2(spark, sf):
    rows = O.read(spark, sf, "customer").withColumn("c_acctbal", F.round("c_acctbal"))
    df = capture.declare(rows, {"C_CUSTKEY": "string", "c_name": "string", "c_acctbal": "bigint"})
    return df.withColumnRenamed("c_acctbal", "bal")


RECORD_SQL = f"""{BASE}, records AS (SELECT pos, sub, 'shop.orders' AS topic, 'data' AS kind, k FROM log
UNION ALL SELECT pos, sub, 'shop.orders', 'tombstone', k FROM log WHERE op = 'd'
UNION ALL SELECT pos, sub, '__heartbeat.shop', 'heartbeat', k FROM log WHERE op = 'u'
UNION ALL SELECT pos, sub, 'shop', 'schema', k FROM log WHERE op = 'c')"""


def raw_records(spark, sf):
    """The log as raw records: data, a tombstone after each delete, a heartbeat after each update and
    a schema change after each create."""
    data = envelope.changes_to_json(split_log(spark, sf), keep=("pos", "sub", "op", "key")).select(
        "pos", "sub", "op", F.col("key.k").alias("k"), "value")

    op, kind = F.col("op"), F.col("kind")
    kinds = (F.when(op == "d", F.array(F.lit("data"), F.lit("tombstone")))
             .when(op == "u", F.array(F.lit("data"), F.lit("heartbeat")))
             .when(op == "c", F.array(F.lit("data"), F.lit("schema"))).otherwise(F.array(F.lit("data"))))
    ddl = F.to_json(F.struct(
        F.struct(F.lit("shop").alias("db"), F.format_string("orders_%d", F.col("k") % 4).alias("table")).alias("source"),
        F.concat(F.lit('{"v":'), F.col("pos").cast("string"), F.lit("}")).alias("historyRecord")))
    beat = F.to_json(F.struct(F.col("pos").alias("ts_ms")))
    return data.withColumn("kind", F.explode(kinds)).select(
        "pos", "sub", "k",
        F.when(kind == "heartbeat", "__heartbeat.shop").when(kind == "schema", "shop").otherwise("shop.orders").alias("topic"),
        F.when(kind == "heartbeat", "heartbeat.Key").when(kind == "schema", "connector.SchemaChangeKey")
        .otherwise("shop.orders.Key").alias("key_schema"),
        F.when(kind == "heartbeat", beat).when(kind == "schema", ddl).when(kind == "data", F.col("value")).alias("value"))


@query("p3_is_data_change", f"{BASE} SELECT op, pos, sub, k FROM log")
def p3(spark, sf):
    df = raw_records(spark, sf).withColumn("op", F.get_json_object("value", "$.op"))
    return logs.is_data_change(df).select("op", "pos", "sub", "k")


@query("p4_split_schema_changes", f"""{RECORD_SQL} SELECT 'record' AS part, pos, NULL AS tbl, NULL AS schema_json FROM records WHERE kind <> 'schema'
UNION ALL SELECT 'history', pos, 'orders_' || (k % 4), '{{"v":' || pos || '}}' FROM records WHERE kind = 'schema'""")
def p4(spark, sf):
    kept, history = logs.split_schema_changes(raw_records(spark, sf))
    none = F.lit(None).cast("string")
    return (kept.select(F.lit("record").alias("part"), "pos", none.alias("tbl"), none.alias("schema_json"))
            .unionByName(history.select(F.lit("history").alias("part"), "pos", F.col("table").alias("tbl"), "schema_json")))


@query("p5_drop_tombstones", f"{RECORD_SQL} SELECT topic, pos, sub, k FROM records WHERE kind <> 'tombstone'")
def p5(spark, sf):
    return logs.drop_tombstones(raw_records(spark, sf)).select("topic", "pos", "sub", "k")


@query("p6_split_heartbeats", f"{RECORD_SQL} SELECT CASE WHEN kind = 'heartbeat' THEN 'progress' ELSE 'data' END AS part, topic, pos FROM records")
def p6(spark, sf):
    data, beats = logs.split_heartbeats(raw_records(spark, sf))
    return (data.select(F.lit("data").alias("part"), "topic", "pos")
            .unionByName(beats.select(F.lit("progress").alias("part"), "topic", "pos")))


@query("p7_route_tables", f"{_SHARDED} SELECT db, tbl, op, pos, k FROM sharded")
def p7(spark, sf):
    path = scratch_dir(spark, "routed")
    rows = O.sharded_changes(spark, sf)
    logs.write_routed(rows, path)
    df = spark.read.schema(rows.schema).parquet(path)
    return df.select("db", F.col("table").alias("tbl"), "op", "pos", F.col("key.k").alias("k"))


# ---------------------------------------------------------------- user functions

@query("f1_user_deserializer", f"""{BASE} SELECT pos, 'k' AS field, k AS value FROM log
UNION ALL SELECT pos, 'cents', acents FROM log WHERE acents IS NOT NULL""")
def f1(spark, sf):
    def fields(row):
        yield {"pos": row["pos"], "field": "k", "value": row["k"]}
        if row["cents"] is not None:
            yield {"pos": row["pos"], "field": "cents", "value": row["cents"]}
    rows = split_log(spark, sf).select("pos", F.col("key.k").alias("k"), F.col("after.cents").alias("cents"))
    return capture.deserialize(rows, fields, "pos bigint, field string, value bigint")


@query("f2_metadata_converter", f"{BASE} SELECT k, pos, 'shop/orders' AS origin, pos % 1000 AS slot FROM rawlog")
def f2(spark, sf):
    own = {"origin": lambda: F.concat_ws("/", "db", "table"), "slot": lambda: F.col("pos") % 1000}
    df = capture.with_metadata(O.orders_changes(spark, sf, snapshot=False), ["origin", "slot"], own)
    return df.select(F.col("key.k").alias("k"), "pos", "origin", "slot")


@query("f3_record_transforms", f"{BASE} SELECT 'c' AS op, pos, k, 'db2' AS db FROM snap UNION ALL SELECT op, pos, k, 'db2' FROM rawlog")
def f3(spark, sf):
    steps = [snaps.snapshot_as_insert, lambda d: d.withColumn("db", F.lit("db2"))]
    df = capture.apply_transforms(O.orders_changes(spark, sf), steps)
    return df.select("op", "pos", F.col("key.k").alias("k"), "db")
