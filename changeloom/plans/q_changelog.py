"""Queries over chunks, the changelog algebra, joins, aggregates and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changelog as L, chunks as C, merge as M, progress as P, views as V
from . import orders_log as O
from .common import FLAT, CHUNK, everything, flat, marks, order_chunks, snapshot, split_log
from .log_sql import BASE, MARKED, WITH_FINAL
from .registry import query

# ---------------------------------------------------------------- chunks


@query("c2_key_min_max", "SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders")
def c2(spark, sf):
    return C.key_min_max(O.read(spark, sf, "orders"), "o_orderkey")


@query("c3_approx_row_count", "SELECT count(*) AS row_count FROM lineitem")
def c3(spark, sf):
    return C.approx_row_count(O.read(spark, sf, "lineitem"))


@query("c4_distribution_factor", """SELECT l_suppkey, ceil((max(l_orderkey) - min(l_orderkey) + 1) * 10000.0 / count(*)) / 10000 AS factor
FROM lineitem GROUP BY l_suppkey""")
def c4(spark, sf):
    k = F.col("l_orderkey")
    return (O.read(spark, sf, "lineitem").groupBy("l_suppkey")
            .agg(C.distribution_factor(F.min(k), F.max(k), F.count(k)).alias("factor")))




def _table(plan, spark, name):
    return plan.table(spark, name).select(F.col("table").alias("tbl"), "chunk_id", F.col("start").alias("start_key"),
                                          F.col("end").alias("end_key"))


@query("c5_chunk_evenly", """WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi, count(*) AS n FROM lineitem),
f AS (SELECT *, CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 AS factor FROM b),
p AS (SELECT *, CAST(greatest(floor(factor * 500), 1) AS BIGINT) AS step FROM f),
q AS (SELECT lo, step, CASE WHEN n <= 500 THEN 0 ELSE (hi - lo) // step END AS last FROM p),
i AS (SELECT lo, step, last, unnest(range(0, last + 1)) AS i FROM q)
SELECT 'lineitem' AS tbl, i AS chunk_id, CASE WHEN i > 0 THEN lo + i * step END AS start_key,
CASE WHEN i < last THEN lo + (i + 1) * step END AS end_key FROM i""")
def c5(spark, sf):
    plan = C.plan_chunks(O.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 500)
    return _table(plan, spark, "lineitem")


_WALK = """WITH RECURSIVE d AS (SELECT {k} AS k, count(*) AS n FROM {t} GROUP BY 1),
c AS (SELECT k, sum(n) OVER (ORDER BY k) - n AS lo, sum(n) OVER (ORDER BY k) AS hi, lead(k) OVER (ORDER BY k) AS nk,
             max(k) OVER () AS mx FROM d),
nx AS (SELECT a.k, a.mx, coalesce(CASE WHEN b.k = a.k THEN a.nk ELSE b.k END, a.mx) AS nxt
       FROM c a LEFT JOIN c b ON a.lo + {size} > b.lo AND a.lo + {size} <= b.hi),
w(e, i) AS (SELECT nxt, 1 FROM nx WHERE k = (SELECT min(k) FROM d) AND nxt < mx
            UNION ALL SELECT nx.nxt, i + 1 FROM w JOIN nx ON nx.k = w.e WHERE nx.nxt < nx.mx),
z AS (SELECT e, i FROM w UNION ALL SELECT NULL, (SELECT coalesce(max(i), 0) + 1 FROM w))
SELECT '{t}' AS tbl, CAST(i - 1 AS BIGINT) AS chunk_id, lag(e) OVER (ORDER BY i) AS start_key, e AS end_key FROM z"""


@query("c6_chunk_unevenly_repeated_key", _WALK.format(k="o_custkey", t="orders", size=50))
def c6(spark, sf):
    plan = C.plan_chunks(O.read(spark, sf, "orders"), ["o_custkey", "o_orderkey"], 50, even=False)
    return _table(plan, spark, "orders")


@query("c6_chunk_unevenly_text_key", _WALK.format(k="c_name", t="customer", size=60))
def c6t(spark, sf):
    plan = C.plan_chunks(O.read(spark, sf, "customer"), ["c_name"], 60)
    return _table(plan, spark, "customer")


@query("c7_plan_chunks", """WITH b AS (SELECT min(o_custkey) AS lo, max(o_custkey) AS hi, count(*) AS n FROM orders),
f AS (SELECT *, CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 AS factor FROM b)
SELECT 'even' AS path, factor, CAST(greatest(floor(factor * 1000), 1) AS BIGINT) AS step,
(hi - lo) // CAST(greatest(floor(factor * 1000), 1) AS BIGINT) + 1 AS chunks FROM f""")
def c7(spark, sf):
    orders = O.read(spark, sf, "orders")
    plan = C.plan_chunks(orders, ["o_orderkey", "o_custkey"], 1000, override="o_custkey")
    k = F.col("o_custkey")
    return orders.agg(C.distribution_factor(F.min(k), F.max(k), F.count(k)).alias("factor")).select(
        F.lit(plan.path).alias("path"), "factor", F.lit(plan.step).cast("bigint").alias("step"),
        F.lit(plan.chunks).cast("bigint").alias("chunks"))


_MEMBER = _WALK.replace("SELECT '{t}' AS tbl, CAST(i - 1 AS BIGINT) AS chunk_id, lag(e) OVER (ORDER BY i) AS start_key, e AS end_key FROM z", "")


@query("c8_assign_chunk", _MEMBER.format(k="o_custkey", t="orders", size=50) +
       ", ranges AS (SELECT i - 1 AS chunk_id, lag(e) OVER (ORDER BY i) AS s, e FROM z)"
       " SELECT o_orderkey, CAST(chunk_id AS BIGINT) AS chunk_id FROM orders JOIN ranges"
       " ON (s IS NULL OR o_custkey >= s) AND (e IS NULL OR o_custkey < e)")
def c8(spark, sf):
    orders = O.read(spark, sf, "orders")
    plan = C.plan_chunks(orders, ["o_custkey", "o_orderkey"], 50, even=False)
    return C.assign_chunk(orders, plan, F.col("o_custkey")).select("o_orderkey", "chunk_id")


# Keys that are not numbers, out of the order of the numbers they are made from; bytes and code points from all over.
_MADE = "(o_orderkey * 2654435761 % 4294967296)"
_KINDS = {
    "binary": (f"from_hex(printf('%010x', {_MADE}))", lambda n: F.unhex(F.format_string("%010X", n))),
    "text": (f"chr(CAST(97 + {_MADE} % 500 AS INTEGER)) || {_MADE}", lambda n: F.concat(F.expr("decode(unhex(lpad(hex(97 + _n % 500), 8, '0')), 'UTF-32')"), n.cast("string"))),
    "timestamp": (f"make_timestamp({_MADE} * 1000037)", lambda n: F.timestamp_micros(n * 1000037).cast("timestamp_ntz")),
}


def _any_key(kind):
    def run(spark, sf):
        orders = O.read(spark, sf, "orders").withColumn("_n", F.col("o_orderkey") * 2654435761 % 4294967296)
        orders = orders.withColumn("key", _KINDS[kind][1](F.col("_n")))
        plan = C.plan_chunks(orders, ["key"], 100)
        return C.assign_chunk(orders, plan, F.col("key")).select("o_orderkey", "chunk_id")
    return run


for _kind, (_sql, _) in _KINDS.items():
    query(f"c8_{_kind}_key", _MEMBER.format(k=_sql, t="orders", size=100) + ", ranges AS (SELECT i - 1 AS chunk_id, lag(e) OVER (ORDER BY i) AS s, e FROM z)"
          f" SELECT o_orderkey, CAST(chunk_id AS BIGINT) AS chunk_id FROM orders JOIN ranges ON (s IS NULL OR {_sql} >= s) AND (e IS NULL OR {_sql} < e)")(_any_key(_kind))


@query("c11_chunk_by_bytes", """WITH d AS (SELECT o_orderkey, octet_length(encode('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}')) AS bytes FROM orders)
SELECT o_orderkey, CAST(bytes AS BIGINT) AS bytes, CAST((sum(bytes) OVER (ORDER BY o_orderkey) - bytes) // 65536 AS BIGINT) AS chunk_id FROM d""")
def c11(spark, sf):
    return C.chunk_by_bytes(O.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"),
                            "o_orderkey", 65_536)


@query("c12_chunk_balance", """WITH b AS (SELECT min(l_partkey) AS lo, max(l_partkey) AS hi, count(*) AS n FROM lineitem),
p AS (SELECT lo, hi, n, CAST(greatest(floor(CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 * 2000), 1) AS BIGINT) AS step,
      CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 AS factor FROM b)
SELECT CASE WHEN n <= 2000 THEN 0 ELSE (l_partkey - lo) // step END AS chunk_id, count(*) AS row_count
FROM lineitem, p GROUP BY 1""")
def c12(spark, sf):
    rows = O.read(spark, sf, "lineitem")
    plan = C.plan_chunks(rows, ["l_partkey", "l_orderkey", "l_linenumber"], 2000, lower=0.0, even=True)
    return C.chunk_balance(rows, plan).withColumnRenamed("rows", "row_count")


# ---------------------------------------------------------------- algebra

KIND = "row_kind, pos, sub, k, cust, st, cents"
_ALL_KINDS = """SELECT '+I' AS row_kind, pos, sub, ak AS k, acust AS cust, ast AS st, acents AS cents FROM {src} WHERE op IN ('r', 'c')
UNION ALL SELECT '-U', pos, sub, bk, bcust, bst, bcents FROM {src} WHERE op = 'u'
UNION ALL SELECT '+U', pos, sub, ak, acust, ast, acents FROM {src} WHERE op = 'u'
UNION ALL SELECT '-D', pos, sub, bk, bcust, bst, bcents FROM {src} WHERE op = 'd'"""
_BOTH = f"both_ AS (SELECT {FLAT} FROM snap UNION ALL SELECT {FLAT} FROM log)"


@query("l1_row_kinds_all", f"{BASE}, {_BOTH} {_ALL_KINDS.format(src='both_')}")
def l1(spark, sf):
    return L.to_row_kinds(everything(spark, sf))


@query("l2_row_kinds_upsert", f"""{BASE}, {_BOTH} SELECT CASE op WHEN 'u' THEN '+U' WHEN 'd' THEN '-D' ELSE '+I' END AS row_kind, pos, sub, k,
acust AS cust, ast AS st, acents AS cents FROM both_""")
def l2(spark, sf):
    no_before = everything(spark, sf).withColumn("before", F.lit(None).cast(O.IMAGE))
    return L.to_row_kinds(no_before, "upsert")


_FOLDED = f"""{MARKED}, cand AS (SELECT op, pos, sub, k, acust, ast, acents FROM snap
UNION ALL SELECT op, pos, sub, k, acust, ast, acents FROM marked WHERE pos > 0 AND pos <= high_pos),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos DESC, sub DESC) AS rn FROM cand),
folded AS (SELECT '+I' AS row_kind, pos, sub, k, acust AS cust, ast AS st, acents AS cents FROM ranked WHERE rn = 1 AND op <> 'd'),
late AS (SELECT * FROM marked WHERE pos > high_pos)"""


@query("l3_reconcile_chunks", f"{_FOLDED} SELECT {KIND} FROM folded")
def l3(spark, sf):
    plan = order_chunks(spark, sf)
    return M.reconcile_chunks(snapshot(spark, sf), split_log(spark, sf), plan, marks(spark, plan))


@query("l4_changes_after_snapshot", f"{_FOLDED} SELECT {FLAT} FROM late")
def l4(spark, sf):
    plan = order_chunks(spark, sf)
    return flat(M.changes_after_snapshot(split_log(spark, sf), plan, marks(spark, plan)))


@query("l5_snapshot_then_log", f"{_FOLDED} SELECT {KIND} FROM folded UNION ALL {_ALL_KINDS.format(src='late')}")
def l5(spark, sf):
    plan = order_chunks(spark, sf)
    return M.snapshot_then_log(snapshot(spark, sf), split_log(spark, sf), plan, marks(spark, plan))


@query("l5_state_of_changelog", f"{WITH_FINAL} SELECT * FROM final")
def l5s(spark, sf):
    plan = order_chunks(spark, sf)
    rows = M.snapshot_then_log(snapshot(spark, sf), split_log(spark, sf), plan, marks(spark, plan))
    return M.state_of_kinds(rows, ["k"])


def _state_by_key(make):
    """The whole changelog over uneven chunks of a key that ``make`` gives for the number."""
    def run(spark, sf):
        def keyed(df):
            return df.withColumn("key", F.struct(make(F.col("key.k")).alias("id")))
        plan = C.plan_chunks(O.order_images(spark, sf).select(make(F.col("k")).alias("id")), ["id"], 700)
        rows = M.snapshot_then_log(keyed(snapshot(spark, sf)), keyed(split_log(spark, sf)), plan, marks(spark, plan))
        return M.state_of_kinds(rows, ["k"])
    return run


query("l5_binary_key", f"{WITH_FINAL} SELECT * FROM final")(_state_by_key(lambda k: F.unhex(F.format_string("%016X", k * 2654435761 % 4294967296))))
query("l5_text_key", f"{WITH_FINAL} SELECT * FROM final")(_state_by_key(lambda k: F.reverse(F.format_string("%012d", k))))


@query("l6_materialize", f"{WITH_FINAL} SELECT * FROM final")
def l6(spark, sf):
    return L.materialize(everything(spark, sf))


@query("l7_split_key_updates", f"{BASE} SELECT {FLAT} FROM log")
def l7(spark, sf):
    return flat(split_log(spark, sf))


@query("l8_normalize_upserts", f"""{BASE}, {_BOTH},
p AS (SELECT *, lag(acents) OVER w AS pcents, lag(ast) OVER w AS pst, lag(ak) OVER w AS pk FROM both_ WINDOW w AS (PARTITION BY k ORDER BY pos, sub))
SELECT CASE WHEN op IN ('u', 'c') THEN CASE WHEN pk IS NULL THEN 'c' ELSE 'u' END ELSE op END AS op, pos, sub, k, pk AS bk, pst AS bst, pcents AS bcents, acents FROM p""")
def l8(spark, sf):
    no_before = everything(spark, sf).withColumn("before", F.lit(None).cast(O.IMAGE))
    return flat(L.normalize_upserts(no_before)).select("op", "pos", "sub", "k", "bk", "bst", "bcents", "acents")


def _damaged(spark, sf):
    """The log with broken rows: images and keys go missing at some positions."""
    p = F.col("pos") % 5
    return split_log(spark, sf).withColumns({
        "after": F.when(p == 1, F.lit(None).cast(O.IMAGE)).otherwise(F.col("after")),
        "before": F.when(p == 2, F.lit(None).cast(O.IMAGE)).otherwise(F.col("before")),
        "key": F.when(p == 3, F.lit(None).cast("struct<k:bigint>")).otherwise(F.col("key"))})


@query("l9_validate_changes", f"""{BASE}, v AS (SELECT op, pos, sub, CASE WHEN pos % 5 = 3 THEN 'key missing'
WHEN op IN ('c', 'u') AND (pos % 5 = 1) THEN 'after missing' WHEN op = 'd' AND pos % 5 = 2 THEN 'before missing' END AS reason FROM log)
SELECT * FROM v WHERE reason IS NOT NULL""")
def l9(spark, sf):
    return L.validate_changes(_damaged(spark, sf)).select("op", "pos", "sub", "reason")


@query("l10_check_row_images", f"""{BASE} SELECT 'shop' AS db, 'orders' AS tbl, count(*) AS changes,
count(*) FILTER (WHERE pos % 5 = 2) AS missing_before FROM log WHERE op IN ('u', 'd')""")
def l10(spark, sf):
    return L.check_row_images(_damaged(spark, sf)).withColumnRenamed("table", "tbl")


def _offset(pos, sub):
    file = F.format_string("bin.%06d", F.floor(pos / 100_000_000))
    return P.offset(file, pos % 100_000_000, F.when(pos % 3 != 0, F.lit(0).cast("bigint")), sub)


@query("l11_order_offsets", f"""{BASE} SELECT pos, sub, CAST(pos < t OR (pos = t AND sub < 1) AS INT) AS is_before, CAST(pos < t OR (pos = t AND sub <= 1) AS INT) AS is_at_or_before,
CAST(pos > t OR (pos = t AND sub > 1) AS INT) AS is_after, CAST(pos > t OR (pos = t AND sub >= 1) AS INT) AS is_at_or_after
FROM (SELECT pos, sub, 400000017 AS t FROM log)""")
def l11(spark, sf):
    here = _offset(F.col("pos"), F.col("sub"))
    there = _offset(F.lit(400_000_017).cast("bigint"), F.lit(1))
    rows = P.order_offsets(split_log(spark, sf).select("pos", "sub"), here, there)
    names = ["is_before", "is_at_or_before", "is_after", "is_at_or_after"]
    return rows.select("pos", "sub", *[F.col(n).cast("int").alias(n) for n in names])


@query("l12_dedup_at_least_once", f"{BASE} SELECT {FLAT} FROM log")
def l12(spark, sf):
    rows = split_log(spark, sf)
    repeated = rows.unionByName(rows.where(F.col("pos") % 5 == 0))
    return flat(L.dedup_at_least_once(repeated))


@query("l13_missing_log_files", f"""{BASE}, n AS (SELECT DISTINCT 'db_' || (k % 2) AS source, 'bin.' || lpad(CAST(pos // 1000 AS VARCHAR), 6, '0') AS file FROM log)
SELECT source, file, (SELECT min(file) FROM n m WHERE m.source = n.source AND m.file >= 'bin.200000') AS earliest_file FROM n WHERE file < 'bin.200000'""")
def l13(spark, sf):
    needed = split_log(spark, sf).select(
        F.format_string("db_%d", F.col("key.k") % 2).alias("source"),
        F.format_string("bin.%06d", F.floor(F.col("pos") / 1000)).alias("file"))
    available = needed.where("file >= 'bin.200000'")
    return P.missing_log_files(needed, available).join(P.earliest_log_file(available), "source", "left")


_GTID = """WITH a AS (SELECT 's' || (o_custkey % 3) AS sid, o_orderkey AS t FROM orders), b AS (SELECT sid, t FROM a WHERE t % 10 >= 4),
x AS (SELECT sid, t FROM a EXCEPT SELECT sid, t FROM b),
g AS (SELECT sid, t, t - row_number() OVER (PARTITION BY sid ORDER BY t) AS grp FROM x)
SELECT sid, min(t) AS lo, max(t) AS hi FROM g GROUP BY sid, grp"""


@query("l14_gtid_difference", _GTID)
def l14(spark, sf):
    orders = O.read(spark, sf, "orders")
    sid, t = F.format_string("S%d", F.col("o_custkey") % 3), F.col("o_orderkey")
    executed = orders.select(F.concat_ws(":", sid, t.cast("string")).alias("gtids"))
    # The other set is written as two-transaction stretches around the same numbers.
    kept = orders.where(t % 10 >= 4).select(
        F.concat_ws(":", sid, F.concat_ws("-", t.cast("string"), t.cast("string"))).alias("gtids"))
    return P.gtid_difference(P.parse_gtid_set(executed, "gtids"), P.parse_gtid_set(kept, "gtids"))


@query("l15_lag_report", f"""{BASE}, {_BOTH}, t AS (SELECT pos, coalesce(acust, bcust) AS cust FROM both_)
SELECT 'shop' AS db, 'orders' AS tbl, count(*) AS events, max(cust % 50) AS max_fetch_lag, avg(cust % 50) AS avg_fetch_lag,
max(cust % 7) AS max_emit_lag, avg(cust % 7) AS avg_emit_lag, max(pos + 1700000000000 + cust % 50) AS last_fetch_ts,
1800000000000 - max(pos + 1700000000000 + cust % 50) AS idle_ms FROM t""")
def l15(spark, sf):
    emit = F.col("fetch_ts") + F.coalesce("after", "before")["cust"] % 7
    return P.idle_time(P.lag_report(everything(spark, sf), emit), F.lit(1_800_000_000_000)).withColumnRenamed("table", "tbl")


@query("l16_resume", f"""{BASE}, s AS (SELECT 'db_' || (coalesce(acust, bcust) % 2) AS db, * FROM log), pt AS (SELECT db, max((pos, sub)) AS done FROM s WHERE pos < 400000000 AND db = 'db_1' GROUP BY db)
SELECT db, {FLAT} FROM s WHERE db = 'db_0' OR (pos, sub) > (SELECT done FROM pt)""")
def l16(spark, sf):
    """db_1 was read up to the end of its creates; db_0 has no saved state."""
    cust = F.coalesce("after", "before")["cust"]
    rows = split_log(spark, sf).withColumn("db", F.format_string("db_%d", cust % 2))
    state = P.commit_progress(rows.limit(0), rows.where((F.col("pos") < O.MOVE_AT) & (cust % 2 == 1)))
    return flat(P.resume(rows, state), "db")


@query("l17_commit_progress", f"""{BASE}, s AS (SELECT 'db_' || (coalesce(acust, bcust) % 2) AS db, pos, sub FROM log)
SELECT db, pos, max(sub) AS sub FROM s WHERE (db, pos) IN (SELECT (db, max(pos)) FROM s GROUP BY db) GROUP BY db, pos""")
def l17(spark, sf):
    cust = F.coalesce("after", "before")["cust"]
    rows = split_log(spark, sf).withColumn("db", F.format_string("db_%d", cust % 2))
    state = P.commit_progress(rows.limit(0), rows.where(F.col("pos") < O.CREATE_AT), ("db",))
    return P.commit_progress(state, rows.where(F.col("pos") >= O.CREATE_AT), ("db",))


@query("l18_evolve_rows", f"""{BASE} SELECT pos, sub, k, acents AS cents, CASE WHEN pos >= 200000000 THEN acents * 2 END AS volume FROM log""")
def l18(spark, sf):
    rows = split_log(spark, sf).select("pos", "sub", F.col("key.k").alias("k"), F.col("after.cents").alias("cents"))
    old = rows.where(F.col("pos") < O.DELETE_AT)
    new = rows.where(F.col("pos") >= O.DELETE_AT).withColumn("volume", F.col("cents") * 2)
    return L.evolve_rows(old, new)


@query("l19_latest_schemas", f"""{BASE}, h AS (SELECT 'shop' AS db, 'orders_' || (k % 8) AS tbl, pos, sub, '{{"v":' || pos || '}}' AS schema_json FROM rawlog)
SELECT db, tbl, schema_json, pos FROM h WHERE (tbl, pos) IN (SELECT (tbl, max(pos)) FROM h GROUP BY tbl)""")
def l19(spark, sf):
    return L.latest_schemas(_schema_history(spark, sf)).withColumnRenamed("table", "tbl")


def _schema_history(spark, sf):
    return O.orders_changes(spark, sf, snapshot=False).select(
        "db", F.format_string("orders_%d", F.col("key.k") % 8).alias("table"), "pos",
        F.concat(F.lit('{"v":'), F.col("pos").cast("string"), F.lit("}")).alias("schema_json"))


@query("l19_schema_history", f"""{BASE} SELECT 'shop' AS db, 'orders_' || (k % 8) AS tbl, pos, '{{"v":' || pos || '}}' AS schema_json,
row_number() OVER (PARTITION BY k % 8 ORDER BY pos) AS version FROM rawlog""")
def l19f(spark, sf):
    return L.latest_schemas(_schema_history(spark, sf), full=True).withColumnRenamed("table", "tbl")


@query("l20_reconcile_states", f"""{WITH_FINAL}, o AS (SELECT k, cust, st, cents FROM img),
e AS (SELECT 'left' AS side, * FROM (SELECT * FROM final EXCEPT ALL SELECT * FROM o)
UNION ALL SELECT 'right', * FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM final))
SELECT side, k, cust, st, cents, count(*) AS copies FROM e GROUP BY ALL""")
def l20(spark, sf):
    return L.reconcile_states(L.materialize(everything(spark, sf)), O.order_images(spark, sf))


# ---------------------------------------------------------------- joins and aggregates

@query("j1_enrich_orders", f"""{WITH_FINAL} SELECT k, final.cust, st, cents, c_name, c_mktsegment, n_name FROM final
LEFT JOIN customer ON c_custkey = cust AND c_mktsegment <> 'MACHINERY' LEFT JOIN nation ON n_nationkey = c_nationkey""")
def j1(spark, sf):
    customers = (O.read(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'")
                 .select(F.col("c_custkey").alias("cust"), "c_name", "c_mktsegment", F.col("c_nationkey").alias("nation")))
    nations = O.read(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return V.enrich(L.materialize(everything(spark, sf)), (customers, "cust"), (nations, "nation")).drop("nation")


@query("j2_enrich_changes", f"""{WITH_FINAL}, oldd AS (SELECT c_custkey, c_name FROM customer),
newd AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN upper(c_name) ELSE c_name END AS c_name FROM customer WHERE c_custkey % 31 <> 0),
o AS (SELECT k, img.cust, st, cents, c_name FROM img LEFT JOIN oldd ON c_custkey = cust),
n AS (SELECT k, final.cust, st, cents, c_name FROM final LEFT JOIN newd ON c_custkey = cust),
j AS (SELECT o.k AS ok, o.cust AS ocust, o.st AS ost, o.cents AS ocents, o.c_name AS oname, n.k AS nk, n.cust AS ncust, n.st AS nst, n.cents AS ncents, n.c_name AS nname
FROM o FULL JOIN n ON o.k = n.k),
ch AS (SELECT *, (ost, ocents, ocust, coalesce(oname, '')) IS DISTINCT FROM (nst, ncents, ncust, coalesce(nname, '')) AS differs FROM j)
SELECT '+I' AS row_kind, nk AS k, ncust AS cust, nst AS st, ncents AS cents, nname AS c_name FROM ch WHERE ok IS NULL
UNION ALL SELECT '-D', ok, ocust, ost, ocents, oname FROM ch WHERE nk IS NULL
UNION ALL SELECT '-U', ok, ocust, ost, ocents, oname FROM ch WHERE ok IS NOT NULL AND nk IS NOT NULL AND differs
UNION ALL SELECT '+U', nk, ncust, nst, ncents, nname FROM ch WHERE ok IS NOT NULL AND nk IS NOT NULL AND differs""")
def j2(spark, sf):
    old_dim = O.read(spark, sf, "customer").select(F.col("c_custkey").alias("cust"), "c_name")
    cust = F.col("cust")
    new_dim = (old_dim.where(cust % 31 != 0)
               .withColumn("c_name", F.when(cust % 9 == 0, F.upper("c_name")).otherwise(F.col("c_name"))))
    touched_dim = old_dim.where((cust % 9 == 0) | (cust % 31 == 0))
    log = split_log(spark, sf)
    cols = ["k", "cust", "st", "cents"]
    return V.enrich_changes(O.order_images(spark, sf).select(*cols), L.materialize(everything(spark, sf)),
                            log.select("key.k"), "k", [V.DimChange(old_dim, new_dim, touched_dim, "cust")])


@query("a1_aggregate_changes", f"""{WITH_FINAL} SELECT st, cust % 100 AS grp, count(*) AS row_count, CAST(sum(cents) AS BIGINT) AS cents FROM final GROUP BY 1, 2""")
def a1(spark, sf):
    kinds = L.to_row_kinds(everything(spark, sf)).withColumn("grp", F.col("cust") % 100)
    return V.aggregate_changes(kinds, ["st", "grp"], {"cents": F.col("cents")})


@query("a2_change_counts", f"""{BASE}, {_BOTH}, t AS (SELECT op, pos + 1700000000000 AS ts FROM both_)
SELECT 'shop' AS db, 'orders' AS tbl, op, ts - ts % 60000 AS bucket_ts, count(*) AS changes FROM t GROUP BY ALL""")
def a2(spark, sf):
    return V.change_counts(everything(spark, sf), 60_000).withColumnRenamed("table", "tbl")
