"""Queries over sinks and streams. Each writes the log as files, runs a stream over them to the end
and returns the resulting table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changelog as L
from ..operators.merge import state_of_kinds
from ..session import scratch_dir
from ..sources import envelope, log as logs
from ..streaming import keyed_state, sinks, streams as W, transactions
from . import orders_log as O
from .common import CUTS, FLAT, everything, finish, flat, log_directory, marks, order_chunks, snapshot, split_log
from .log_sql import BASE, WITH_FINAL
from .q_sources import _KV, kv_log
from .registry import query

NOW = {"availableNow": True}


def _stream(spark, rows, path, files=8):
    return logs.read_log(spark, path, rows.schema, stream=True, files_per_trigger=files)


def _append(stream, out, state):
    """Run a stream to the end of its source, its rows appended below ``out``."""
    finish(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(**NOW).start())


@query("k1_upsert_sink", f"{WITH_FINAL} SELECT * FROM final")
def k1(spark, sf):
    rows = everything(spark, sf)
    path, state = scratch_dir(spark, "table"), scratch_dir(spark, "state")
    finish(sinks.upsert_sink(_stream(spark, rows, log_directory(spark, rows)), path, state, compact_every=2))
    return sinks.read_table(spark, path, rows.schema)


@query("k2_lake_sink", f"""{BASE}, f AS (SELECT * FROM (SELECT 'db_' || (cust % 2) AS db, 'orders_' || (cust // 2 % 2) AS tbl, * FROM upd))
SELECT db, tbl, k, cust, ust AS st, ucents AS cents FROM f WHERE k % 11 <> 0 AND k % 17 <> 0
UNION ALL SELECT db, tbl, k + 1000000000, cust, st, cents FROM f WHERE k % 13 = 0
UNION ALL SELECT db, tbl, k + 2000000000, cust, ust, ucents FROM f WHERE k % 17 = 0 AND k % 11 <> 0""")
def k2(spark, sf):
    rows = L.split_key_updates(O.sharded_changes(spark, sf))
    path, state = scratch_dir(spark, "lake"), scratch_dir(spark, "state")
    finish(sinks.lake_sink(_stream(spark, rows, log_directory(spark, rows)), path, state))
    return sinks.read_table(spark, path, rows.schema, sinks.LAKE_KEY).withColumnRenamed("table", "tbl")


_SIDE = """CASE WHEN {p}k IS NULL THEN 'null' ELSE '{{"k":' || {p}k || ',"cust":' || {p}cust || ',"st":"' || {p}st || '","cents":' || {p}cents || '}}' END"""


@query("k3_changes_to_json", f"""{BASE} SELECT pos, '{{"before":' || {_SIDE.format(p='b')} || ',"after":' || {_SIDE.format(p='a')} ||
',"source":{{"db":"shop","schema":"public","table":"orders","ts_ms":' || (pos + 1700000000000) || ',"pos":' || pos || ',"row":' || (sub // 2) || ',"part":' || (sub % 2) || '}},"op":"' || op || '","ts_ms":' ||
(pos + 1700000000000 + coalesce(acust, bcust) % 50) || '}}' AS value FROM (SELECT {FLAT} FROM snap UNION ALL SELECT {FLAT} FROM log)""")
def k3(spark, sf):
    return envelope.changes_to_json(everything(spark, sf), keep=("pos",))


@query("w1_stream_materialize", f"{WITH_FINAL} SELECT * FROM final")
def w1(spark, sf):
    rows = everything(spark, sf)
    latest = W.stream_materialize(_stream(spark, rows, log_directory(spark, rows)))
    out, state = scratch_dir(spark, "updates"), scratch_dir(spark, "state")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    finish(latest.writeStream.outputMode("update").foreachBatch(keep)
           .option("checkpointLocation", state).trigger(**NOW).start())
    # Update mode reports a key once per batch that touched it; its last report is the state.
    reports = spark.read.parquet(out)
    last = (reports.groupBy("key").agg(F.max_by(F.struct("op", "after"), "batch").alias("_l")).select("_l.*"))
    return W.live_rows(last)


@query("w2_stream_upsert", f"{WITH_FINAL} SELECT * FROM final")
def w2(spark, sf):
    """Exactly once: the same batches are replayed from a lost checkpoint and change nothing."""
    rows = everything(spark, sf)
    source, path = log_directory(spark, rows), scratch_dir(spark, "table")
    for _ in range(2):
        finish(sinks.upsert_sink(_stream(spark, rows, source), path, scratch_dir(spark, "state")))
    return sinks.read_table(spark, path, rows.schema)


_BEFORE = f"""{BASE}, both_ AS (SELECT {FLAT} FROM snap UNION ALL SELECT {FLAT} FROM log),
p AS (SELECT *, lag(acents) OVER w AS pcents, lag(ast) OVER w AS pst, lag(ak) OVER w AS pk FROM both_ WINDOW w AS (PARTITION BY k ORDER BY pos, sub))
SELECT CASE WHEN op IN ('u', 'c') THEN CASE WHEN pk IS NULL THEN 'c' ELSE 'u' END ELSE op END AS op, pos, sub, k, pk AS bk, pst AS bst, pcents AS bcents, acents FROM p"""


@query("w3_stream_normalize", _BEFORE)
def w3(spark, sf):
    rows = everything(spark, sf).withColumn("before", F.lit(None).cast(O.IMAGE))
    stream = _stream(spark, rows, log_directory(spark, rows))
    held, out, state = (scratch_dir(spark, n) for n in ("held", "changes", "state"))
    finish(W.stream_normalize(stream, held, out, state))
    done = spark.read.schema(rows.schema).parquet(out)
    return flat(done).select("op", "pos", "sub", "k", "bk", "bst", "bcents", "acents")


@query("w3_state_store", _BEFORE)
def w3s(spark, sf):
    """In two runs: the second goes on with the state and the files that the first left."""
    rows = everything(spark, sf).withColumn("before", F.lit(None).cast(O.IMAGE))
    out, state = scratch_dir(spark, "changes"), scratch_dir(spark, "state")
    source = log_directory(spark, rows, CUTS[:2])
    _append(keyed_state.normalize(_stream(spark, rows, source), keyed_state.BUCKETS), out, state)
    log_directory(spark, rows, CUTS[2:], source)
    _append(keyed_state.normalize(_stream(spark, rows, source), keyed_state.BUCKETS), out, state)
    return flat(spark.read.schema(rows.schema).parquet(out)).select("op", "pos", "sub", "k", "bk", "bst", "bcents", "acents")


@query("w4_stream_progress", f"""{BASE}, r AS (SELECT pos, 'shop.orders_' || (k % 3) AS source FROM log WHERE k % 3 <> 2 OR op = 'u')
SELECT source, max(pos) AS pos FROM r GROUP BY source""")
def w4(spark, sf):
    """Tables 0 and 1 send data; table 2 is quiet and moves on by heartbeats only."""
    k = F.col("key.k")
    table = F.format_string("orders_%d", k % 3)
    rows = split_log(spark, sf).where((k % 3 != 2) | (F.col("op") == "u")).select(
        F.concat(F.when(k % 3 == 2, "__heartbeat.shop.").otherwise("shop."), table).alias("topic"), "pos")
    stream = _stream(spark, rows, log_directory(spark, rows))
    out, state = scratch_dir(spark, "progress"), scratch_dir(spark, "state")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    finish(W.stream_progress(stream).writeStream.outputMode("update").foreachBatch(keep)
           .option("checkpointLocation", state).trigger(**NOW).start())
    return spark.read.parquet(out).groupBy("source").agg(F.max("pos").alias("pos"))


@query("w5_stream_dedup", f"{BASE} SELECT {FLAT} FROM log UNION ALL SELECT {FLAT} FROM snap")
def w5(spark, sf):
    """The log with copies; the snapshot rows of a table that was added late come last, with copies too."""
    rows = split_log(spark, sf)
    late = snapshot(spark, sf)
    source = log_directory(spark, rows.unionByName(rows), CUTS)
    log_directory(spark, late.unionByName(late), [(0, 1)], source)
    stream = _stream(spark, rows, source)
    # The log spans over three days of event time, so state of its first part expires before the last part comes.
    unique = W.stream_dedup(stream, ["db", "table", "key", "op", "pos", "sub"], "12 hours")
    out, state = scratch_dir(spark, "unique"), scratch_dir(spark, "state")
    _append(unique, out, state)
    return flat(spark.read.schema(rows.schema).parquet(out))


@query("w5_snapshot_expiry", f"{BASE} SELECT {FLAT} FROM snap")
def w5_expiry(spark, sf):
    """A snapshot with copies, then its end, then the log: in the last batch the snapshot's state is gone."""
    rows, late = split_log(spark, sf), snapshot(spark, sf)
    source = log_directory(spark, late.unionByName(late), [(0, 1)])
    ends = late.groupBy("db", "table").agg(F.lit(keyed_state.COMPLETE).alias("op"), F.lit(O.UPDATE_AT + O.T0).cast("bigint").alias("event_ts"))
    rows.limit(0).unionByName(ends, allowMissingColumns=True).write.mode("append").parquet(source)
    log_directory(spark, rows, CUTS, source)
    out, state = scratch_dir(spark, "unique"), scratch_dir(spark, "state")
    _append(keyed_state.dedup_snapshot(_stream(spark, rows, source), ["db", "table", "key"], 60_000), out, state)
    return flat(spark.read.schema(rows.schema).parquet(out))


_UNTOUCHED = f"""{BASE}, m AS (SELECT k, max((pos, sub)) AS last FROM log WHERE pos >= 200000000 GROUP BY k)
SELECT op, pos, sub, log.k FROM log LEFT JOIN m ON log.k = m.k WHERE pos < 200000000 AND m.k IS NULL"""


@query("w6_late_change_guard", _UNTOUCHED)
def w6(spark, sf):
    """The later part of the log is applied first; of the earlier part only untouched keys get in."""
    rows = split_log(spark, sf)
    path = scratch_dir(spark, "table")
    sinks.upsert_batch(rows.where(F.col("pos") >= O.DELETE_AT), path, 0)
    late = W.late_change_guard(rows.where(F.col("pos") < O.DELETE_AT), path)
    return late.select("op", "pos", "sub", F.col("key.k").alias("k"))


@query("w6_state_store", _UNTOUCHED)
def w6s(spark, sf):
    """The later part of the log comes first; of the earlier part only untouched keys get in."""
    rows = split_log(spark, sf)
    out, state = scratch_dir(spark, "changes"), scratch_dir(spark, "state")
    source = log_directory(spark, rows, [(O.DELETE_AT, 10 ** 18)])
    _append(keyed_state.late_guard(_stream(spark, rows, source), keyed_state.BUCKETS), out, state)
    log_directory(spark, rows, [(0, O.DELETE_AT)], source)
    _append(keyed_state.late_guard(_stream(spark, rows, source), keyed_state.BUCKETS), out, state)
    late = spark.read.schema(rows.schema).parquet(out).where(F.col("pos") < O.DELETE_AT)
    return late.select("op", "pos", "sub", F.col("key.k").alias("k"))


@query("w7_snapshot_to_stream", f"{WITH_FINAL} SELECT * FROM final")
def w7(spark, sf):
    plan = order_chunks(spark, sf)
    log = split_log(spark, sf)
    stream = _stream(spark, log, log_directory(spark, log))
    path, state = scratch_dir(spark, "table"), scratch_dir(spark, "state")
    finish(W.snapshot_to_stream(snapshot(spark, sf), log, plan, marks(spark, plan), stream, path, state))
    return sinks.read_table(spark, path, log.schema)


@query("w2_new_checkpoint_and_files", f"{WITH_FINAL} SELECT * FROM final")
def w2n(spark, sf):
    """A second run with a new checkpoint, other batch borders, files added since, and compaction in between; then a
    second stream into the same table."""
    rows = everything(spark, sf)
    path = scratch_dir(spark, "table")
    source = log_directory(spark, rows, CUTS[:1])
    finish(sinks.upsert_sink(_stream(spark, rows, source), path, scratch_dir(spark, "state")))
    log_directory(spark, rows, CUTS[1:2], source)
    finish(sinks.upsert_sink(_stream(spark, rows, source, 3), path, scratch_dir(spark, "state"), compact_every=1))
    other = log_directory(spark, rows, CUTS[2:])
    finish(sinks.upsert_sink(_stream(spark, rows, other, 2), path, scratch_dir(spark, "state"), compact_every=1))
    return sinks.read_table(spark, path, rows.schema)


@query("w2_two_writers", f"{WITH_FINAL} SELECT * FROM final")
def w2w(spark, sf):
    """Two streams write the same table at the same time, over parts of the log that overlap; both fold as they go."""
    rows = everything(spark, sf)
    path = scratch_dir(spark, "table")
    running = [sinks.upsert_sink(_stream(spark, rows, log_directory(spark, rows, cuts), 2), path, scratch_dir(spark, "state"), compact_every=1, buckets=4)
               for cuts in (CUTS[:2], CUTS[1:])]
    for stream in running:
        finish(stream)
    return sinks.read_table(spark, path, rows.schema)


@query("w6_late_change_after_compaction", _UNTOUCHED)
def w6c(spark, sf):
    """As w6, but the table is compacted first: deleted keys are still known."""
    rows = split_log(spark, sf)
    path = scratch_dir(spark, "table")
    sinks.upsert_batch(rows.where(F.col("pos") >= O.DELETE_AT), path, 0)
    sinks.compact(spark, path, rows.schema)
    late = W.late_change_guard(rows.where(F.col("pos") < O.DELETE_AT), path)
    return late.select("op", "pos", "sub", F.col("key.k").alias("k"))


@query("w8_stream_restart", f"{WITH_FINAL} SELECT * FROM final")
def w8(spark, sf):
    """Two runs on one checkpoint; the second finds the files written after the first stopped."""
    rows = everything(spark, sf)
    path, state = scratch_dir(spark, "table"), scratch_dir(spark, "state")
    source = log_directory(spark, rows, CUTS[:1])
    finish(sinks.upsert_sink(_stream(spark, rows, source), path, state))
    log_directory(spark, rows, CUTS[1:], source)
    finish(sinks.upsert_sink(_stream(spark, rows, source), path, state))
    return sinks.read_table(spark, path, rows.schema)


@query("j2_stream_enrich", f"""{WITH_FINAL} SELECT final.k, final.cust, st, cents, CASE WHEN final.cust % 9 = 0 THEN upper(c_name) ELSE c_name END AS c_name
FROM final LEFT JOIN customer ON c_custkey = final.cust AND c_custkey % 31 <> 0""")
def j2s(spark, sf):
    """Orders and customers change in one raw log: customers are read, renamed (% 9) and deleted (% 31)."""
    cust = F.col("c_custkey")
    image = F.struct(cust.alias("cust"), F.col("c_name"))
    named = F.struct(cust.alias("cust"), F.upper("c_name").alias("c_name"))
    none = F.lit(None).cast("struct<cust:bigint,c_name:string>")

    def event(op, pos, before, after):
        return F.struct(F.lit(op).alias("op"), pos.cast("bigint").alias("pos"), before.alias("before"), after.alias("after"))
    now = F.when(cust % 9 == 0, named).otherwise(image)
    events = F.array_compact(F.array(
        event("r", F.lit(0), none, image), F.when(cust % 9 == 0, event("u", cust + O.UPDATE_AT, image, named)),
        F.when(cust % 31 == 0, event("d", cust + O.CREATE_AT, now, none))))
    customers = (O.read(spark, sf, "customer").select(F.explode(events).alias("e")).select(
        F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("customer").alias("table"), "e.op", "e.pos",
        F.lit(0).alias("sub"), F.lit(0).cast("bigint").alias("event_ts"), F.lit(0).cast("bigint").alias("fetch_ts"),
        F.struct(F.coalesce("e.after", "e.before")["cust"].alias("cust")).alias("key"), "e.before", "e.after"))
    raw = (envelope.changes_to_json(O.orders_changes(spark, sf), keep=("pos",))
           .unionByName(envelope.changes_to_json(customers, keep=("pos",))))
    stream = _stream(spark, raw, log_directory(spark, raw))
    held, out, state = (scratch_dir(spark, n) for n in ("held", "changes", "state"))
    finish(W.stream_enrich(stream, W.Side("orders", O.IMAGE[7:-1], ["k"]),
                           [W.Side("customer", "cust bigint, c_name string", ["cust"], "cust")], held, out, state))
    rows = spark.read.parquet(out).withColumns({"pos": F.col("batch").cast("bigint"), "sub": F.lit(0)}).drop("batch", "stream")
    return state_of_kinds(rows, ["k"])


# ---------------------------------------------------------------- transactions over micro-batches

def _arrivals(log):
    """Rows with the number of the cut they come in: commits and rollbacks one cut after their write, and every row once more
    in the cut after that. Before each cut, every region resolves what was committed before its first row; at the end it
    resolves its last start."""
    at = F.col("start_ts")
    cut = F.lit(0)
    for low, _ in CUTS[1:]:
        cut = cut + (at >= low).cast("int")
    late = F.col("log_type").isin("COMMIT", "ROLLBACK").cast("int")
    sent = log.select("*", F.explode(F.array(cut + late, cut + late + 1)).alias("arrival"))
    starts = F.explode(F.array(*[F.struct(F.lit(i).alias("arrival"), F.lit(low - 1).cast("bigint").alias("commit_ts")) for i, (low, _) in enumerate(CUTS)]))
    last = log.groupBy("region").agg(F.max("start_ts").alias("commit_ts")).withColumn("arrival", F.lit(len(CUTS) + 1))
    beats = log.select("region").distinct().select("region", starts.alias("_s")).select("region", "_s.*").unionByName(last)
    return sent.unionByName(beats.withColumn("log_type", F.lit(transactions.RESOLVED)), allowMissingColumns=True)


@query("s18_stream_committed", f"""{_KV}, p AS (SELECT k % 8 AS region, max(pos) AS ts FROM log GROUP BY 1)
SELECT region, key, start_ts, commit_ts, op, value FROM kv WHERE commit_ts <= (SELECT min(ts) FROM p)""")
def s18_stream(spark, sf):
    """Writes split over micro-batches and sent twice, emitted as all regions resolve them."""
    log = kv_log(spark, sf)
    sent = _arrivals(log)
    source, state, out, check = (scratch_dir(spark, n) for n in ("log", "open", "committed", "state"))
    # What a region resolves is written after the rows that it speaks of, so batches may be cut between any two files.
    says = F.col("log_type") == transactions.RESOLVED
    for n in range(len(CUTS) + 2):
        for rows in (sent.where(~says), sent.where(says)):
            rows.where(F.col("arrival") == n).select(*log.columns).write.mode("append").parquet(source)
    finish(transactions.stream_committed(_stream(spark, log, source), state, out, check))
    done = spark.read.schema(log.drop("log_type").schema).parquet(out)
    return done.select("region", F.decode("key", "UTF-8").alias("key"), "start_ts", "commit_ts", "op", "value")
