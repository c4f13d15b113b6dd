"""Keyed tables and streams: replays, crashes, compaction, late events."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from changeloom.operators import changelog as L
from changeloom.plans.common import finish
from changeloom.session import scratch_dir
from changeloom.sources import envelope, log as logs
from changeloom.streaming import keyed_state, sinks, streams as W, transactions
from changeloom.streaming.files import Folder

SHAPE = ("db string, schema string, table string, op string, pos bigint, sub int, event_ts bigint, fetch_ts bigint, "
         "key struct<id:int>, before struct<id:int,v:string>, after struct<id:int,v:string>")


def batch(spark, *events, table="t"):
    rows = [("d", None, table, op, pos, 0, pos, pos, (k,), None, (k, v) if v else None) for op, pos, k, v in events]
    return spark.createDataFrame(rows, SHAPE)


def state(spark, path, df, **kw):
    return sorted(tuple(r) for r in sinks.read_table(spark, path, df.schema, **kw).collect())


def test_upserts_deletes_and_replays(spark):
    path = scratch_dir(spark, "t")
    first = batch(spark, ("c", 1, 1, "a"), ("c", 2, 2, "b"), ("u", 3, 1, "c"))
    assert sinks.upsert_batch(first, path, 0)
    assert not sinks.upsert_batch(first, path, 0)
    second = batch(spark, ("d", 4, 2, None), ("c", 5, 3, "z"))
    assert sinks.upsert_batch(second, path, 1)
    assert state(spark, path, first) == [(1, "c"), (3, "z")]
    assert sorted(tuple(r) for r in L.materialize(sinks.read_changes(spark, path, first.schema, before=1)).collect()) == [(1, "c"), (2, "b")]


def test_an_unfinished_attempt_is_overwritten(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, ("c", 1, 1, "a"))
    # A crash left data without a commit.
    sinks.write_batch(batch(spark, ("c", 1, 9, "lost"), ("c", 2, 8, "lost")), path, 0)
    assert state(spark, path, df) == []
    sinks.upsert_batch(df, path, 0)
    assert state(spark, path, df) == [(1, "a")]


def test_compaction_keeps_the_state(spark):
    path = scratch_dir(spark, "t")
    want = {}
    for i in range(8):
        k = i % 3
        want[k] = f"v{i}"
        df = batch(spark, ("u", i + 1, k, f"v{i}"))
        sinks.upsert_batch(df, path, i, compact_every=2)
        assert state(spark, path, df) == sorted(want.items())
        table = sinks.load(spark, path)
        assert max(len(table.folders(b)) for b in range(table.buckets)) <= 4
    sinks.upsert_batch(batch(spark, ("d", 99, 0, None)), path, 8)
    sinks.compact(spark, path, df.schema)
    # A deleted key is kept with its position, so that a late change does not bring it back.
    assert [r.pos for r in sinks.read_changes(spark, path, df.schema).where("op = 'd'").collect()] == [99]
    assert (0, "v6") not in state(spark, path, df)
    late = batch(spark, ("u", 50, 0, "late"))
    assert W.late_change_guard(late, path).count() == 0
    sinks.upsert_batch(late, path, 9)
    assert state(spark, path, df) == [(1, "v7"), (2, "v5")]


def test_a_writer_that_commits_after_a_fold_of_another_loses_nothing(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, ("c", 1, 1, "a"), ("c", 2, 2, "b"))
    sinks.upsert_batch(df, path, 0)
    held = {**sinks.write_batch(batch(spark, ("c", 3, 3, "c")), path, 1), "stream": "A"}      # written, not committed
    for i, k in ((2, 4), (3, 5), (4, 6)):
        sinks.upsert_batch(batch(spark, ("c", k, k, f"v{k}")), path, i, compact_every=1)
    sinks.compact(spark, path, df.schema)
    assert sinks.commit_batch(spark, path, held) and not sinks.commit_batch(spark, path, held)
    sinks.compact(spark, path, df.schema)
    assert state(spark, path, df) == [(1, "a"), (2, "b"), (3, "c"), (4, "v4"), (5, "v5"), (6, "v6")]


def test_of_two_folds_at_a_time_one_counts(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, ("c", 1, 1, "a"))
    for i in range(4):
        sinks.upsert_batch(batch(spark, ("u", i + 1, 1, f"v{i}")), path, i, buckets=1)
    load, seen = sinks.load, []

    def stale(spark, path):
        # The first look of the outer fold is followed by a whole fold of another writer.
        table = load(spark, path)
        if not seen:
            seen.append(1)
            sinks.compact(spark, path, df.schema)
        return table
    sinks.load = stale
    try:
        sinks.compact(spark, path, df.schema)
    finally:
        sinks.load = load
    table = load(spark, path)
    assert len(table.folders(0)) == 2 and state(spark, path, df) == [(1, "v3")]


def test_writers_in_parallel(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, ("c", 1, 1, "a"))
    sinks.open_table(spark, path, 4)

    def write(w):
        for i in range(3):
            held = sinks.write_batch(batch(spark, ("c", 10 * w + i, 10 * w + i, f"v{w}{i}")), path, 100 * w + i)
            assert sinks.commit_batch(spark, path, {**held, "stream": f"s{w}"})
            sinks.compact(spark, path, df.schema)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    assert state(spark, path, df) == sorted((10 * w + i, f"v{w}{i}") for w in range(4) for i in range(3))


def test_a_fold_rewrites_only_the_buckets_that_are_due(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, *[("c", k, k, "a") for k in range(1, 200)])
    sinks.upsert_batch(df, path, 0, buckets=8)
    for i in range(4):
        sinks.upsert_batch(batch(spark, ("u", 1000 + i, 7, f"b{i}")), path, i + 1, compact_every=2)
    table = sinks.load(spark, path)
    folded = {name: b for name, b in table.live.items() if name.startswith("fold")}
    own = sinks.touched_buckets(batch(spark, ("u", 1, 7, "x")), ("key",), table)
    assert len(own) == 1 and list(folded.values()) == [own]
    got = state(spark, path, df)
    assert len(got) == 199 and (7, "b3") in got
    # Reading some buckets reads their files only.
    some = sinks.read_changes(spark, path, df.schema, buckets=own)
    assert all(f"/bucket={next(iter(own))}/" in f for f in some.inputFiles())


def test_small_folders_are_folded_without_the_large_ones(spark):
    path = scratch_dir(spark, "t")
    df = batch(spark, *[("c", k, k, f"value {k}") for k in range(1, 3000)])
    sinks.upsert_batch(df, path, 0, buckets=1)
    for i in range(1, 8):
        sinks.upsert_batch(batch(spark, ("u", 10_000 + i, i, f"b{i}")), path, i, compact_every=1)
    table = sinks.load(spark, path)
    assert "delta-batch-0" in table.live and len(table.folders(0)) <= 6
    got = state(spark, path, df)
    assert len(got) == 2999 and all((i, f"b{i}") in got for i in range(1, 8))
    sinks.compact(spark, path, df.schema)
    assert "delta-batch-0" not in sinks.load(spark, path).live and state(spark, path, df) == got


def test_folds_write_a_row_as_often_as_a_table_doubles():
    table = sinks.Table()
    table.apply({"version": 0, "kind": "create", "buckets": 1})
    written = 0
    for i in range(256):
        table.apply({"version": 1, "kind": "add", "stream": f"s{i}", "batch_id": 0, "data": f"d{i}", "in": [0], "bytes": {"0": 10}, "time": 0})
        names = table.small(0, table.foldable(0, 10 ** 15))
        if len(names) > 1:
            size = sum(table.bytes[n]["0"] for n in names)
            written += size
            table.apply({"version": 1, "kind": "fold", "data": f"f{i}", "bytes": {"0": size}, "replaces": {"0": names}})
        assert len(table.folders(0)) <= 9
    assert written <= 256 * 10 * 8 and sinks.Table(table.said()).said() == table.said()


def test_commits_are_put_together_and_old_files_removed(spark, monkeypatch):
    monkeypatch.setattr(sinks, "STATE_EVERY", 5)
    path = scratch_dir(spark, "t")
    df = batch(spark, ("c", 1, 1, "a"))
    for i in range(7):
        sinks.upsert_batch(batch(spark, ("u", i + 1, i % 2, f"v{i}")), path, i, compact_every=2, buckets=2)
    want, before = state(spark, path, df), sinks.load(spark, path)
    commits = sinks._commits(spark, path)
    assert any(n.endswith(".state.json") for n in commits.names())
    sinks.vacuum(spark, path, older_than_ms=-1)
    left = [n for n in commits.names() if not n.endswith(".state.json")]
    assert len(left) <= 6 and sinks.load(spark, path).said() == before.said() and state(spark, path, df) == want
    names = sinks.Folder(spark, f"{path}/data").names()
    assert {n[2:] for n in names if n.startswith("v=")} == set(before.live)
    # A writer that looked before the removal finds its number free, but not usable.
    first = sinks.load
    old = [sinks.Table({"version": 0, "buckets": 2})]
    held = sinks.write_batch(batch(spark, ("c", 99, 5, "late")), path, 50)
    monkeypatch.setattr(sinks, "load", lambda *a: old.pop() if old else first(*a))
    assert sinks.commit_batch(spark, path, held)
    monkeypatch.setattr(sinks, "load", first)
    assert (5, "late") in state(spark, path, df) and "00000000000000000001.json" not in commits.names()


@pytest.mark.parametrize("local", [True, False])
def test_a_claim_is_won_once(spark, local):
    folder = Folder(spark, scratch_dir(spark, "claims"))
    if not local:
        folder.local = None
    assert folder.names() == {}
    assert folder.claim("1.json", "first Ü") and not folder.claim("1.json", "second") and folder.read("1.json") == "first Ü"
    assert list(folder.names()) == ["1.json"]
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda i: folder.claim("2.json", str(i)), range(8))) == 1 or not local


def test_lake_keys_tables_apart(spark):
    path = scratch_dir(spark, "t")
    both = batch(spark, ("c", 1, 1, "a")).unionByName(batch(spark, ("c", 2, 1, "b"), table="u"))
    sinks.upsert_batch(both, path, 0, sinks.LAKE_KEY, ("db", "table"))
    sinks.upsert_batch(batch(spark, ("u", 3, 1, "x"), table="u"), path, 1, sinks.LAKE_KEY, ("db", "table"))
    got = sinks.read_table(spark, path, both.schema, sinks.LAKE_KEY)
    assert sorted((r.table, r.v) for r in got.collect()) == [("t", "a"), ("u", "x")]


def test_late_events_are_dropped(spark):
    path = scratch_dir(spark, "t")
    sinks.upsert_batch(batch(spark, ("u", 10, 1, "new")), path, 0)
    late = batch(spark, ("u", 9, 1, "old"), ("u", 10, 1, "same"), ("u", 11, 1, "next"), ("u", 3, 2, "other"))
    assert sorted(r.pos for r in W.late_change_guard(late, path).collect()) == [3, 11]


def test_normalize_survives_a_replay(spark):
    path = scratch_dir(spark, "t")
    batches = [batch(spark, ("u", 1, 1, "a"), ("u", 2, 1, "b")), batch(spark, ("d", 3, 1, None), ("u", 4, 1, "c"), ("u", 1, 1, "late"))]

    def run(i):
        got = W.normalize_batch(batches[i], path, i).sort("pos").collect()
        return [(r.op, r.pos, r.before.v if r.before else None, r.after.v if r.after else None) for r in got]
    want = [[("c", 1, None, "a"), ("u", 2, "a", "b")], [("d", 3, "b", None), ("c", 4, None, "c")]]
    for i in range(2):
        assert run(i) == want[i]
        sinks.upsert_batch(batches[i], path, i)
        assert run(i) == want[i]      # crashed after the state was written, before the batch was done


def test_stream_restarts_exactly_once(spark):
    source, path, check = (scratch_dir(spark, n) for n in ("in", "t", "c"))
    df = batch(spark, ("c", 1, 1, "a"), ("c", 2, 2, "b"))
    df.write.parquet(source)
    for more in (None, ("u", 3, 1, "c"), ("d", 4, 2, None), None):
        if more:
            batch(spark, more).write.mode("append").parquet(source)
        stream = logs.read_log(spark, source, df.schema, stream=True, files_per_trigger=1)
        finish(sinks.upsert_sink(stream, path, check))
    assert state(spark, path, df) == [(1, "c")]


def test_failed_stream_is_reported(spark):
    source = scratch_dir(spark, "in")
    df = batch(spark, ("c", 1, 1, "a"))
    df.write.parquet(source)
    stream = logs.read_log(spark, source, df.schema, stream=True)

    def broken(batch, batch_id):
        raise RuntimeError("broken sink")
    with pytest.raises(Exception, match="broken sink"):
        finish(stream.writeStream.foreachBatch(broken).option("checkpointLocation", scratch_dir(spark, "c")).trigger(availableNow=True).start())


def test_stream_enrich_replays_a_half_done_batch(spark):
    source, held, out = (scratch_dir(spark, n) for n in ("in", "held", "out"))
    fact = batch(spark, ("c", 1, 1, "x"), ("c", 2, 2, "y"), table="f")
    dim = batch(spark, ("c", 3, 1, "name"), table="g").withColumn(
        "after", F.struct(F.col("after.id").alias("id"), F.col("after.v").alias("label")))
    texts = envelope.changes_to_json(fact).unionByName(envelope.changes_to_json(dim.withColumn(
        "before", F.lit(None).cast("struct<id:int,label:string>"))))
    texts.coalesce(1).write.parquet(source)

    def run(check):
        stream = logs.read_log(spark, source, "value string", stream=True, files_per_trigger=1)
        finish(W.stream_enrich(stream, W.Side("f", "id int, v string", ["id"]),
                               [W.Side("g", "id int, label string", ["id"], "id")], held, out, check))
        return sorted((tuple(r) for r in spark.read.parquet(out).select("row_kind", "id", "v", "label").collect()), key=str)
    want = [("+I", 1, "x", "name"), ("+I", 2, "y", None)]
    assert run(scratch_dir(spark, "c")) == want
    # The same batch again from a lost checkpoint: the states already hold it, the output is the same.
    assert run(scratch_dir(spark, "c")) == want


def by_state(spark, source, out, check, df, guard=False):
    stream = logs.read_log(spark, source, df.schema, stream=True, files_per_trigger=1)
    query = (keyed_state.late_guard if guard else keyed_state.normalize)(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", check).trigger(availableNow=True).start()
    finish(query)
    return query


def test_state_store_gives_before_images_over_a_restart(spark):
    source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
    df = batch(spark, ("u", 1, 1, "a"), ("u", 2, 1, "b"), ("u", 2, 1, "b"), ("r", 1, 2, "x"))
    df.coalesce(1).write.parquet(source)
    by_state(spark, source, out, check, df)
    batch(spark, ("d", 5, 1, None), ("u", 1, 1, "late"), ("u", 9, 1, "c"), ("u", 7, 2, "y")).coalesce(1).write.mode("append").parquet(source)
    by_state(spark, source, out, check, df)
    got = sorted(((r.key.id, r.pos, r.op, r.before and r.before.v, r.after and r.after.v) for r in spark.read.schema(df.schema).parquet(out).collect()))
    assert got == [(1, 1, "c", None, "a"), (1, 2, "u", "a", "b"), (1, 5, "d", "b", None), (1, 9, "c", None, "c"), (2, 1, "r", None, "x"), (2, 7, "u", "x", "y")]


def test_state_store_drops_late_changes_of_deleted_keys_too(spark):
    source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
    df = batch(spark, ("u", 10, 1, "new"), ("d", 20, 2, None))
    df.coalesce(1).write.parquet(source)
    by_state(spark, source, out, check, df, guard=True)
    batch(spark, ("u", 9, 1, "old"), ("u", 10, 1, "same"), ("u", 11, 1, "next"), ("c", 19, 2, "back"), ("c", 3, 3, "other")).coalesce(1).write.mode("append").parquet(source)
    by_state(spark, source, out, check, df, guard=True)
    assert sorted(r.pos for r in spark.read.schema(df.schema).parquet(out).collect()) == [3, 10, 11, 20]


@pytest.mark.parametrize("keys", [50, 500])
def test_a_batch_touches_the_state_of_its_keys_only(spark, keys):
    source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
    df = batch(spark, *[("c", k, k, "a") for k in range(1, keys + 1)])
    df.coalesce(1).write.parquet(source)
    by_state(spark, source, out, check, df)
    batch(spark, ("u", 10 ** 6, 7, "b")).coalesce(1).write.mode("append").parquet(source)
    query = by_state(spark, source, out, check, df)
    done = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(done) == 1 and len(done[0]["sources"]) == 1
    assert done[0]["stateOperators"][0]["numRowsUpdated"] == 1 and done[0]["stateOperators"][0]["numRowsTotal"] == keys


def test_stream_enrich_reads_the_buckets_it_touches(spark, monkeypatch):
    source, held, out, check = (scratch_dir(spark, n) for n in ("in", "held", "out", "c"))

    def dim(*events):
        rows = batch(spark, *events, table="g")
        return rows.withColumns({c: F.struct(F.col(f"{c}.id").alias("g"), F.col(f"{c}.v").alias("label")) for c in ("after",)}).withColumns(
            {"key": F.struct(F.col("key.id").alias("g")), "before": F.when(F.col("op") == "u", F.struct(F.col("after.g").alias("g"), F.lit("old").alias("label")))})

    def fact(*events):
        rows = batch(spark, *events, table="f")
        image = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.id").alias("id"), (F.col(f"{c}.id") % 40).cast("int").alias("g")))
        return rows.withColumns({"after": image("after"), "before": F.lit(None).cast("struct<id:int,g:int>")})

    def run(*parts):
        texts = None
        for p in parts:
            text = envelope.changes_to_json(p)
            texts = text if texts is None else texts.unionByName(text)
        texts.coalesce(1).write.mode("append").parquet(source)
        stream = logs.read_log(spark, source, "value string", stream=True)
        finish(W.stream_enrich(stream, W.Side("f", "id int, g int", ["id"]), [W.Side("g", "g int, label string", ["g"], "g")], held, out, check))
    run(fact(*[("c", i, i, "x") for i in range(1, 401)]), dim(*[("c", 1000 + i, i, "old") for i in range(40)]))
    read = {}
    plain = W.read_changes

    def watched(spark, path, schema, before=None, buckets=None):
        read[path.rsplit("/", 1)[1]] = buckets
        return plain(spark, path, schema, before, buckets)
    monkeypatch.setattr(W, "read_changes", watched)
    run(dim(("u", 5000, 7, "new")))
    rows = spark.read.parquet(f"{out}").where("batch = 1")
    assert sorted((r.row_kind, r.id, r.label) for r in rows.collect()) == sorted(
        [(k, i, v) for i in range(7, 401, 40) for k, v in (("-U", "old"), ("+U", "new"))])
    assert len(read["f-by-g"]) == 1 and len(read["g"]) == 1 and 1 <= len(read["f"]) <= 10


KV_LOG = "region int, log_type string, key string, start_ts bigint, commit_ts bigint, op string, value string"


def transactions_of(spark, path, *batches):
    """(key, start, commit, value) emitted by each batch, and the keys open after the last."""
    found = []
    for n, rows in enumerate(batches):
        df = spark.createDataFrame([(*r, "c", f"v{r[3]}") if r[1] in ("PREWRITE", "COMMITTED") else (*r, None, None) for r in rows], KV_LOG)
        found.append(sorted((r.key, r.start_ts, r.commit_ts, r.value) for r in transactions.apply_batch(df, path, n).collect()))
    return found, sorted(r.key for r in transactions.open_writes(spark, path, df, n).collect())


def said(region, ts):
    return region, "RESOLVED", None, None, ts


def test_transactions_over_batches(spark):
    first = [(1, "PREWRITE", "a", 10, None), (1, "PREWRITE", "b", 11, None), (2, "PREWRITE", "c", 12, None), (2, "COMMITTED", "d", 5, 6), said(1, 9)]
    # Region 2 has resolved nothing, so nothing is safe; then a's commit is past the frontier, b is rolled back.
    second = [(1, "COMMIT", "a", 10, 20), (1, "ROLLBACK", "b", 11, None), (1, "COMMITTED", "d", 5, 6), said(2, 10)]
    third = [(1, "PREWRITE", "b", 11, None), (1, "COMMIT", "a", 10, 20), (2, "COMMIT", "c", 12, 13), said(1, 30), said(2, 15)]
    # All of it once more, and the frontier past everything.
    fourth = [*first[:4], *second[:3], *third[:3], said(2, 40)]
    found, left = transactions_of(spark, scratch_dir(spark, "kv"), first, second, third, fourth)
    # The frontier stood at 9 in the second batch, at 15 in the third and at 30 in the fourth.
    assert found == [[], [("d", 5, 6, "v5")], [("c", 12, 13, "v12")], [("a", 10, 20, "v10")]] and left == []


def test_transactions_of_a_new_region_and_lost_halves(spark):
    path = scratch_dir(spark, "kv")
    first = [(1, "COMMITTED", "a", 1, 2), (1, "PREWRITE", "x", 3, None), (1, "COMMIT", "y", 3, 4), said(1, 20)]
    # Region 3 joins with a commit before the frontier of region 1: it is held, not taken for a repetition.
    second = [(3, "COMMITTED", "n", 7, 8), (1, "COMMITTED", "a", 1, 2), said(1, 25)]
    found, left = transactions_of(spark, path, first, second)
    assert found == [[("a", 1, 2, "v1")], []] and left == ["n"]
    # A batch that is replayed gives the same rows.
    for _ in range(2):
        df = spark.createDataFrame([(*said(3, 10), None, None)], KV_LOG)
        assert [r.key for r in transactions.apply_batch(df, path, 2).collect()] == ["n"]
    assert transactions.open_writes(spark, path, df, 2).count() == 0


def test_transactions_restart_and_forget_old_batches(spark):
    source, state_path, out, check = (scratch_dir(spark, n) for n in ("in", "open", "out", "c"))
    batches = [[(1, "PREWRITE", "a", 1, None, "c", "v"), (*said(1, 0), None, None)], [(1, "COMMIT", "a", 1, 2, None, None)], [(*said(1, 5), None, None)]]
    for rows in batches:
        spark.createDataFrame(rows, KV_LOG).coalesce(1).write.mode("append").parquet(source)
        finish(transactions.stream_committed(logs.read_log(spark, source, KV_LOG, stream=True, files_per_trigger=1), state_path, out, check))
    rows = spark.read.parquet(f"{out}/stream=*").collect()
    assert [(r.key, r.commit_ts, r.value) for r in rows] == [("a", 2, "v")]
    held = Folder(spark, state_path)
    assert sorted(Folder(spark, f"{state_path}/{next(iter(held.names()))}").names()) == ["batch=1", "batch=2"]


def test_snapshot_rows_are_forgotten_after_the_snapshot(spark):
    source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
    df = batch(spark, ("r", 0, 1, "a"), ("r", 0, 2, "b"), ("r", 0, 1, "a"), ("c", 5, 9, "log"))
    end = batch(spark, (keyed_state.COMPLETE, 1000, 0, None))

    def run(rows):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = logs.read_log(spark, source, df.schema, stream=True, files_per_trigger=1)
        query = keyed_state.dedup_snapshot(stream, ["db", "table", "key"], 500, buckets=4).writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        finish(query)
        return sorted(r.key.id for r in spark.read.schema(df.schema).parquet(out).collect()), query.lastProgress.stateOperators[0].numRowsTotal
    assert run(df)[0] == [1, 2]
    # Copies after the end but within the delay are told, also those of other tables are kept apart.
    assert run(end.unionByName(batch(spark, ("r", 0, 2, "b"))).unionByName(batch(spark, ("r", 0, 2, "b"), table="other")))[0] == [1, 2, 2]
    before = run(batch(spark, ("u", 1400, 9, "x"), ("r", 0, 1, "a")))
    assert before[0] == [1, 2, 2] and before[1] > 1
    run(batch(spark, ("u", 1600, 9, "x")))
    run(batch(spark, ("u", 1700, 9, "x")))
    # Only the other table's row and the count of its group are left.
    found, left = run(batch(spark, ("u", 1800, 9, "x")))
    assert found == [1, 2, 2] and left < before[1]


@pytest.mark.parametrize("guard", [False, True])
def test_state_in_buckets_gives_the_same(spark, guard):
    big = 2 ** 60 + 1
    first = batch(spark, *[("u", k % 3 + 1, k, f"v{k}") for k in range(1, 60)], ("u", big, 5, "far"), ("u", 2, 5, "near"))
    second = batch(spark, *[("u", 2, k, "late or not") for k in range(1, 60)], ("d", big + 1, 5, None), ("u", big, 5, "same"), ("c", big + 2, 5, "back"))
    # A number that is null in some rows stays exact in the others.
    first, second = (df.withColumn("event_ts", F.when(F.col("pos") != 2, F.lit(big))) for df in (first, second))

    def run(buckets):
        source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
        for rows in (first, second):
            rows.coalesce(1).write.mode("append").parquet(source)
            stream = logs.read_log(spark, source, first.schema, stream=True, files_per_trigger=1)
            by = keyed_state.late_guard if guard else keyed_state.normalize
            query = by(stream, buckets).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
            finish(query)
        done = [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]
        return sorted(map(str, spark.read.schema(first.schema).parquet(out).collect())), done["numRowsTotal"]
    (want, keys), (got, buckets) = run(None), run(4)
    assert got == want and keys == 59 and buckets == 4


def test_a_long_stream_is_waited_for():
    class Query:
        waited = []

        def awaitTermination(self, timeout=None):
            self.waited.append(timeout)
            return timeout is None

        def stop(self):
            self.waited.append("stopped")

        def exception(self):
            return None
    query = Query()
    finish(query)
    assert query.waited == [None]


def test_snapshot_rows_of_a_bucket_are_one_value(spark):
    source, out, check = (scratch_dir(spark, n) for n in ("in", "out", "c"))
    df = batch(spark, *[("r", 0, k, "a") for k in range(1, 201)] * 2)
    df.coalesce(1).write.parquet(source)
    stream = logs.read_log(spark, source, df.schema, stream=True)
    query = keyed_state.dedup_snapshot(stream, ["db", "table", "key"], buckets=4).writeStream.format("parquet").option(
        "path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
    finish(query)
    assert spark.read.schema(df.schema).parquet(out).count() == 200
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) == 4


def test_a_batch_of_normalize_is_put_together_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value
    look, first = F.udf(look, "bigint").asNondeterministic(), W.dedup_at_least_once
    monkeypatch.setattr(W, "dedup_at_least_once", lambda df, by: first(df, by).withColumn("fetch_ts", look("fetch_ts")))
    source, held, out, check = (scratch_dir(spark, n) for n in ("in", "held", "out", "c"))
    df = batch(spark, ("u", 1, 1, "a"), ("u", 2, 1, "b"), ("r", 1, 2, "x"))
    df.coalesce(1).write.parquet(source)
    finish(W.stream_normalize(logs.read_log(spark, source, df.schema, stream=True), held, out, check))
    got = sorted((r.pos, r.op, r.before and r.before.v) for r in spark.read.schema(df.schema).parquet(f"{out}/stream=*").collect())
    assert got == [(1, "c", None), (1, "r", None), (2, "u", "a")] and seen.value == 3
