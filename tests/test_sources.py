"""Capture rules, startup positions, record kinds, envelopes and transaction logs."""

import json

import pytest
from pyspark.sql import functions as F

from changeloom.operators import changelog, progress
from changeloom.session import scratch_dir
from changeloom.sources import capture, changestream, envelope, keyvalue, log as logs, position, snapshot as snaps

SHAPE = "db string, table string, op string, pos bigint, sub int, event_ts bigint"


def names(spark, *full):
    return spark.createDataFrame([tuple(n.split(".")) for n in full], "db string, table string")


@pytest.mark.parametrize("full, want", [
    ("txc.tt", True), ("test2.test5", False), ("test2.t5", True), ("cdcp.t8", True), ("tpc1.tt", True), ("abc.t5", False), ("cdcp.t9", False),
    ("tt.t7", True), ("xtxc.tt", False)])
def test_pattern_golden(spark, full, want):
    got = capture.capture_tables(names(spark, full), ["^(test).*", "^(tpc).*", "txc", ".*[p$]", "t{2}"], ["t[5-8]", "tt"])
    assert (got.count() == 1) == want


def test_single_pattern_matches_whole_names(spark):
    pattern = "(^(test).*|^(tpc).*|txc|.*[p$]|t{2}).(t[5-8]|tt)"
    got = names(spark, "txc.tt", "test2.test5", "abc.t5", "cdcp.t9").where(F.concat_ws(".", "db", "table").rlike(f"^(?:{pattern})$"))
    assert sorted(r.db for r in got.collect()) == ["test2", "txc"]


def test_lists_add_to_patterns_and_none_means_all(spark):
    df = names(spark, "a.x", "a.y", "b.x")
    assert capture.capture_tables(df).count() == 3
    assert capture.capture_tables(df, table_list=["b.x"]).count() == 1
    assert capture.capture_tables(df, ["a"], ["y"], ["b.x"]).count() == 2
    assert capture.capture_tables(df, databases=["a"]).count() == 2
    assert capture.capture_tables(df, tables=["x"]).count() == 2


def events(spark):
    rows = [("d", "t", "r", 0, 0, 0)] + [("d", "t", "u", p, s, 1000 + p) for p in (10, 20, 30, 40) for s in (0, 1, 2)]
    return spark.createDataFrame(rows, SHAPE)


def at(df):
    return sorted((r.pos, r["sub"]) for r in df.collect())


def test_startup_modes(spark):
    df = events(spark)
    assert len(at(capture.start_from(df))) == 13
    assert at(capture.start_from(df, "initial-only")) == [(0, 0)]
    assert len(at(capture.start_from(df, "earliest-offset"))) == 12
    assert at(capture.start_from(df, "latest-offset")) == []
    assert at(capture.start_from(df, "latest-offset", now_pos=30))[0] == (40, 0)
    assert at(capture.start_from(df, "timestamp", timestamp_ms=1030))[0] == (30, 0)
    assert at(capture.start_from(df, "specific-offset", offset=15))[0] == (20, 0)
    assert at(capture.start_from(df, "specific-offset", offset=15, skip_events=1, skip_rows=2))[0] == (30, 2)
    assert at(capture.start_from(df, "specific-offset", offset=15, skip_rows=1))[:2] == [(20, 1), (20, 2)]
    assert at(capture.start_from(df, "specific-offset", offset=15, skip_events=3)) == []


def test_sources_refuse_modes_they_do_not_have(spark):
    for source, mode in (("oracle", "timestamp"), ("postgres", "latest-offset"), ("tidb", "specific-offset"), ("base", "earliest-offset")):
        with pytest.raises(ValueError):
            capture.start_from(events(spark), mode, source=source)
    assert capture.start_from(events(spark), "initial-only", source="sqlserver").count() == 1


def test_declared_columns(spark):
    df = spark.createDataFrame([("7", "x")], "Id string, NAME string")
    assert capture.declare(df, {"id": "int", "name": "string"}).first() == (7, "x")
    with pytest.raises(ValueError):
        capture.declare(df, {"id": "int"}, case_sensitive=True)
    assert capture.declare(df, {"NAME": "string"}, case_sensitive=True).columns == ["NAME"]
    with pytest.raises(ValueError):
        capture.with_metadata(df, ["nope"])


def test_record_kinds(spark):
    rows = [("srv.t", "srv.t.Key", "{}", 1), ("srv.t", "srv.t.Key", None, 2), ("__heartbeat.srv", "Beat", "{}", 3),
            ("srv", "io.connector.mysql.SchemaChangeKey", json.dumps({"source": {"db": "d", "table": "t"}, "historyRecord": '{"v":1}'}), 4), (None, None, "{}", 5)]
    df = spark.createDataFrame(rows, "topic string, key_schema string, value string, pos bigint")
    assert sorted(r.pos for r in logs.drop_tombstones(df).collect()) == [1, 3, 4, 5]
    data, beats = logs.split_heartbeats(df)
    assert sorted(r.pos for r in data.collect()) == [1, 2, 4, 5] and beats.first().pos == 3
    kept, history = logs.split_schema_changes(df)
    assert sorted(r.pos for r in kept.collect()) == [1, 2, 3, 5] and tuple(history.first()) == (4, "d", "t", '{"v":1}')
    assert logs.split_schema_changes(df, include=True)[0].count() == 5


GOLDEN = {"before": None, "after": {"id": 111, "name": "scooter", "description": "Big 2-wheel scooter", "weight": 5.15, "price": 12345678901234567.89},
          "source": {"db": "inv", "schema": None, "table": "products", "ts_ms": 5, "file": "f", "pos": 7, "row": 1}, "op": "c", "ts_ms": 1589362330904, "transaction": None}


def test_envelope_keeps_numbers_exact(spark):
    raw = spark.createDataFrame([(json.dumps(GOLDEN).replace("1.2345678901234568e+16", "12345678901234567.89"),)], "value string")
    row = envelope.decode_envelope(raw, "id int, name string, description string, weight double, price decimal(20,2)", ["id"]).first()
    assert (row.db, row.table, row.op, row.pos, row["sub"], row.event_ts, row.fetch_ts) == (
        "inv", "products", "c", 7, 2, 5, 1589362330904)
    assert str(row.after.price) == "12345678901234567.89" and row.before is None and row.key.id == 111


def envelopes(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")


def test_later_file_wins_over_higher_position(spark):
    raw = envelopes(spark, *[{"op": "u", "before": {"id": 1, "v": "x"}, "after": {"id": 1, "v": v}, "source": {"file": f, "pos": p}}
                             for f, p, v in (("bin.000001", 900, "old"), ("bin.000002", 4, "new"))])
    rows = envelope.decode_envelope(raw, "id int, v string", ["id"])
    assert changelog.materialize(rows).first().v == "new"
    assert [r.after.v for r in capture.start_from(rows, "specific-offset", offset=("bin.000002", 1)).collect()] == ["new"]


def test_key_move_and_next_row_of_one_event_are_apart(spark):
    def event(row, before, after):
        return {"op": "u", "before": {"id": before}, "after": {"id": after}, "source": {"pos": 10, "row": row}}
    rows = envelope.decode_envelope(envelopes(spark, event(0, 1, 2), event(1, 2, 2)), "id int", ["id"])
    split = changelog.split_key_updates(rows)
    assert sorted((r["sub"], r.op, r.key.id) for r in split.collect()) == [(0, "d", 1), (1, "c", 2), (2, "u", 2)]
    assert changelog.dedup_at_least_once(split, ("key", "pos", "sub")).count() == 3


def test_positions_of_other_sources(spark):
    event = {"op": "c", "after": {"id": 1}, "source": {"scn": "77", "lsn": 5, "commit_lsn": "00000027:00000ac0:0002"}}
    at = lambda *fields: envelope.decode_envelope(envelopes(spark, event), "id int", ["id"], position=fields).first().pos
    assert (at("scn"), at("lsn"), at("commit_lsn")) == (77, 5, (0x27 << 32) + (0xAC0 << 8) + 2)
    with pytest.raises(Exception, match="no position"):
        at("pos")


LARGE = [   # position fields, and sources in the order of the log
    (("commit_lsn", "change_lsn"), [("00000027:00000ac0:0002", "00000027:00000ac0:0001"), ("00000027:00000ac0:0002", "00000027:00000ac0:0100"),
                                    ("00000028:00000001:0001", "00000028:00000000:0001"), ("ffffffff:ffffffff:fffe", "1"), ("ffffffff:ffffffff:ffff", "0")]),
    (("scn", "commit_scn", "n"), [(2 ** 31 - 1, 9, 9), (2 ** 31, 2 ** 32, 0), (2 ** 31, 2 ** 32, 1), (2 ** 32, 5, 0), (2 ** 63, 0, 0)])]


@pytest.mark.parametrize("fields,places", LARGE)
def test_large_positions_keep_their_order(spark, fields, places):
    events = [{"op": "c", "after": {"id": 1, "n": i}, "source": dict(zip(fields, p))} for i, p in enumerate(places)]
    rows = envelope.decode_envelope(envelopes(spark, *events), "id int, n int", ["id"], position=fields)
    assert [r.after.n for r in rows.orderBy("pos").collect()] == list(range(5))
    assert changelog.materialize(rows).first().n == 4 and changelog.dedup_at_least_once(rows).count() == 5
    assert sorted(r.after.n for r in capture.start_from(rows, "specific-offset", offset=places[2]).collect()) == [2, 3, 4]
    assert capture.start_from(rows, "latest-offset").count() == 0
    snap = rows.limit(1).withColumns({"op": F.lit("r"), "pos": F.lit(0).cast("bigint"), "db": F.lit("d"), "table": F.lit("t")})
    both = capture.read_with_new_tables(snap, rows.withColumns({"db": F.lit("d"), "table": F.lit("t")}), rows.select("db", "table", "pos", "sub").limit(0),
                                        snap.select("db", "table"), snap.select("db", "table").withColumn("pos", F.lit(position.wide_position(*places[1]))))
    assert [(r.op, r.after.n) for r in both.orderBy("pos").collect()] == [("r", 1), ("c", 2), ("c", 3), ("c", 4)]


def test_positions_that_do_not_fit_are_errors(spark):
    def pos(source, fields, **options):
        return envelope.decode_envelope(envelopes(spark, {"op": "c", "after": {"id": 1}, "source": source}), "id int", ["id"], position=fields, **options).first().pos
    assert pos({"file": "b.7", "pos": 2 ** 32 - 1}, ("file", "pos")) == position.log_position("b.7", 2 ** 32 - 1) < position.log_position(8, 0)
    for source in ({"file": "b.7", "pos": 2 ** 32}, {"file": f"b.{2 ** 31}", "pos": 1}):
        with pytest.raises(Exception, match="does not fit"):
            pos(source, ("file", "pos"))
        assert pos(source, ("file", "pos"), wide=True) == position.wide_position(source["file"], source["pos"])
    for lsn in ("00000027:00000ac0:0100", "00000027:01000000:0001", "80000000:00000001:0001", "rubbish"):
        with pytest.raises(Exception, match="does not fit"):
            pos({"lsn": lsn}, ("lsn",))
    assert pos({"lsn": "00000027:00000ac0:0100"}, ("lsn",), wide=True) < pos({"lsn": "00000027:00000ac1:0000"}, ("lsn",), wide=True)
    with pytest.raises(ValueError):
        position.log_position(7, 2 ** 32)


def test_wire_values(spark):
    event = {"op": "c", "source": {"pos": 1}, "after": {
        "id": 1, "d": 18460, "t3": 1595008822123, "t6": 1595008822123456, "z": "2020-07-17T18:00:22Z", "s": "a,b", "none": None, "text": "2020-07-17"}}
    row = envelope.decode_envelope(envelopes(spark, event), "id int, d date, t3 timestamp_ntz, t6 timestamp_ntz, z timestamp_ntz, s array<string>, none date, text date",
                                   ["id"], units={"t3": "millis"}).first().after
    assert str(row.d) == str(row.text) == "2020-07-17" and row.none is None and row.s == ["a", "b"]
    assert (str(row.t3), str(row.t6), str(row.z)) == ("2020-07-17 18:00:22.123000", "2020-07-17 18:00:22.123456", "2020-07-17 18:00:22")


def test_changes_to_json_and_back_for_all_types(spark):
    df = spark.sql("""select 'd' db, 's' schema, 't' table, 'c' op, 1L pos, 2 sub, 1L event_ts, 2L fetch_ts, named_struct('id', 1) key,
        named_struct('id', 1, 'm', cast('-12345678901234567890123456789012345.678' as decimal(38,3)), 'p', cast('12345678901234567890123456789012345.678' as decimal(38,3)),
        'd', date'2020-02-29', 'n', timestamp_ntz'2020-02-29 01:02:03.000004', 'z', timestamp'2020-02-29 01:02:03.5', 'a', array('x,y', 'z')) after""")
    df = df.withColumn("before", F.lit(None).cast(df.schema["after"].dataType))
    text = envelope.changes_to_json(df, with_schema=True, decimal_mode="base64")
    assert envelope.decode_envelope_with_schema(text, ["id"]).select("after", "pos", "sub").collect() == df.select("after", "pos", "sub").collect()


def test_user_deserializer_keeps_integers_exact(spark):
    df = spark.createDataFrame([(2 ** 53 + 1,), (None,)], "v bigint")
    out = capture.deserialize(df, lambda r: [{"v": r["v"]}] * 2, "v bigint")
    assert sorted(r.v or 0 for r in out.collect()) == [0, 0, 2 ** 53 + 1, 2 ** 53 + 1]


def test_embedded_schema(spark):
    fields = [{"type": "int32", "field": "id"}, {"type": "bytes", "name": "x.data.Decimal", "parameters": {"scale": "4", "connect.decimal.precision": "8"}, "field": "d"},
              {"type": "bytes", "field": "b"}, {"type": "array", "items": {"type": "string"}, "field": "tags"}]
    image = {"id": 1, "d": "EtaH", "b": "AQID", "tags": ["x"]}
    schema = {"type": "struct", "fields": [{"type": "struct", "fields": fields, "field": "before"}, {"type": "struct", "fields": fields, "field": "after"}]}
    value = json.dumps({"schema": schema, "payload": {"before": None, "after": image, "source": {"db": "d", "table": "t"}, "op": "r", "ts_ms": 1}})
    raw = spark.createDataFrame([(value,)], "value string")
    row = envelope.decode_envelope_with_schema(raw, ["id"]).first()
    assert (str(row.after.d), bytes(row.after.b), row.after.tags) == ("123.4567", b"\x01\x02\x03", ["x"])
    assert list(envelope.decode_tables_with_schema(raw, {"t": ["id"]})) == ["t"]
    with pytest.raises(ValueError):
        envelope.decode_envelope_with_schema(raw.limit(0), ["id"])


def test_embedded_times_are_microseconds_of_the_day(spark):
    kinds = {"ms": ("int32", "io.debezium.time.Time"), "us": ("int64", "io.debezium.time.MicroTime"),
             "c": ("int32", "org.apache.kafka.connect.data.Time"), "plain": ("int32", "")}
    image = {"ms": 86399999, "us": 86399999000, "c": None, "plain": 5}
    fields = [{"type": t, "name": n, "field": f} for f, (t, n) in kinds.items()]
    value = json.dumps({"schema": {"type": "struct", "fields": [{"type": "struct", "fields": fields, "field": "after"}]},
                        "payload": {"after": image, "source": {"db": "d", "table": "t"}, "op": "r"}})
    row = envelope.decode_envelope_with_schema(spark.createDataFrame([(value,)], "value string"), ["ms"]).first()
    assert tuple(row.after) == (86399999000, 86399999000, None, 5)
    one = lambda name: json.dumps({"fields": [{"field": "after", "fields": [{"type": "int64", "name": name, "field": "t"}]}]})
    with pytest.raises(ValueError, match="time millis"):
        envelope.embedded_row_type(one("time.Time"), one("time.MicroTime"))


def test_base64_round_trip(spark):
    df = spark.sql("""select 'd' db, 's' schema, 't' table, 'u' op, 1L pos, 0 sub, 1L event_ts, 2L fetch_ts, named_struct('id', 1) key,
                      named_struct('id', 1, 'd', cast(-0.05 as decimal(10,2))) before, named_struct('id', 1, 'd', cast(99.99 as decimal(10,2))) after""")
    for mode in ("base64", "numeric"):
        back = envelope.decode_envelope(envelope.changes_to_json(df, decimal_mode=mode), "id int, d decimal(10,2)", ["id"], decimal_mode=mode)
        assert back.select(*df.columns).collect() == df.collect()


def test_change_stream_text_documents(spark):
    doc = {"_id": {"$oid": "a1"}, "n": {"$numberInt": "5"}}
    rows = [{"operationType": "insert", "source": {"snapshot": "true"}, "fullDocument": json.dumps(doc)},
            {"operationType": "replace", "fullDocument": doc}, {"operationType": "delete"}, {"operationType": "drop"}]
    base = {"ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": {"$oid": "a1"}}, "ts_ms": 9, "resume": 1}
    raw = spark.createDataFrame([(json.dumps({**base, **r}),) for r in rows], "value string")
    got = changestream.decode_change_stream(raw, "_id string, n int").collect()
    assert [(r.op, r.key["_id"], r.after.n if r.after else None) for r in got] == [("r", "a1", 5), ("u", "a1", 5), ("d", "a1", None)]
    with pytest.raises(ValueError):
        changestream.decode_change_stream(raw, "n int")


def test_transactions(spark):
    rows = [(1, "PREWRITE", "k1", 10, None, "u", 1), (1, "COMMIT", "k1", 10, 11, None, None),
            (1, "PREWRITE", "k2", 12, None, "u", 2), (1, "ROLLBACK", "k2", 12, None, None, None),
            (2, "PREWRITE", "k3", 13, None, "u", 3), (2, "COMMITTED", "k4", 14, 15, "c", 4), (2, "COMMIT", "k9", 1, 2, None, None),
            (2, "INITIALIZED", "k5", 1, 2, "c", 5)]
    log = spark.createDataFrame(rows, "region int, log_type string, key string, start_ts bigint, commit_ts bigint, op string, value int")
    got = keyvalue.committed_changes(log)
    assert sorted((r.key, r.commit_ts, r.value) for r in got.collect()) == [("k1", 11, 1), ("k4", 15, 4)]
    progress = spark.createDataFrame([(1, 5), (1, 12), (2, 11), (2, 9)], "region int, resolved_ts bigint")
    assert tuple(keyvalue.resolved_frontier(progress).first()) == (11, 12)
    assert [r.key for r in keyvalue.safe_to_emit(got, progress).collect()] == ["k1"]


def test_key_ranges_are_closed_open(spark):
    df = spark.createDataFrame([(bytearray(b),) for b in (b"\x00", b"\x7f", b"\x80", b"\xff", b"\xff\x00")], "key binary")
    def keys(start, end):
        return sorted(bytes(r.key) for r in keyvalue.key_range_filter(df, start, end).collect())
    assert keys(b"\x7f", b"\xff") == [b"\x7f", b"\x80"]
    assert keys(b"", b"\x80") == [b"\x00", b"\x7f"] and keys(b"\xff", None) == [b"\xff", b"\xff\x00"] and len(keys(None, b"")) == 5


def test_override_touches_the_snapshot_of_one_table_only(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    both = snaps.scan_snapshot(rows, ["id"], "d", "a").unionByName(snaps.scan_snapshot(rows, ["id"], "d", "b"))
    both = both.unionByName(both.where("table = 'a'").withColumn("op", F.lit("u")))
    got = snaps.snapshot_override(both, "d.a", "after.id > 1").collect()
    assert sorted((r.table, r.op, r.key.id) for r in got) == [("a", "r", 2), ("a", "u", 1), ("a", "u", 2), ("b", "r", 1), ("b", "r", 2)]


def test_routing(spark):
    df = names(spark, "a.x", "a.y", "a.x").withColumn("v", F.lit(1))
    parts = logs.route_tables(df, [("a", "x"), ("a", "y")])
    assert parts[("a", "x")].count() == 2 and parts[("a", "y")].count() == 1
    path = scratch_dir(spark, "routed")
    logs.write_routed(df, path)
    assert spark.read.parquet(f"{path}/db=a/table=x").count() == 2


def test_gtid_sets(spark):
    text = "AA:1-5:7:8-9, bb:3,aa:11-12:6"
    assert progress.gtid_intervals(text) == {"aa": [(1, 9), (11, 12)], "bb": [(3, 3)]} and progress.gtid_intervals("") == {}
    ids = ["aa:1", "aa:9", "aa:10", "aa:12", "aa:13", "bb:2", "bb:3", "BB:3", "cc:1", None, "x"]
    rows = progress.in_gtid_set(spark.createDataFrame([(i,) for i in ids], "g string"), F.col("g"), text, "inside").collect()
    assert [r.inside for r in rows] == [True, True, False, True, False, False, True, True, False, None, None]
    assert [r.inside for r in progress.in_gtid_set(spark.createDataFrame([("aa:1",)], "g string"), F.col("g"), "", "inside").collect()] == [False]


def test_start_after_gtids_needs_an_id(spark):
    rows = spark.createDataFrame([("r", None), ("c", "aa:1"), ("u", "aa:2")], "op string, gtid string")
    assert [r.gtid for r in capture.start_after_gtids(rows, "aa:1").collect()] == ["aa:2"]
    with pytest.raises(Exception, match="no transaction id"):
        capture.start_after_gtids(spark.createDataFrame([("c", None)], rows.schema), "aa:1").collect()


def test_changes_of_a_transaction_are_told_apart(spark):
    event = '{"_id":{"_data":"82AA%s"},"operationType":"update","ns":{"db":"d","coll":"c"},"documentKey":{"_id":1},"fullDocument":{"_id":1,"st":"%s"},"txnNumber":1,"clusterTime":{"$timestamp":{"t":5,"i":1}}}'
    raw = spark.createDataFrame([(event % ("0b", "last"),), (event % ("0A", "first"),)], "value string")
    wide = changestream.decode_change_stream(raw, "_id bigint, st string", wide=True)
    assert [(r.after.st, r.pos) for r in wide.sort("pos").collect()] == [("first", f"{(5 << 32) + 1:020d}82AA0A"), ("last", f"{(5 << 32) + 1:020d}82AA0B")]
    assert [r.st for r in changelog.materialize(wide).collect()] == ["last"] and changelog.dedup_at_least_once(wide.unionAll(wide)).count() == 2
    with pytest.raises(Exception, match="need wide=True"):
        changestream.decode_change_stream(raw, "_id bigint, st string").collect()
    with pytest.raises(Exception, match="no resume token"):
        changestream.decode_change_stream(raw.select(F.regexp_replace("value", "_data", "_other").alias("value")), "_id bigint, st string", wide=True).collect()


def test_embedded_schema_is_found_wherever_it_is(spark):
    def event(first, field="v", kind="string", value='"x"'):
        image = f'{{"type":"int32","field":"k"}},{{"type":"{kind}","field":"{field}"}}'
        schema = f'"schema":{{"type":"struct","fields":[{{"type":"struct","field":"after","fields":[{image}]}}]}}'
        payload = f'"payload":{{"op":"c","after":{{"k":1,"{field}":{value}}},"source":{{"pos":5}}}}'
        return "{" + (f"{schema},{payload}" if first else f"{payload},{schema}") + "}"
    for texts, names in (([event(True)], ["k", "v"]), ([event(False, "w")], ["k", "w"]), ([event(True), event(False, "w"), '{"op":1}'], ["k", "v", "w"]),
                         ([event(True).replace(',"payload"', ' , "payload"')], ["k", "v"])):
        rows = envelope.decode_envelope_with_schema(spark.createDataFrame([(t,) for t in texts], "value string"), ["k"])
        assert sorted(rows.schema["after"].dataType.names) == names
    wide = envelope.decode_envelope_with_schema(spark.createDataFrame([(event(True, kind="int32", value="7"),), (event(True, kind="int64", value="5000000000"),)], "value string"), ["k"])
    assert sorted(r.after.v for r in wide.collect()) == [7, 5_000_000_000]


def test_wider_types():
    from pyspark.sql import types as T
    w = envelope.wider_type
    assert w(T.IntegerType(), T.LongType()) == T.LongType() and w(T.DoubleType(), T.FloatType()) == T.DoubleType()
    assert w(T.DecimalType(10, 2), T.DecimalType(20, 2)) == T.DecimalType(20, 2) and w(T.DecimalType(10, 2), T.DecimalType(10, 3)) is None
    assert w(T.IntegerType(), T.StringType()) == T.StringType() and w(T.DateType(), T.StringType()) is None and w(T.LongType(), T.DoubleType()) is None


def test_rows_of_one_table_are_not_sorted_in_one_task(spark):
    rows = spark.range(1000).selectExpr("'d' as db", "'t' as table", "'c' as op", "id as pos", "0 as sub", "named_struct('id', id) as key",
                                        "cast(null as struct<id:bigint>) as before", "named_struct('id', id) as after")
    added = spark.createDataFrame([("d", "t")], "db string, table string")
    state = spark.createDataFrame([("d", "old", 1, 0)], "db string, table string, pos bigint, sub int")
    for high in (None, added.withColumn("pos", F.lit(500).cast("bigint"))):
        both = capture.read_with_new_tables(rows.withColumn("op", F.lit("r")), rows, state, added, high)
        assert "SortMergeJoin" not in both._jdf.queryExecution().executedPlan().toString()
        assert both.count() == (2000 if high is None else 1000 + 499)
