"""Changelog algebra on small hand-written histories."""

import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import changelog as L, chunks as C, merge as M, progress as P, views as V
from changeloom.sources import snapshot as snaps

ROW = "id int, name string, description string, weight double"
TYPE = f"struct<{ROW.replace(' ', ':').replace(',:', ',')}>"
CHANGES = f"db string, schema string, table string, op string, pos bigint, sub int, event_ts bigint, fetch_ts bigint, key struct<id:int>, before {TYPE}, after {TYPE}"
PRODUCTS = [
    (101, "scooter", "Small 2-wheel scooter", 3.14), (102, "car battery", "12V car battery", 8.1),
    (103, "12-pack drill bits", "12-pack of drill bits with sizes ranging from #40 to #3", 0.8), (104, "hammer", "12oz carpenter's hammer", 0.75),
    (105, "hammer", "14oz carpenter's hammer", 0.875), (106, "hammer", "16oz carpenter's hammer", 1.0), (107, "rocks", "box of assorted rocks", 5.3),
    (108, "jacket", "water resistent black wind breaker", 0.1), (109, "spare tire", "24 inch spare tire", 22.2)]


def changes(spark, events):
    """events: (op, pos, before, after)."""
    rows = []
    for op, pos, before, after in events:
        key = ((after or before)[0],) if (after or before) else None
        rows.append(("inventory", None, "products", op, pos, 0, pos, pos, key, before, after))
    return spark.createDataFrame(rows, CHANGES)


def history():
    at = {p[0]: p for p in PRODUCTS}
    events, pos = [("r", 0, None, p) for p in PRODUCTS], 0

    def step(op, new, old=None):
        nonlocal pos
        pos += 1
        before = at.pop((old or new)[0], None) if op != "c" else None
        if op != "d":
            at[new[0]] = new
        events.append((op, pos, before, None if op == "d" else new))
    step("u", (106, "hammer", "18oz carpenter hammer", 1.0))
    step("u", (107, "rocks", "box of assorted rocks", 5.1))
    step("c", (110, "jacket", "water resistent white wind breaker", 0.2))
    step("c", (111, "scooter", "Big 2-wheel scooter ", 5.18))
    step("u", (110, "jacket", "new water resistent white wind breaker", 0.5))
    step("u", (111, "scooter", "Big 2-wheel scooter ", 5.17))
    step("d", at[111])
    return events, at


def test_seven_changes_give_ten_rows(spark):
    events, final = history()
    got = sorted(tuple(r) for r in L.materialize(changes(spark, events)).collect())
    assert got == sorted(final.values()) and len(got) == 10
    assert got[5] == (106, "hammer", "18oz carpenter hammer", 1.0) and got[9][3] == 0.5


def test_signed_kinds_are_the_state(spark):
    events, final = history()
    kinds = L.to_row_kinds(changes(spark, events))
    left = V.aggregate_changes(kinds, ["id", "name", "description", "weight"], {})
    assert sorted(tuple(r) for r in left.collect()) == sorted((*p, 1) for p in final.values())


def test_key_change_order(spark):
    a, b = (1001, "roy", "old", 1.0), (2001, "roy", "old", 1.0)
    df = changes(spark, [("c", 1, None, a), ("u", 2, a, b), ("u", 3, b, (2001, "roy", "new", 1.0))])
    got = L.split_key_updates(df).sort("pos", "sub").collect()
    assert [(r.op, r.pos, r["sub"], r.key.id) for r in got] == [("c", 1, 0, 1001), ("d", 2, 0, 1001), ("c", 2, 1, 2001), ("u", 3, 0, 2001)]
    assert got[1].after is None and got[1].before == a and got[2].before is None


def test_missing_image_is_an_error_in_full_mode_only(spark):
    df = changes(spark, [("u", 1, None, PRODUCTS[0])])
    with pytest.raises(Exception, match="no before image"):
        L.to_row_kinds(df).collect()
    assert [r.row_kind for r in L.to_row_kinds(df, "upsert").collect()] == ["+U"]
    with pytest.raises(ValueError):
        L.to_row_kinds(df, "upsert", has_key=False)
    assert L.check_row_images(df).first().missing_before == 1


def test_upsert_delete_carries_its_key(spark):
    df = changes(spark, [("d", 1, PRODUCTS[0], None)]).withColumn("before", F.lit(None).cast(TYPE))
    row = L.to_row_kinds(df, "upsert").first()
    assert (row.row_kind, row.id, row.name) == ("-D", 101, None)


def test_upserts_get_their_images_in_blocks(spark):
    rng = random.Random(5)
    state, events, want = {}, [], {}
    for pos in range(1, 400):
        k = rng.choice([1, rng.randrange(9), rng.randrange(9)])     # key 1 is hot
        op = "d" if k in state and rng.random() < 0.2 else "u"
        after = None if op == "d" else (k, f"n{pos}", None, float(pos))
        want[pos] = ("d" if op == "d" else ("u" if k in state else "c"), state.get(k))
        events.append((op, pos, state.get(k), after))
        state[k] = after
        if op == "d":
            del state[k]
    full = changes(spark, events)
    bare = full.withColumn("before", F.lit(None).cast(TYPE))
    for rows in (10 ** 6, 60, 7):
        got = L.normalize_upserts(bare, rows_per_block=rows).collect()
        assert {r.pos: (r.op, tuple(r.before) if r.before else None) for r in got} == want


def test_validation_reasons(spark):
    p = PRODUCTS[0]
    df = changes(spark, [("c", 1, None, p), ("c", 2, p, p), ("r", 3, None, None), ("u", 4, None, p), ("u", 5, p, None),
                         ("d", 6, p, None), ("d", 7, None, None), ("d", 8, p, p), ("x", 9, None, p)])
    got = {r.pos: r.reason for r in L.validate_changes(df).collect()}
    assert got == {2: "unexpected before", 3: "key missing", 5: "after missing", 7: "key missing", 8: "unexpected after", 9: "unknown op"}


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    got = sorted(tuple(r) for r in L.reconcile_states(a, b).collect())
    assert got == [("left", 1, None, 1), ("left", 2, "x", 1), ("right", 3, "y", 1)]


def test_resume_and_progress(spark):
    df = changes(spark, [("c", p, None, (p, "n", None, 0.0)) for p in range(1, 9)])
    state = P.commit_progress(df.limit(0), df.where("pos <= 5"))
    assert sorted(r.pos for r in P.resume(df, state).collect()) == [6, 7, 8]
    assert P.commit_progress(state, df.limit(0)).collect() == state.collect()
    assert P.resume(df, state.limit(0)).count() == 8


def test_gtid_sets(spark):
    def diff(a, b):
        frames = [P.parse_gtid_set(spark.createDataFrame([(t,)], "g string"), "g") for t in (a, b)]
        found = sorted(tuple(r) for r in P.gtid_difference(*frames).collect())
        assert sorted(tuple(r) for r in P.gtid_difference(*frames, rows_per_block=1).collect()) == found
        return found
    assert diff("A:1-10, b:1:3:5-7", "a:3-4:8-20,b:1-3") == [("a", 1, 2), ("a", 5, 7), ("b", 5, 7)]
    assert diff("a:1-3:2-9", "") == [("a", 1, 9)]
    assert diff("a:1-3", "a:1-3") == []
    assert diff("a:1-3,c:9", "b:1") == [("a", 1, 3), ("c", 9, 9)]


def test_gtid_sets_random(spark):
    rng = random.Random(2)
    sets = [[(rng.choice("ab"), lo, lo + rng.randrange(6)) for lo in rng.choices(range(60), k=12)] for _ in range(2)]
    frames = [spark.createDataFrame(s, "sid string, lo bigint, hi bigint") for s in sets]
    whole = [{(s, t) for s, lo, hi in one for t in range(lo, hi + 1)} for one in sets]
    for rows in (10 ** 6, 8, 3):
        got = P.gtid_difference(*frames, rows_per_block=rows).collect()
        assert {(r.sid, t) for r in got for t in range(r.lo, r.hi + 1)} == whole[0] - whole[1]


def test_gtid_difference_of_long_sids_reads_its_sets_once(spark):
    a = spark.range(500).selectExpr("'s' as sid", "id * 3 as lo", "id * 3 + 1 as hi")
    b = spark.range(500).selectExpr("'s' as sid", "id * 4 as lo", "id * 4 as hi")
    found = P.gtid_difference(a, b, rows_per_block=100)
    # What is left to do starts at the switches and one row for each block, however many steps came before.
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 2
    left = {t for r in found.collect() for t in range(r.lo, r.hi + 1)}
    assert left == {t for i in range(500) for t in (i * 3, i * 3 + 1)} - {i * 4 for i in range(500)}


def test_offsets_with_missing_numbers(spark):
    df = spark.sql("select 'f1' as f, cast(null as bigint) as p, 5L as q")
    a, b = P.offset(F.col("f"), F.col("p")), P.offset(F.col("f"), F.col("q"), F.col("p"), F.col("p"))
    assert tuple(df.select(P.is_before(a, b), P.is_at_or_before(a, a), P.is_after(a, b), P.is_at_or_after(b, a)).first()) == (True, True, False, True)


@pytest.mark.parametrize("seed", range(4))
def test_any_high_gives_the_final_state(spark, seed):
    """Chunks, HIGH positions and the read point of the snapshot are random; nothing is lost or doubled."""
    rng = random.Random(seed)
    final, events = {}, []
    start = {k: (k, f"s{k}", None, 0.0) for k in rng.sample(range(60), 30)}
    state = dict(start)
    for pos in range(1, 160):
        k = rng.choice([7, rng.randrange(60)])
        if k not in state:
            state[k] = (k, f"c{pos}", None, float(pos))
            events.append(("c", pos, None, state[k]))
        elif rng.random() < 0.25:
            events.append(("d", pos, state.pop(k), None))
        elif rng.random() < 0.3 and (new := rng.randrange(60)) not in state:
            old, state[new] = state.pop(k), (new, f"m{pos}", None, float(pos))
            events.append(("u", pos, old, state[new]))
        else:
            old, state[k] = state[k], (k, f"u{pos}", None, float(pos))
            events.append(("u", pos, old, state[k]))
    log = L.split_key_updates(changes(spark, events))
    rows = spark.createDataFrame(list(start.values()), ROW)
    snapshot = snaps.scan_snapshot(rows, ["id"], "inventory", "products")
    plan = C.plan_chunks(rows, ["id"], 5, even=bool(seed % 2))
    highs = [(i, 0, rng.randrange(0, 170)) for i in range(plan.chunks)]
    marks = spark.createDataFrame(highs, "chunk_id bigint, low_pos bigint, high_pos bigint")
    merged = M.snapshot_then_log(snapshot, log, plan, marks)
    got = sorted(tuple(r) for r in M.state_of_kinds(merged, ["id"]).collect())
    assert got == sorted(state.values())
    signed = V.aggregate_changes(merged, ["id", "name", "weight"], {}).collect()
    assert sorted((r.id, r.name, r.weight, r.row_count) for r in signed) == sorted((s[0], s[1], s[3], 1) for s in state.values())


def test_enrich_changes_step_by_step(spark):
    """Five changes over orders and shipments; a result is keyed by both."""
    orders0 = [(10001, 102, False), (10002, 105, False), (10003, 106, False)]
    ship0 = [(1001, 10001, False), (1002, 10002, False), (1003, 10003, False)]
    steps = [
        (orders0 + [(10004, 104, False)], ship0, [10004], [], [("+I", 10004, 104, False, None, None)]),
        (orders0 + [(10004, 104, False)], ship0 + [(1004, 10004, False)], [], [10004],
         [("-D", 10004, 104, False, None, None), ("+I", 10004, 104, False, 1004, False)]),
        (orders0 + [(10004, 104, True)], ship0 + [(1004, 10004, False)], [10004], [],
         [("-U", 10004, 104, False, 1004, False), ("+U", 10004, 104, True, 1004, False)]),
        (orders0 + [(10004, 104, True)], ship0 + [(1004, 10004, True)], [], [10004],
         [("-U", 10004, 104, True, 1004, False), ("+U", 10004, 104, True, 1004, True)]),
        (orders0, ship0 + [(1004, 10004, True)], [10004], [], [("-D", 10004, 104, True, 1004, True)]),
    ]

    def orders(rows):
        return spark.createDataFrame(rows, "order_id int, product_id int, order_status boolean")

    def ships(rows):
        return spark.createDataFrame(rows, "shipment_id int, order_id int, is_arrived boolean")

    def ids(values):
        return spark.createDataFrame([(v,) for v in values], "order_id int")
    o, s = orders0, ship0
    for new_o, new_s, touched_o, touched_s, want in steps:
        got = V.enrich_changes(orders(o), orders(new_o), ids(touched_o), "order_id",
                               [V.DimChange(ships(s), ships(new_s), ids(touched_s), "order_id")], ["order_id", "shipment_id"])
        cols = ["row_kind", "order_id", "product_id", "order_status", "shipment_id", "is_arrived"]
        assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == sorted(want, key=str)
        o, s = new_o, new_s


def test_a_chunk_without_a_mark_is_an_error(spark):
    from changeloom.operators import merge
    from changeloom.plans import common
    plan = common.order_chunks(spark, "/root/testdata/sf0.001")
    log = common.split_log(spark, "/root/testdata/sf0.001")
    marks = common.marks(spark, plan)
    assert merge.changes_after_snapshot(log, plan, marks).count() > 0
    with pytest.raises(Exception, match="no log position for chunk"):
        merge.changes_after_snapshot(log, plan, marks.where("chunk_id <> 0")).collect()
