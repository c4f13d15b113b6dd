"""Chunk boundaries and membership."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from changeloom.operators import chunks as C, spread

CUSTOMERS = [101, 102, 103, 109, 110, 111, 118, 121, 123, *range(1009, 1020), 2000]
SPARSE = [2, 4, 6, 8, 10, 16, 17, 18, 20, 22]
DENSE = [1] * 4 + [2] * 3 + [3] * 3
ADDRESS = [416874195632735147, 416927583791428523, 417022095255614379, 417111867899200427,
           417271541558096811, 417272886855938987, 417420106184475563, 418161258277847979]
ONE, TWO = ["id"], ["id", "other"]


def frame(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


def ends(spark, plan):
    rows = plan.table(spark, "t").sort("chunk_id").collect()
    assert [r.chunk_id for r in rows] == list(range(plan.chunks))
    assert rows[0].start is None and rows[-1].end is None
    assert [r.start for r in rows[1:]] == [r.end for r in rows[:-1]]
    return [r.end for r in rows[:-1]]


@pytest.mark.parametrize("values, size, even, keys, path, want", [
    (range(101), 25, None, ONE, "even", [25, 50, 75, 100]),
    (CUSTOMERS, 4, None, ONE, "even", [462, 823, 1184, 1545, 1906]),
    (CUSTOMERS, 4, False, ONE, "uneven", [109, 118, 1009, 1012, 1015, 1018]),
    (CUSTOMERS, 4, False, TWO, "uneven", [109, 118, 1009, 1012, 1015, 1018]),
    (range(101, 111), 4, None, ONE, "even", [105, 109]),
    (SPARSE, 4, None, ONE, "even", [10, 18]),
    (SPARSE, 2, None, ONE, "even", [6, 10, 14, 18, 22]),
    (DENSE, 4, None, TWO, "even", [2, 3]),
    (DENSE, 2, False, TWO, "uneven", [2]),
    (DENSE, 4, False, TWO, "uneven", [2]),
    (ADDRESS, 2, None, ONE, "uneven", ADDRESS[1:-1]),
    ([1, 2, 3, 4], 1, False, ONE, "uneven", [2, 3]),
    ([1, 2, 3, 4], 1, False, TWO, "uneven", [2, 3]),
    ([20001], 4, None, ONE, "single", []),
    ([], 4, None, ONE, "single", []),
    ([1, 100], 8, None, ONE, "single", []),
])
@pytest.mark.parametrize("rows_per_block", [1_000_000, 3])
def test_goldens(spark, values, size, even, keys, path, want, rows_per_block):
    df = frame(spark, list(values))
    plan = C.plan_chunks(df, keys, size, even=even, rows_per_block=rows_per_block)
    assert plan.path == path
    assert ends(spark, plan) == want
    for r in C.assign_chunk(df, plan, F.col("id")).collect():
        assert r.chunk_id == sum(e <= r.id for e in want)


def walk(values, size):
    """The sequential rule, one step per chunk."""
    values, found, at = sorted(values), [], min(values)
    while True:
        nxt = max([v for v in values if v >= at][:size])
        if nxt == at:
            nxt = min([v for v in values if v > at], default=values[-1])
        if nxt >= values[-1]:
            return found
        found.append(nxt)
        at = nxt


@pytest.mark.parametrize("seed", range(4))
def test_repeated_keys_in_blocks_equal_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    # One key holds a third of the rows.
    values = [rng.choice([77, rng.randrange(300), rng.randrange(300)]) for _ in range(500)]
    size = rng.choice([3, 7, 25])
    for rows_per_block in (10 ** 6, 50, 12):
        plan = C.plan_chunks(frame(spark, values), TWO, size, even=False, rows_per_block=rows_per_block)
        assert ends(spark, plan) == walk(values, size)


def test_text_and_decimal_keys(spark):
    cart = ["user_1", "user_2", "user_2", "user_3", "user_4", "user_4", "user_5", "user_6"]
    plan = C.plan_chunks(frame(spark, cart, "string"), TWO, 3, rows_per_block=2)
    assert ends(spark, plan) == walk(cart, 3)
    money = [Decimal(n) + Decimal("0.4567") for n in range(100, 130)]
    plan = C.plan_chunks(frame(spark, money, "decimal(10,4)"), ONE, 10)
    assert plan.path == "even"
    found = ends(spark, plan)
    assert found[0] == money[0] + plan.step
    for r in C.assign_chunk(frame(spark, money, "decimal(10,4)"), plan, F.col("id")).collect():
        assert r.chunk_id == sum(e <= r.id for e in found)


def test_many_bounds_use_two_levels(spark):
    values = [v * 3 for v in range(400)]
    random.Random(1).shuffle(values)
    df = frame(spark, values)
    plan = C.plan_chunks(df, ONE, 4, even=False)
    found = ends(spark, plan)
    probe = frame(spark, [*values, -5, 10 ** 9, 7])
    for bound in (16_384, 60, 10, 1):
        for r in C.assign_chunk(probe, plan, F.col("id"), literal_bounds=bound).collect():
            assert r.chunk_id == sum(e <= r.id for e in found)


def test_extreme_longs_do_not_overflow(spark):
    values = [-2 ** 63, -5, 0, 9, 2 ** 63 - 1]
    df = frame(spark, values)
    plan = C.plan_chunks(df, ONE, 2, even=True)
    assert plan.chunks > 1
    step, low = plan.step, plan.low
    for r in C.assign_chunk(df, plan, F.col("id")).collect():
        assert r.chunk_id == (r.id - low) // step


def test_factor():
    assert C.factor_of(101, 2000, 21) == 90.4762
    assert C.factor_of(Decimal("1.0"), Decimal("2.5"), 3) == 0.8334
    assert C.factor_of(1, 2, 0) == C.MAX_FACTOR
    with pytest.raises(TypeError):
        C.factor_of(1, "2", 3)


def test_factor_column_rounds_up(spark):
    got = spark.range(1).select(C.distribution_factor(F.lit(101), F.lit(2000), F.lit(21)).alias("f"),
                                C.distribution_factor(F.lit(1), F.lit(2), F.lit(0)).alias("none")).first()
    assert got.f == 90.4762 and got.none == C.MAX_FACTOR


def test_chunk_key_rules():
    assert C.chunk_key(["a", "b"]) == "a"
    assert C.chunk_key(["a", "b"], "b") == "b"
    with pytest.raises(ValueError):
        C.chunk_key(["a"], "c")
    with pytest.raises(ValueError):
        C.chunk_key([])


@pytest.mark.parametrize("even", [True, False])
def test_predicates_cover_and_do_not_overlap(spark, even):
    df = frame(spark, CUSTOMERS)
    plan = C.plan_chunks(df, ONE, 4, even=even)
    parts = [sorted(r.id for r in df.where(p).collect()) for p in C.chunk_predicates(plan, spark)]
    assert len(parts) == plan.chunks
    assert sorted(v for p in parts for v in p) == sorted(CUSTOMERS)
    by_chunk = C.assign_chunk(df, plan, F.col("id")).groupBy("chunk_id").count().collect()
    assert {r.chunk_id: r["count"] for r in by_chunk} == {i: len(p) for i, p in enumerate(parts) if p}


def test_predicates_quote_text(spark):
    df = frame(spark, ["a'1", "b'2", "c'3", "d'4"], "string")
    plan = C.plan_chunks(df, ONE, 2)
    parts = [df.where(p).count() for p in C.chunk_predicates(plan, spark)]
    assert sum(parts) == 4


def test_range_rule_for_mixed_types(spark):
    row = spark.sql("select '15' as k, 9 as s, 20 as e, 15L as n")
    text = C.in_range(F.col("k"), F.col("s"), F.col("e"), T.StringType(), T.IntegerType())
    number = C.in_range(F.col("n"), F.col("s"), F.col("e"), T.LongType(), T.IntegerType())
    both_open = C.in_range(F.col("n"), F.lit(None), F.lit(None))
    assert tuple(row.select(text, number, both_open).first()) == (False, True, True)


def test_bytes_chunks_in_blocks(spark):
    docs = spark.createDataFrame([(f"{i:04d}", "x" * (i % 37)) for i in range(300)], "_id string, body string")
    one = {r["_id"]: r.chunk_id for r in C.chunk_by_bytes(docs, "_id", 500).collect()}
    many = {r["_id"]: r.chunk_id for r in C.chunk_by_bytes(docs, "_id", 500, rows_per_block=20).collect()}
    total, want = 0, {}
    for i in range(300):
        want[f"{i:04d}"] = total // 500
        total += len('{"_id":"0000","body":""}') + i % 37
    assert one == many == want


@pytest.mark.parametrize("kind,values", [
    ("binary", [b"\x00\x01", b"\x7f", b"\x80\x00", b"\xff"]), ("string", ["a", "b'c", "ü", "中"]), ("decimal(38,3)", [Decimal("-1.500"), Decimal("2.001"), Decimal("1000000000000000000000000000000.000")]),
    ("date", [datetime.date(1969, 1, 1), datetime.date(2024, 2, 29)]), ("timestamp_ntz", [datetime.datetime(1970, 1, 1, 0, 0, 0, 1), datetime.datetime(2020, 1, 1)])])
def test_bounds_of_any_type_are_found(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    bounds = spread.literal_array(values[1:], df.schema["k"].dataType)
    assert [r.n for r in spread.locate(df, F.col("k"), bounds, len(values) - 1, "n").sort("k").collect()] == list(range(len(values)))


def test_binary_keys_land_in_their_chunks(spark):
    df = spark.range(100).select(F.unhex(F.format_string("%04X", F.col("id") * 600)).alias("k"))
    plan = C.plan_chunks(df, ["k"], 10)
    for literal_bounds in (16_384, 3):
        counts = C.assign_chunk(df, plan, F.col("k"), literal_bounds=literal_bounds).groupBy("chunk_id").count().collect()
        assert len(counts) == plan.chunks > 8 and max(r["count"] for r in counts) <= 20
    parts = C.chunk_predicates(plan, spark, quote='"')
    assert len(parts) == plan.chunks and parts[0].startswith("\"k\" <= X'") and sum(df.where(p.replace('"', "`")).count() for p in parts) == 100
    fewer = C.chunk_predicates(plan, spark, chunks_per_task=4)
    assert len(fewer) == -(-plan.chunks // 4) and sum(df.where(p).count() for p in fewer) == 100
