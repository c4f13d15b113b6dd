"""Order-dependent helpers, cut into many small blocks, against plain Python."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from changeloom.operators import spread


@pytest.mark.parametrize("kind, values", [
    ("bigint", list(range(500))),
    ("string", [f"k{v:05d}é" for v in range(500)]),
    ("decimal(12,2)", [Decimal(v) / 4 for v in range(500)]),
    ("date", [date.fromordinal(730000 + v) for v in range(500)]),
    ("double", [v / 8 for v in range(500)]),
])
def test_running_total(spark, kind, values):
    rng = random.Random(3)
    data = [(v, rng.randrange(100)) for v in values]
    rng.shuffle(data)
    df = spark.createDataFrame(data, f"k {kind}, n int")
    cuts = spread.fences(df, "k", 40)
    assert len(cuts) > 3 and cuts == sorted(cuts)
    got = {r.k: r.t for r in spread.running_total(df, "k", F.col("n"), "t", cuts).collect()}
    total, want = 0, {}
    for k, n in sorted(data):
        total += n
        want[k] = total
    assert got == want


def hot_rows(seed):
    """One key holds a third of the rows."""
    rng = random.Random(seed)
    return [(rng.choice([1, rng.randrange(20), rng.randrange(20)]), pos, rng.randrange(1000)) for pos in range(600)]


@pytest.mark.parametrize("seed", range(3))
def test_previous_by_key(spark, seed):
    data = hot_rows(seed)
    df = spark.createDataFrame(data, "k int, pos bigint, v int").repartition(5)
    last, want = {}, {}
    for k, pos, v in data:
        want[pos] = last.get(k)
        last[k] = v
    for rows in (10 ** 6, 70, 9):
        got = spread.previous_by_key(df, ["k"], ["pos"], F.col("v"), "p", rows).collect()
        assert {r.pos: r.p for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_running_totals_by_key(spark, seed):
    data = hot_rows(seed)
    df = spark.createDataFrame(data, "k int, pos bigint, v int").repartition(5)
    total, want = {}, {}
    for k, pos, v in data:
        total[k] = total.get(k, 0) + v
        want[pos] = total[k]
    for rows in (10 ** 6, 70, 9):
        got = spread.running_totals_by_key(df, ["k"], "pos", {"t": F.col("v")}, rows).collect()
        assert {r.pos: r.t for r in got} == want


def test_only_the_hot_key_is_cut_and_no_part_is_large(spark):
    df = spark.createDataFrame(hot_rows(1), "k int, pos bigint, v int")
    parts = spread._blocks_of_hot_keys(df, ["k"], "pos", 100).groupBy("k", "_block").count().collect()
    assert max(r["count"] for r in parts) <= 100
    assert {r.k for r in parts if r._block} == {1}
    assert spread._blocks_of_hot_keys(df, ["k"], "pos", 1000) is None


def test_hot_value_does_not_widen_the_sample(spark):
    """A value in a third of the rows is one sample value, not many rows."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("k%05d", "id")).alias("k"))
    cuts = spread.fences(df, "k", 100)
    assert 10 <= len(cuts) <= 40


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_small_gives_the_same_rows_either_way(spark, how):
    big = spark.createDataFrame(hot_rows(2), "k int, pos bigint, v int")
    small = spark.createDataFrame([(k, k * 2) for k in range(0, 20, 2)], "k int, w int")
    plain = big.join(small, ["k"], how)
    for limit in (1000, 3):
        got = spread.join_small(big, small, ["k"], how, max_rows=limit, salts=4)
        assert sorted(got.collect(), key=str) == sorted(plain.select(*got.columns).collect(), key=str)
    salted = spread.join_small(big, small, ["k"], how, max_rows=3, salts=4)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_locate_edges(spark):
    df = spark.createDataFrame([(v,) for v in range(-2, 12)], "k bigint")
    for n in range(0, 9):
        bounds = list(range(0, n))
        found = spread.locate(df, F.col("k"), spread.literal_array(bounds, T.LongType()), n, "c").collect()
        assert all(r.c == sum(b <= r.k for b in bounds) for r in found)
