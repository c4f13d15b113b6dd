"""Physical plans: what must, and must not, be in them."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from changeloom.operators import changelog as L, chunks as C, merge as M, views as V
from changeloom.plans import all_queries, common, orders_log as O
from changeloom.session import scratch_dir
from changeloom.sources import log as logs

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()[0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in QUERIES if not re.match(r"^(k[12]|w\d|j2_stream)_", n))


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_and_no_row_functions(spark, name):
    text = plan_of(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text


def written_log(spark):
    rows = common.split_log(spark, SF)
    path = scratch_dir(spark, "log")
    rows.write.parquet(path)
    return logs.read_log(spark, path, rows.schema)


def test_log_position_reaches_the_scan(spark):
    plan = common.order_chunks(spark, SF)
    late = M.changes_after_snapshot(written_log(spark), plan, common.marks(spark, plan))
    assert f"GreaterThan(pos,{O.UPDATE_AT + 50})" in plan_of(late)


def test_only_needed_columns_are_read(spark):
    counts = V.change_counts(written_log(spark))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(counts)).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {"db", "table", "op", "event_ts"}
    keys = C.key_min_max(O.read(spark, SF, "orders"), "o_orderkey")
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(keys)


def test_even_chunks_need_no_join(spark):
    plan = common.order_chunks(spark, SF)
    text = plan_of(C.assign_chunk(O.order_images(spark, SF), plan, F.col("k")))
    assert "Join" not in text and "Exchange" not in text


def test_state_is_reduced_before_the_shuffle(spark):
    text = plan_of(L.materialize(written_log(spark)))
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning") and text.count("Exchange") == 1


def test_shuffle_of_a_hot_key_is_small(spark):
    """A third of all changes belong to one key, yet each task sends one row for it."""
    n = 60_000
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    image = F.struct(k.alias("k"), F.col("id").alias("v"))
    df = spark.range(0, n, 1, 6).select(F.lit("u").alias("op"), F.col("id").alias("pos"), F.lit(0).alias("sub"),
                                        F.struct(k.alias("k")).alias("key"), image.alias("after"))
    state = L.materialize(df)
    assert state.where("k = 0").first().v == n - 3
    state.write.format("noop").mode("overwrite").save()
    # 40,000 single keys and at most one row per task for the hot one.
    partial = df.groupBy(F.spark_partition_id(), "key.k").agg(F.count(F.lit(1))).count()
    assert partial <= n * 2 // 3 + 6


def test_hot_join_key_is_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 400_000, 1, 16).select(
            "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("cust"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(1000).select(F.col("id").alias("cust"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
        joined = V.enrich(fact, (dim, "cust"))
        last = joined.tail(1)       # runs on the frame's own plan, so its final form can be read
        assert last[0].name is not None
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_values_come_to_python_in_batches_of_bounded_bytes(spark):
    import __spark_entry__ as entry

    @F.pandas_udf("bigint")
    def rows_at_once(values: pd.Series) -> pd.Series:
        return pd.Series([len(values)] * len(values))
    entry.queries()["t16_decode_charset"](spark, entry.SMALL)
    try:
        sizes = spark.range(2000, numPartitions=1).select(rows_at_once(F.repeat(F.lit("x"), 10_000)).alias("n"))
        # Not ten thousand rows of ten thousand bytes.
        assert sizes.agg(F.max("n")).first()[0] <= 250
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
