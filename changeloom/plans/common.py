"""Shared pieces of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import changelog as L, chunks as C
from ..session import scratch_dir
from . import orders_log as O

CHUNK = 1000


def flat(df: DataFrame, *extra: str) -> DataFrame:
    """Change rows with the columns of the oracle's log."""
    out = [F.col("key.k").alias("k")]
    for p, side in (("b", "before"), ("a", "after")):
        out += [F.col(f"{side}.{f}").alias(p + f) for f in ("k", "cust", "st", "cents")]
    return df.select("op", "pos", "sub", *out, *extra)


FLAT = "op, pos, sub, k, bk, bcust, bst, bcents, ak, acust, ast, acents"


def split_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.split_key_updates(O.orders_changes(spark, sf_dir, snapshot=False))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.orders_changes(spark, sf_dir, log=False)


def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.split_key_updates(O.orders_changes(spark, sf_dir))


def order_chunks(spark: SparkSession, sf_dir: str) -> C.ChunkPlan:
    return C.plan_chunks(O.order_images(spark, sf_dir), ["k"], CHUNK)


def marks(spark: SparkSession, plan: C.ChunkPlan) -> DataFrame:
    """Chunk table with LOW and HIGH positions; the four HIGH values cut the log at different places."""
    i = F.col("chunk_id")
    return (plan.table(spark, "orders").withColumn("low_pos", F.lit(0).cast("bigint"))
            .withColumn("high_pos", (1 + i % 4) * O.UPDATE_AT + 50))


# Position ranges written one after another, so that a stream sees the log in several batches.
CUTS = [(0, O.UPDATE_AT), (O.UPDATE_AT, O.CREATE_AT), (O.CREATE_AT, 10 ** 18)]


def log_directory(spark: SparkSession, rows: DataFrame, ranges=CUTS, path: str | None = None) -> str:
    path = path or scratch_dir(spark, "log")
    for low, high in ranges:
        rows.where((F.col("pos") >= low) & (F.col("pos") < high)).write.mode("append").parquet(path)
    return path


def finish(streaming_query):
    """Wait for an available-now query, however long its source is; a failure is an error."""
    streaming_query.awaitTermination()
    if streaming_query.exception():
        raise streaming_query.exception()
