"""Intermediate tables in the shared folder, bitmaps of fixed size, and connected components."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: computed once, and its lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Inside, tasks get at most so many rows in one Arrow batch. A batch lies in memory twice, in the JVM and in Python, so
    where rows are whole texts the usual 10,000 are too many. Holds for what is run inside, not for what is only planned."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Bitmap:
    """A set of 64-bit numbers known by their low bits only: strangers may seem to be in it, members always are.
    Its size is fixed, so it can be broadcast however many members it has.
    """

    def __init__(self, members: DataFrame, column: str, bits: int = 26):
        slot = members.select(F.pmod(column, F.lit(1 << bits)).alias("slot"))
        longs = (slot.groupBy(F.shiftright("slot", 6).cast("int").alias("at"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow())
        found = np.zeros(1 << (bits - 6), np.int64)
        found[longs["at"].to_numpy()] = longs["bits"].to_numpy()
        self.mask = np.uint64((1 << bits) - 1)
        self.shared = members.sparkSession.sparkContext.broadcast(found.view(np.uint8))

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        slot = numbers.view(np.uint64) & self.mask
        byte = self.shared.value[(slot >> np.uint64(3)).astype(np.int64)]
        return ((byte >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b), label being the smallest node reachable.

    Large-star and small-star steps in turn: each step hangs neighbours on the smallest one it sees, so paths
    shrink by a constant factor. Nodes with very many neighbours are reduced to one minimum map-side.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
        seen = tuple(state)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(root.select("a", F.col("m").alias("b"))))
        now = stored(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
