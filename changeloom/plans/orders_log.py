"""A deterministic change log derived from the whole ``orders`` table.

Every order gives a snapshot row; orders whose key is a multiple of 7 are updated, of 11 deleted,
of 13 copied to a new key, and of 17 (unless deleted) moved to another key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGE = "struct<k:bigint,cust:bigint,st:string,cents:bigint>"
T0 = 1_700_000_000_000
UPDATE_AT, DELETE_AT, CREATE_AT, MOVE_AT = 100_000_000, 200_000_000, 300_000_000, 400_000_000
CREATED, MOVED = 1_000_000_000, 2_000_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _image(k, status="st", cents="cents"):
    return F.struct(k.alias("k"), F.col("cust"), F.col(status).alias("st"),
                    F.col(cents).alias("cents"))


def order_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("st"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


def orders_changes(spark: SparkSession, sf_dir: str, snapshot: bool = True,
                   log: bool = True) -> DataFrame:
    """Change rows from one scan of ``orders``."""
    none = F.lit(None).cast(IMAGE)
    k, e = F.col("k"), F.col("_e")
    base, upd = _image(k), _image(k, "ust", "ucents")
    # (number, op, position, condition, before, after)
    kinds = [(0, "r", F.lit(0).cast("bigint"), F.lit(True), none, base)] if snapshot else []
    if log:
        kinds += [
            (1, "u", k + UPDATE_AT, k % 7 == 0, base, upd),
            (2, "d", k + DELETE_AT, k % 11 == 0, upd, none),
            (3, "c", k + CREATE_AT, k % 13 == 0, none, _image(k + CREATED)),
            (4, "u", k + MOVE_AT, (k % 17 == 0) & (k % 11 != 0), upd, _image(k + MOVED, "ust", "ucents")),
        ]

    def choose(i):
        chosen = F
        for kind in kinds:
            value = F.lit(kind[i]) if isinstance(kind[i], str) else kind[i]
            chosen = chosen.when(e == kind[0], value)
        return chosen

    seven = k % 7 == 0
    # A plain number is exploded and everything else chosen by it, which stays in generated code.
    rows = (order_images(spark, sf_dir)
            .withColumn("_e", F.explode(F.array(*[F.lit(kind[0]) for kind in kinds]))).where(choose(3))
            .withColumn("ust", F.when(seven, F.lit("F")).otherwise(F.col("st")))
            .withColumn("ucents", F.when(seven, F.col("cents") + 500).otherwise(F.col("cents")))
            .select(choose(1).alias("op"), choose(2).alias("pos"), choose(4).alias("before"), choose(5).alias("after")))
    payload = F.coalesce("after", "before")
    return rows.select(
        F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("orders").alias("table"),
        "op", "pos", F.lit(0).alias("sub"),
        (F.col("pos") + T0).alias("event_ts"),
        (F.col("pos") + T0 + payload["cust"] % 50).alias("fetch_ts"),
        F.struct(payload["k"].alias("k")).alias("key"), "before", "after")


def sharded_changes(spark: SparkSession, sf_dir: str, **parts) -> DataFrame:
    """The same log spread over db_{0,1}.orders_{0,1} by customer."""
    cust = F.coalesce("after", "before")["cust"]
    return (orders_changes(spark, sf_dir, **parts)
            .withColumn("db", F.format_string("db_%d", cust % 2))
            .withColumn("table", F.format_string("orders_%d", F.floor(cust / 2) % 2)))
