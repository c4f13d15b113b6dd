"""Reading the current rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.chunks import ChunkPlan, assign_chunk, chunk_predicates


def scan_snapshot(rows: DataFrame, key: list[str], db: str, table: str, schema: str = "public",
                  fetch_ts: Column | int = 0) -> DataFrame:
    """Every row as an ``r`` change at position 0."""
    cols = rows.columns
    image = F.struct(*cols)
    fetch = fetch_ts if isinstance(fetch_ts, Column) else F.lit(fetch_ts).cast("bigint")
    return rows.select(
        F.lit(db).alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table"),
        F.lit("r").alias("op"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).alias("sub"),
        F.lit(0).cast("bigint").alias("event_ts"), fetch.alias("fetch_ts"),
        F.struct(*key).alias("key"), F.lit(None).cast(_type_of(rows)).alias("before"),
        image.alias("after"))


def _type_of(rows: DataFrame) -> str:
    return rows.schema.simpleString()


def scan_snapshot_chunks(rows: DataFrame, plan: ChunkPlan) -> DataFrame:
    """Rows with the chunk they belong to. File scans are already split, so no scan per chunk."""
    return assign_chunk(rows, plan, F.col(plan.key))


def scan_jdbc_chunks(spark: SparkSession, url: str, table: str, plan: ChunkPlan,
                     properties: dict[str, str] | None = None) -> DataFrame:
    """Read a database table with one task per chunk."""
    options = {"fetchsize": str(S.FETCH_SIZE), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=chunk_predicates(plan, spark), properties=options)


def snapshot_override(snapshot: DataFrame, table: str, predicate: str | Column) -> DataFrame:
    """Restrict the snapshot rows of one table; other tables and the log stay whole.

    The predicate names payload columns (``after.…``).
    """
    keep = F.expr(predicate) if isinstance(predicate, str) else predicate
    other = F.concat_ws(".", "db", "table") != table
    return snapshot.where(other | (F.col("op") != "r") | keep)


def snapshot_as_insert(df: DataFrame) -> DataFrame:
    return df.withColumn("op", F.when(F.col("op") == "r", "c").otherwise(F.col("op")))


def merge_shards(*shards: DataFrame) -> DataFrame:
    """Shards of one logical table; the key is (db, table, id), missing columns are null."""
    out = shards[0]
    for shard in shards[1:]:
        out = out.unionByName(shard, allowMissingColumns=True)
    return out
