"""Reading a change log and telling its kinds of record apart.

A raw log record has ``topic``, ``key_schema``, ``key`` and ``value`` (texts) next to its position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

# Fixed value: key-schema name (in lower case) that marks a schema change.
SCHEMA_CHANGE_KEYS = ("schemachangekey",)


def read_log(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
             stream: bool = False, files_per_trigger: int | None = None, **options) -> DataFrame:
    """A log directory as a table, or as a stream of new files in it."""
    reader = (spark.readStream if stream else spark.read).format(fmt).schema(schema).options(**options)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def is_data_change(df: DataFrame) -> DataFrame:
    return df.where(F.col("op").isNotNull())


def is_schema_change(names: tuple[str, ...] = SCHEMA_CHANGE_KEYS):
    last = F.lower(F.element_at(F.split("key_schema", r"\."), -1))
    return F.coalesce(last.isin(*names), F.lit(False))


def split_schema_changes(df: DataFrame, include: bool = False,
                         names: tuple[str, ...] = SCHEMA_CHANGE_KEYS) -> tuple[DataFrame, DataFrame]:
    """(records to process, schema history). Schema changes stay among the records only on request."""
    found = is_schema_change(names)
    history = df.where(found).select(
        "pos", F.get_json_object("value", "$.source.db").alias("db"),
        F.get_json_object("value", "$.source.table").alias("table"),
        F.get_json_object("value", "$.historyRecord").alias("schema_json"))
    return (df if include else df.where(~found)), history


def drop_tombstones(df: DataFrame) -> DataFrame:
    return df.where(F.col("value").isNotNull())


def split_heartbeats(df: DataFrame, prefix: str = "__heartbeat") -> tuple[DataFrame, DataFrame]:
    """(data records, heartbeat positions). Heartbeats only move progress on."""
    beat = F.coalesce(F.col("topic").startswith(prefix), F.lit(False))
    return df.where(~beat), df.where(beat).select("topic", "pos")


def route_tables(df: DataFrame, tables: list[tuple[str, str]]) -> dict[tuple[str, str], DataFrame]:
    """One frame per captured table."""
    return {(db, t): df.where((F.col("db") == db) & (F.col("table") == t)) for db, t in tables}


def write_routed(df: DataFrame, path: str, mode: str = "append") -> None:
    """All tables in one pass, one directory each. The rebalance gathers the rows of small tables into
    few files and splits a table that holds much of the log over many tasks."""
    df = df.hint("rebalance", F.col("db"), F.col("table"))
    df.write.mode(mode).partitionBy("db", "table").parquet(path)
