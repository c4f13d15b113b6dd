"""Transactional key/value logs: rows become changes when their transaction commits.

Log rows: region, log_type, key, start_ts, commit_ts, op, value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_TYPES = ("PREWRITE", "COMMIT", "COMMITTED", "ROLLBACK")


def committed_changes(log: DataFrame) -> DataFrame:
    """One row per committed write. PREWRITE, COMMIT and ROLLBACK of a (key, start_ts) meet in one
    aggregate instead of two joins; COMMITTED rows are complete and pass through."""
    known = log.where(F.col("log_type").isin(*LOG_TYPES))
    direct = known.where(F.col("log_type") == "COMMITTED")

    def when(kind, value):
        return F.when(F.col("log_type") == kind, value)

    written = F.max(when("PREWRITE", F.struct("region", "op", "value")))
    paired = (known.where(F.col("log_type") != "COMMITTED").groupBy("key", "start_ts")
              .agg(written.alias("_w"), F.max(when("COMMIT", F.col("commit_ts"))).alias("commit_ts"),
                   F.count_if(F.col("log_type") == "ROLLBACK").alias("_rolled"))
              .where(F.col("_w").isNotNull() & F.col("commit_ts").isNotNull() & (F.col("_rolled") == 0)))
    cols = ["region", "key", "start_ts", "commit_ts", "op", "value"]
    return (paired.select("_w.region", "key", "start_ts", "commit_ts", "_w.op", "_w.value").select(*cols)
            .unionByName(direct.select(*cols)))


def region_progress(progress: DataFrame) -> DataFrame:
    return progress.groupBy("region").agg(F.max("resolved_ts").alias("resolved_ts"))


def resolved_frontier(progress: DataFrame) -> DataFrame:
    """One row: the timestamp every region has reached, and the largest one seen."""
    return region_progress(progress).agg(F.min("resolved_ts").alias("safe_ts"),
                                         F.max("resolved_ts").alias("seen_ts"))


def safe_to_emit(changes: DataFrame, progress: DataFrame) -> DataFrame:
    safe = resolved_frontier(progress).first().safe_ts
    return changes.where(F.col("commit_ts") <= F.lit(safe))


def key_range_filter(df: DataFrame, start: bytes | Column | None, end: bytes | Column | None,
                     key: str = "key") -> DataFrame:
    """start <= key < end on binary keys; an empty or missing bound is open."""
    for bound, keep in ((start, F.col(key).__ge__), (end, F.col(key).__lt__)):
        if isinstance(bound, Column):
            df = df.where(keep(bound))
        elif bound:
            df = df.where(keep(F.lit(bytearray(bound))))
    return df
