"""Transactional key/value logs as streams: writes wait for their commits, commits for what every region has resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Folder
from .sinks import stream_of

#: Log type of a row that says: no commit at or before ``commit_ts`` will come from ``region`` any more.
RESOLVED = "RESOLVED"
_PAIR = ["key", "start_ts"]


def _partial(log: DataFrame) -> DataFrame:
    """What each log row says of its write: the form in which open writes are kept from batch to batch."""
    def of(*kinds):
        return F.col("log_type").isin(*kinds)
    write = F.when(of("PREWRITE", "COMMITTED"), F.struct("region", "op", "value"))
    return log.where(of("PREWRITE", "COMMIT", "COMMITTED", "ROLLBACK")).select(
        *_PAIR, write.alias("write"), F.when(of("COMMIT", "COMMITTED"), F.col("commit_ts")).alias("commit_ts"),
        of("ROLLBACK").alias("rolled"))


def _known(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that an earlier batch wrote, or none before the first."""
    return spark.read.schema(like.schema).parquet(path) if Folder(spark, path).names() else like.limit(0)


def _regions(batch: DataFrame) -> DataFrame:
    resolved = F.max(F.when(F.col("log_type") == RESOLVED, F.col("commit_ts")))
    return batch.where(F.col("region").isNotNull()).groupBy("region").agg(resolved.cast("bigint").alias("resolved_ts")).withColumn(
        "emitted_ts", F.lit(None).cast("bigint"))


def frontier(regions: DataFrame) -> int | None:
    """The timestamp that every region has resolved; None while one of them has said nothing."""
    row = regions.agg(F.min("resolved_ts").alias("safe"), F.count_if(F.col("resolved_ts").isNull()).alias("silent")).first()
    return None if row.silent else row.safe


def apply_batch(batch: DataFrame, state_path: str, batch_id: int) -> DataFrame:
    """Writes that this batch makes safe to emit; what stays open goes to ``state_path`` for the next batch.

    A batch costs its own rows and the open writes: those without a commit, and those committed past the frontier. The
    state before a batch is read as the batch before left it, so a replay gives the same rows.

    * A committed write is emitted once, when the frontier has reached its commit.
    * A write sent again after it was emitted is told by its region's earlier frontier and dropped.
    * A rollback ends its write at once; the rollback itself is kept until the frontier passes its start, so that a
      prewrite that is sent again does not come back.
    * A prewrite or commit whose other half has not come when the frontier passes it is released: a region does not
      resolve a timestamp while a lock from before it is open.
    * A region seen for the first time, or one that has resolved nothing yet, holds the frontier back.
    """
    spark = batch.sparkSession
    before, now = (f"{state_path}/batch={n}" for n in (batch_id - 1, batch_id))
    seen = _regions(batch)
    regions = (_known(spark, f"{before}/regions", seen).unionByName(seen)
               .groupBy("region").agg(F.max("resolved_ts").alias("resolved_ts"), F.max("emitted_ts").alias("emitted_ts")))
    safe = frontier(regions)
    # A frontier of None is behind every timestamp.
    passed = lambda ts: F.coalesce(ts <= F.lit(safe).cast("bigint"), F.lit(False))
    moved = regions.withColumn("emitted_ts", F.greatest("emitted_ts", F.lit(safe).cast("bigint")))
    moved.write.mode("overwrite").parquet(f"{now}/regions")

    rows = _partial(batch)
    writes = (_known(spark, f"{before}/open", rows).unionByName(rows)
              .groupBy(*_PAIR).agg(F.max("write").alias("write"), F.max("commit_ts").alias("commit_ts"), F.max("rolled").alias("rolled")))
    whole = F.col("write").isNotNull() & F.col("commit_ts").isNotNull() & ~F.col("rolled")
    told = regions.where(F.col("emitted_ts").isNotNull()).select("region", "emitted_ts")
    placed = (writes.withColumn("whole", whole).withColumn("region", F.col("write.region"))
              .join(told, "region", "left")
              .where(~F.col("whole") | F.col("emitted_ts").isNull() | (F.col("commit_ts") > F.col("emitted_ts"))))
    ready = F.col("whole") & passed(F.col("commit_ts"))
    done = ~F.col("whole") & passed(F.greatest("start_ts", F.when(~F.col("rolled"), F.col("commit_ts"))))
    # A write that was rolled back leaves its mark only.
    kept = [*_PAIR, F.when(~F.col("rolled"), F.col("write")).alias("write"), F.when(~F.col("rolled"), F.col("commit_ts")).alias("commit_ts"), "rolled"]
    placed.where(~ready & ~done).select(*kept).write.mode("overwrite").parquet(f"{now}/open")
    return placed.where(ready).select("region", "key", "start_ts", "commit_ts", "write.op", "write.value")


def open_writes(spark: SparkSession, state_path: str, batch: DataFrame, batch_id: int) -> DataFrame:
    """The writes that are open after a batch: key, start_ts, write, commit_ts, rolled."""
    return _known(spark, f"{state_path}/batch={batch_id}/open", _partial(batch))


def stream_committed(log: DataFrame, state_path: str, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Committed writes of a transaction log, in the micro-batch in which all regions have resolved their commit.

    ``log`` has the columns region, log_type, key, start_ts, commit_ts, op, value; rows of type RESOLVED carry a region
    and its resolved timestamp in ``commit_ts``. Output goes to ``out_path/stream=ID/batch=N``; of the state, the last
    two batches are kept.
    """
    def apply(batch, batch_id):
        spark = batch.sparkSession
        own = f"{state_path}/stream={stream_of(spark)}"
        batch = batch.persist()
        try:
            apply_batch(batch, own, batch_id).write.mode("overwrite").parquet(f"{out_path}/stream={stream_of(spark)}/batch={batch_id}")
        finally:
            batch.unpersist()
        # A replay starts from the batch before this one; older ones are of no use.
        Folder(spark, own).delete(f"batch={batch_id - 2}")

    return (log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
