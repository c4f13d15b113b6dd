"""Snapshot and log merged so that every change counts exactly once.

``marks`` is the chunk table's log positions: chunk_id, low_pos, high_pos. A change at or before
its own chunk's HIGH is folded into the snapshot of that chunk; a later one is emitted from the log.
Key-changing updates must be split first (``split_key_updates``), or one half would be tested
against the wrong chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import spread
from .changelog import Keys, offset_column, to_row_kinds
from .chunks import ChunkPlan, assign_chunk


def _marked(log: DataFrame, plan: ChunkPlan, marks: DataFrame) -> DataFrame:
    log = assign_chunk(log, plan, F.col(f"key.{plan.key}"))
    marked = spread.join_small(log, marks.select("chunk_id", "low_pos", "high_pos"), ["chunk_id"], "left")
    # A change of a chunk without a mark would otherwise be lost.
    missing = F.raise_error(F.concat(F.lit("no log position for chunk "), F.col("chunk_id").cast("string"))).cast(marks.schema["high_pos"].dataType)
    return marked.withColumn("high_pos", F.when(F.col("high_pos").isNotNull(), F.col("high_pos")).otherwise(missing))


def _bounds(marks: DataFrame):
    return marks.agg(F.min("low_pos"), F.min("high_pos"), F.max("high_pos")).first()


def reconcile_changes(snapshot: DataFrame, log: DataFrame, plan: ChunkPlan, marks: DataFrame,
                      carry: tuple[str, ...] = ("db", "schema", "table", "event_ts", "fetch_ts")) -> DataFrame:
    """Snapshot rows with the changes LOW < pos <= HIGH of their chunk folded in, as ``r`` changes."""
    low, _, high = _bounds(marks)
    # Literal bounds first: they reach the scan and prune files of the log.
    near = log.where((F.col("pos") > low) & (F.col("pos") <= high))
    folded = _marked(near, plan, marks).where(
        (F.col("pos") > F.col("low_pos")) & (F.col("pos") <= F.col("high_pos")))
    cols = ["key", "op", *S.ORDER, *carry, "after"]
    snapshot = snapshot.withColumn("pos", F.col("pos").cast(log.schema["pos"].dataType))
    rows = snapshot.select(*cols).unionByName(folded.select(*cols))
    keys = Keys(rows, ("key",))
    latest = F.max_by(F.struct(*cols[1:]), offset_column())
    return (rows.groupBy(*keys.columns).agg(latest.alias("_l")).where(F.col("_l.op") != "d")
            .select(*[f"_l.{c}" for c in carry], F.lit("r").alias("op"), *[f"_l.{c}" for c in S.ORDER],
                    *keys.restored, F.lit(None).cast(snapshot.schema["after"].dataType).alias("before"), "_l.after"))


def reconcile_chunks(snapshot: DataFrame, log: DataFrame, plan: ChunkPlan, marks: DataFrame) -> DataFrame:
    """The same as kinded rows, all of them inserts."""
    return to_row_kinds(reconcile_changes(snapshot, log, plan, marks, ()))


def changes_after_snapshot(log: DataFrame, plan: ChunkPlan, marks: DataFrame) -> DataFrame:
    """Change rows strictly after the HIGH of their chunk."""
    _, start, _ = _bounds(marks)
    late = _marked(log.where(F.col("pos") > start), plan, marks)
    return late.where(F.col("pos") > F.col("high_pos")).select(*log.columns)


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, plan: ChunkPlan, marks: DataFrame,
                      mode: str = "all") -> DataFrame:
    """The complete changelog as kinded rows."""
    return reconcile_chunks(snapshot, log, plan, marks).unionByName(
        to_row_kinds(changes_after_snapshot(log, plan, marks), mode))


def state_of_kinds(kinded: DataFrame, key: list[str]) -> DataFrame:
    """Latest state per key of kinded rows; at one position a retraction comes before an addition."""
    adds = F.col("row_kind").isin(S.INSERT, S.UPDATE_AFTER)
    rank = F.struct(*S.ORDER, adds.cast("int").alias("adds"))
    payload = [c for c in kinded.columns if c not in ("row_kind", *S.ORDER)]
    latest = F.max_by(F.struct(adds.alias("live"), *payload), rank)
    return (kinded.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(latest.alias("_l"))
            .where(F.col("_l.live")).select(*[f"_l.{c}" for c in payload]))
