"""Change rows as streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import merge
from ..operators.changelog import (Keys, dedup_at_least_once, latest_changes, materialize,
                                   normalize_upserts, offset_column, split_key_updates)
from ..operators.views import DimChange, enrich_changes
from ..sources.envelope import decode_envelope
from .sinks import load, read_changes, stream_of, touched_buckets, upsert_batch, upsert_sink


def stream_materialize(stream: DataFrame, by: tuple[str, ...] = ("key",)) -> DataFrame:
    """Running latest change per key; use update or complete output mode. Deleted keys are reported
    with op ``d`` so that a sink can drop them."""
    keys = Keys(stream, by)
    latest = F.max_by(F.struct("op", "after", *S.ORDER), offset_column())
    return stream.groupBy(*keys.columns).agg(latest.alias("_l")).select(*keys.restored, "_l.*")


def live_rows(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("op") != "d").select("after.*")


def stream_dedup(stream: DataFrame, by: list[str], delay: str = "10 minutes") -> DataFrame:
    """One copy of each event of an at-least-once source; state of log events is kept for ``delay``.

    Snapshot rows carry no event time and may come at any moment, so they pass by the watermark: they are told apart
    by ``by`` alone, with state for each of them for as long as the query runs.
    """
    snapshot = stream.where(F.col("op") == "r").dropDuplicates(by)
    timed = stream.where(F.coalesce(F.col("op") != "r", F.lit(True))).withColumn("_at", F.timestamp_millis("event_ts")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(by).drop("_at").unionByName(snapshot)


def _split_late(batch: DataFrame, state_path: str, batch_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(events past the stored position of their key, stored last change of the keys of the batch)."""
    keys = Keys(batch, ("key",))
    batch = keys.add(batch)
    buckets = touched_buckets(batch, ("key",), load(batch.sparkSession, state_path))
    stored = keys.add(read_changes(batch.sparkSession, state_path, batch.drop(*keys.names).schema, batch_id, buckets))
    stored = stored.join(batch.select(*keys.names).distinct(), keys.names, "left_semi")
    rest = [c for c in batch.columns if c not in keys.names]
    last = stored.groupBy(*keys.names).agg(F.max_by(F.struct(*rest), offset_column()).alias("_l"))
    fresh = (batch.join(last.select(*keys.names, F.struct("_l.pos", "_l.sub").alias("_at")), keys.names, "left")
             .where(F.col("_at").isNull() | (offset_column() > F.col("_at"))))
    return fresh.select(*rest), last.select("_l.*").select(*rest)


def normalize_batch(batch: DataFrame, state_path: str, batch_id: int | None = None) -> DataFrame:
    """Before images for one micro-batch of upserts, from the keyed table of earlier images.

    The events of the batch, and the stored row of each key they touch, go through the batch
    operator together, so a hot key is spread over blocks as in ``normalize_upserts``. Events at or
    before the stored position of their key are late and dropped. Stored rows are found by a join with the buckets that
    the keys of the batch lie in, which suits large batches; ``keyed_state.normalize`` looks up the keys alone.
    """
    return _normalized(_with_held(batch, state_path, batch_id))


def _with_held(batch: DataFrame, state_path: str, batch_id: int | None = None) -> DataFrame:
    """Events of the batch that are not late (``_new``), and the stored rows of their keys."""
    fresh, held = _split_late(batch, state_path, batch_id)
    return (held.withColumn("_new", F.lit(False))
            .unionByName(fresh.withColumn("_new", F.lit(True))))


def _normalized(both: DataFrame) -> DataFrame:
    return normalize_upserts(both).where("_new").drop("_new")


def stream_normalize(stream: DataFrame, state_path: str, out_path: str, checkpoint: str,
                     trigger: dict | None = None):
    """Upsert stream to a full changelog under ``out_path``, one directory per stream (checkpoint) and batch."""
    def apply(batch, batch_id):
        # Several steps look at the batch, and at the stored rows of its keys; each is put together once.
        batch = dedup_at_least_once(batch, ("key", *S.ORDER)).persist()
        both = _with_held(batch, state_path, batch_id).persist()
        try:
            _normalized(both).write.mode("overwrite").parquet(
                f"{out_path}/stream={stream_of(batch.sparkSession)}/batch={batch_id}")
            upsert_batch(batch, state_path, batch_id)
        finally:
            both.unpersist()
            batch.unpersist()

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def late_change_guard(batch: DataFrame, state_path: str) -> DataFrame:
    """Drop events at or before the stored position of their key."""
    return _split_late(batch, state_path)[0]


def stream_progress(stream: DataFrame, heartbeat_prefix: str = "__heartbeat") -> DataFrame:
    """Highest position per source, moved on by data and heartbeats alike. A heartbeat's topic is the
    prefix, a dot and the source."""
    beat = F.col("topic").startswith(heartbeat_prefix + ".")
    source = F.when(beat, F.expr(f"substring(topic, {len(heartbeat_prefix) + 2})")).otherwise(F.col("topic"))
    return stream.groupBy(source.alias("source")).agg(F.max("pos").alias("pos"))


def snapshot_to_stream(snapshot: DataFrame, log: DataFrame, plan, marks: DataFrame, log_stream: DataFrame,
                       path: str, checkpoint: str, trigger: dict | None = None):
    """Bounded part first, committed as version 1 of the table; then the log past each chunk's HIGH."""
    merged = merge.reconcile_changes(snapshot, log, plan, marks)
    upsert_batch(merged, path, -1)
    late = merge.changes_after_snapshot(log_stream, plan, marks)
    return upsert_sink(late, path, checkpoint, trigger=trigger)


# ---------------------------------------------------------------- incremental join

@dataclass(frozen=True)
class Side:
    """One table of an incremental join, found in the raw log by its name."""
    table: str
    row: str            # payload columns as DDL
    key: list[str]
    on: str | None = None   # dims: the column shared with the fact


def stream_enrich(raw: DataFrame, fact: Side, dims: list[Side], state_path: str, out_path: str,
                  checkpoint: str, result_key: list[str] | None = None, trigger: dict | None = None):
    """Keep ``fact left join dims`` up to date from one raw log of envelope texts (column ``value``).

    Each micro-batch writes the kinded rows of the results it changed to ``out_path/stream=ID/batch=N``. Both
    images of dim changes are needed. The states before a batch are read as of that batch, so a
    replay after a crash writes the same output again.

    A batch reads what it touches. The keys of the facts that hold a value of a dim are kept in an index, a keyed table in
    buckets of that value; with the facts that changed themselves they are the facts in question. Of the facts, and
    of dims whose key is the shared column, only the buckets of these keys and values are read; other dims are read whole.
    """
    def decode(batch, side):
        rows = batch.where(F.get_json_object("value", "$.source.table") == side.table)
        return split_key_updates(decode_envelope(rows, side.row, side.key)).persist()

    def path_of(side, index_of=None):
        return f"{state_path}/{side.table}" + (f"-by-{index_of.on}" if index_of else "")

    def held(side, changes, keys, batch_id):
        """Stored changes of the ``keys`` (column ``key``), or of all with None."""
        spark, path = changes.sparkSession, path_of(side)
        if keys is None:
            return read_changes(spark, path, changes.schema, batch_id)
        rows = read_changes(spark, path, changes.schema, batch_id, touched_buckets(keys, ("key",), load(spark, path)))
        return rows.join(keys, "key", "left_semi")

    def index_rows(changes, d):
        """Which fact key has which value of the dim: changes of the index. A value that a fact may have left stays until
        the fact's before image says so; it costs a look, no more."""
        def entry(op, image):
            return F.struct(F.col(f"{image}.{d.on}").alias("on"), F.lit(op).alias("op"))
        left = F.when(~F.col(f"before.{d.on}").eqNullSafe(F.col(f"after.{d.on}")), entry("d", "before"))
        moves = F.filter(F.array_compact(F.array(left, entry("c", "after"))), lambda e: e["on"].isNotNull())
        return changes.select("key", *S.ORDER, F.explode(moves).alias("_e")).select("_e.on", "key", "_e.op", *S.ORDER)

    def holders(d, index, values, batch_id):
        """Keys of the facts that hold one of the values (column ``on``)."""
        spark, path = values.sparkSession, path_of(fact, d)
        rows = read_changes(spark, path, index.schema, batch_id, touched_buckets(values, ("on",), load(spark, path)))
        return latest_changes(rows.join(values, "on", "left_semi"), ("on", "key")).where("op <> 'd'").select("key")

    def apply(batch, batch_id):
        kept = {s.table: decode(batch.select("value"), s) for s in (fact, *dims)}
        try:
            write(kept, batch_id, kept)
        finally:
            for df in kept.values():
                df.unpersist()

    def write(changes, batch_id, kept):
        own = changes[fact.table]
        indexes = {d.on: index_rows(own, d) for d in dims}
        values = {d.on: changes[d.table].select(F.explode(F.array_compact(F.array(f"before.{d.on}", f"after.{d.on}"))).alias("on")).distinct() for d in dims}
        keys = own.select("key")
        for d in dims:
            keys = keys.unionAll(holders(d, indexes[d.on], values[d.on], batch_id))
        keys = kept["keys of facts"] = keys.distinct().persist()
        before = held(fact, own, keys, batch_id)
        facts = kept["facts"] = before.unionByName(own).persist()
        moved = []
        for d in dims:
            rows, met = changes[d.table], None
            if d.key == [d.on]:
                met = facts.select(F.explode(F.array_compact(F.array(f"before.{d.on}", f"after.{d.on}"))).alias(d.on))
                met = met.unionAll(values[d.on]).distinct().select(F.struct(d.on).alias("key"))
                rows = rows.join(met, "key", "left_semi")
            past = held(d, rows, met, batch_id)
            moved.append(DimChange(materialize(past), materialize(past.unionByName(rows)), values[d.on].withColumnRenamed("on", d.on), d.on))
        touched = keys.select(f"key.{fact.key[0]}")
        result = enrich_changes(materialize(before), materialize(facts), touched, fact.key[0], moved, result_key)
        result.write.mode("overwrite").parquet(f"{out_path}/stream={stream_of(own.sparkSession)}/batch={batch_id}")
        for d in dims:
            upsert_batch(changes[d.table], path_of(d), batch_id)
            upsert_batch(indexes[d.on], path_of(fact, d), batch_id, ("on", "key"), bucket_by=("on",))
        upsert_batch(own, path_of(fact), batch_id)

    return (raw.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
