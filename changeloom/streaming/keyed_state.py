"""State per key in Spark's state store: the last change of each key, for before images and late changes; the snapshot
rows of a table while its snapshot runs.

State is one value a key, or, where keys are dealt over buckets by hash, one value a bucket: a dictionary of its keys, as plain
Python values in their pickled form. A bucket costs as many calls between Python and the state store as a key does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from .. import schema as S
from ..operators.changelog import Keys

#: Buckets of the state where it is in buckets. A batch reads and writes whole those that it touches.
BUCKETS = 4096


def _plain(value):
    """A value of a key as something that can be compared and looked up; equal where Spark groups it together."""
    if isinstance(value, dict):
        return tuple(map(_plain, value.values()))
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return "NaN" if isinstance(value, float) and value != value else value


class Bucket(StatefulProcessor):
    """Base of the processors: one dictionary for each group."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", StructType([StructField("held", BinaryType())]))

    def held(self) -> dict:
        value = self.state.get()
        return {} if value is None else pickle.loads(value[0])

    def hold(self, held: dict) -> None:
        self.state.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL),))

    def close(self) -> None:
        pass


class LastChange(StatefulProcessor):
    """Changes of a key in their order, less those at or before its last one.

    With ``images`` each change gets the image that its key had before, and upserts are told apart by it. The state of
    a key is one value: position, operation and image of its last change; deleted keys keep theirs, so that a late
    change does not bring them back. A batch reads and writes the values of the keys it holds, however many there are.
    """

    def __init__(self, schema: StructType, images: bool):
        self.columns, self.images = schema.fieldNames(), images
        self.state = StructType([*(StructField(c, schema[c].dataType) for c in S.ORDER), StructField("image", schema["after"].dataType)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        order = lambda r: tuple(r[c] for c in S.ORDER)
        held = self.last.get()
        last, image = (tuple(held[:-1]), held[-1]) if held is not None else (None, None)
        moved = False
        for row in sorted(rows, key=order):
            if last is not None and order(row) <= last:
                continue
            out = {c: row[c] for c in self.columns}
            if self.images:
                out["before"] = image
                if out["op"] in ("u", "c"):
                    out["op"] = "c" if image is None else "u"
            yield Row(**out)
            last, image, moved = order(row), row["after"], True
        if moved:
            self.last.update((*last, image))

    def close(self) -> None:
        pass


class LastChanges(Bucket):
    """The same for the keys of a bucket: of each, position and image (with ``images``) of its last change are kept."""

    def __init__(self, images: bool):
        self.images = images

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        def order(row):
            return tuple(row[c] for c in S.ORDER)
        held, out = self.held(), []
        for row in sorted((r["row"] for r in rows), key=order):
            at, which = order(row), _plain(row["key"])
            last, image = held.get(which, (None, None))
            if last is not None and at <= last:
                continue
            held[which] = (at, row["after"] if self.images else None)
            if self.images:
                row["before"] = image
                if row["op"] in ("u", "c"):
                    row["op"] = "c" if image is None else "u"
            out.append(row)
        if out:
            self.hold(held)
        yield from (Row(row=r) for r in out)


def _in_buckets(dealt: DataFrame, schema: StructType, by: list[str], processor: Bucket, time: str) -> DataFrame:
    """``dealt`` has whole rows in ``row``, so that each is passed to Python and back in one piece."""
    out = StructType([StructField("row", schema)])
    return dealt.groupBy(*by).transformWithState(processor, out, "Append", time).select("row.*")


def _by_key(stream: DataFrame, images: bool, buckets: int | None) -> DataFrame:
    keys = Keys(stream, ("key",))
    if buckets is None:
        return keys.add(stream).groupBy(*keys.names).transformWithState(LastChange(stream.schema, images), stream.schema, "Append", "None")
    bucket = F.pmod(F.xxhash64(*keys.columns), F.lit(buckets)).alias("bucket")
    return _in_buckets(stream.select(bucket, F.struct(*stream.columns).alias("row")), stream.schema, ["bucket"], LastChanges(images), "None")


def normalize(stream: DataFrame, buckets: int | None = None) -> DataFrame:
    """Upsert stream to a full changelog: each change with the image its key had before, a first upsert as a create.

    Repeated and late changes are dropped. Without ``buckets`` a batch costs what it holds, however large the state: right for
    small batches over many keys. A key then costs two calls between Python and the state store. Batches that touch most keys
    anyway are many times cheaper with the keys dealt over ``buckets`` (a number that stays for the life of a checkpoint): a
    batch costs its rows, two calls for each bucket that it touches, and about a microsecond for each key in them.

    The changes of one key, or bucket, in one micro-batch are put in order in one task, bounded by the trigger;
    ``streams.stream_normalize`` spreads a hot key. Append output; needs the RocksDB state store.
    """
    return _by_key(stream, True, buckets)


def late_guard(stream: DataFrame, buckets: int | None = None) -> DataFrame:
    """The changes of a stream as they are, less those at or before the last one of their key; ``buckets`` as in ``normalize``."""
    return _by_key(stream, False, buckets)


#: Operation of a row that says that the snapshot of its table is complete.
COMPLETE = "complete"


class SnapshotRows(Bucket):
    """The first copy of each snapshot row of one bucket of a table; forgotten ``delay_ms`` after the table is complete."""

    def __init__(self, by: list[str], delay_ms: int):
        self.by, self.delay = by, delay_ms

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen, out = self.held(), []
        for row in (r["row"] for r in rows):
            if row["op"] == COMPLETE:
                self.handle.registerTimer(row["event_ts"] + self.delay)
                continue
            which = tuple(_plain(row[c]) for c in self.by)
            if which not in seen:
                seen[which] = True
                out.append(row)
        if out:
            self.hold(seen)
        yield from (Row(row=r) for r in out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())


def dedup_snapshot(stream: DataFrame, by: list[str], delay_ms: int = 600_000, buckets: int = BUCKETS) -> DataFrame:
    """One copy of each snapshot row (op ``r``); other rows only move event time on.

    A row of op ``complete`` with the db and table of a snapshot and its ``event_ts`` ends it: once the log has moved
    ``delay_ms`` past that time, the table's rows are forgotten, so state is bounded by the snapshots that run. Copies must
    come before that. A table is dealt over ``buckets`` groups by a hash of ``by``; its end is told to each of them.
    """
    at = F.timestamp_millis(F.when(F.col("op") != "r", F.col("event_ts")))
    timed = stream.withColumn("_at", at).withWatermark("_at", "0 seconds")
    bucket = F.when(F.col("op") == "r", F.array(F.pmod(F.xxhash64(*by), F.lit(buckets)))).when(
        F.col("op") == COMPLETE, F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>"))
    dealt = timed.select("db", "table", "_at", F.struct(*stream.columns).alias("row"), F.explode(bucket).alias("bucket"))
    return _in_buckets(dealt, stream.schema, ["db", "table", "bucket"], SnapshotRows(by, delay_ms), "EventTime")
