"""Keyed, idempotent tables on plain parquet, in hash buckets, for several writers at a time.

Layout of a table directory:

    commits/N.json           one commit, N without gaps; creating the file is what commits
    commits/N.state.json     all commits up to N in one, so that readers need few files
    data/v=delta-S-B/bucket=K/   latest change row per key of batch B of stream S
    data/v=fold-X/bucket=K/      latest row per key of what one fold put together

A commit either adds the folder of a batch or says that, in some buckets, one new folder stands for several older
ones. Version numbers are claimed by creating a file that must not exist yet, so of two writers one goes first and the other
looks again. Data folders belong to no version: a batch that was written before another writer's fold and committed after
it is simply added, and a fold replaces only folders that it names and that are all still in use.

A batch costs what it holds: it is reduced to one row per key and written by bucket. Where a bucket has gathered too many
folders, that bucket is folded and no other, its small folders first, so that large ones are not written again for each. Readers take the latest row per key, of all buckets or of those they ask for.
A batch that is replayed after a crash is recognised by its stream and id; batches of other streams, or of a new
checkpoint, are new, and the order of the changes decides which row of a key wins, so applying the same change again, in
whatever batch, changes nothing. The last batch of a stream is never folded while it may be replayed, so a replay
can read the table as it was before. Deleted keys stay as tombstones with their position, so that a late change does not
bring them back.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changelog import Keys, latest_changes, materialize
from .files import Folder

#: Buckets of a new table. A batch writes at most a file or a few for each.
BUCKETS = 16
#: Commits after which they are put together in one file.
STATE_EVERY = 20
#: How long the last batch of a stream that does not go on is kept apart for a replay.
REPLAY_MS = 7 * 24 * 3600 * 1000


def stream_of(spark: SparkSession) -> str:
    """Identity of the streaming query that this batch belongs to: its checkpoint's id. Batches outside of one share a name."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


class Table:
    """What the commits of a table say so far."""

    def __init__(self, said: dict | None = None):
        said = said or {}
        self.version: int = said.get("version", -1)
        self.buckets: int = said.get("buckets", 0)
        self.live: dict[str, set[int]] = {name: set(b) for name, b in said.get("live", {}).items()}
        self.deltas: dict[str, list] = said.get("deltas", {})       # live delta: [stream, batch id, time]
        self.last: dict[str, int] = said.get("last", {})            # stream: its last batch id
        self.bytes: dict[str, dict[str, int]] = said.get("bytes", {})   # live folder: bytes of each bucket

    def said(self) -> dict:
        return {"version": self.version, "buckets": self.buckets, "live": {n: sorted(b) for n, b in self.live.items()},
                "deltas": self.deltas, "last": self.last, "bytes": self.bytes}

    def apply(self, commit: dict) -> None:
        self.version = commit["version"]
        if commit["kind"] == "create":
            self.buckets = commit["buckets"]
        elif commit["kind"] == "add":
            stream, batch_id = commit["stream"], commit["batch_id"]
            if self.has(stream, batch_id):
                return
            self.last[stream] = batch_id
            if commit["in"]:
                self.live[commit["data"]] = set(commit["in"])
                self.deltas[commit["data"]] = [stream, batch_id, commit["time"]]
                self.bytes[commit["data"]] = commit.get("bytes", {})
        elif commit["kind"] == "fold":
            for bucket, replaced in commit["replaces"].items():
                bucket = int(bucket)
                # Folded twice at the same time: the first one counts.
                if not all(bucket in self.live.get(name, ()) for name in replaced):
                    continue
                for name in replaced:
                    self.live[name].discard(bucket)
                self.live.setdefault(commit["data"], set()).add(bucket)
            self.live = {name: b for name, b in self.live.items() if b}
            self.bytes[commit["data"]] = commit.get("bytes", {})
            self.deltas = {name: d for name, d in self.deltas.items() if name in self.live}
            self.bytes = {name: b for name, b in self.bytes.items() if name in self.live}

    def has(self, stream: str, batch_id: int) -> bool:
        return stream in self.last and self.last[stream] >= batch_id

    def folders(self, bucket: int) -> list[str]:
        return sorted(name for name, b in self.live.items() if bucket in b)

    def foldable(self, bucket: int, now: float) -> list[str]:
        """Folders of a bucket, less the last batch of each stream that may still be replayed."""
        def may_return(name):
            stream, batch_id, at = self.deltas.get(name, ("", 0, 0))
            return name in self.deltas and self.last.get(stream) == batch_id and now - at < REPLAY_MS
        return [name for name in self.folders(bucket) if not may_return(name)]

    def small(self, bucket: int, names: list[str]) -> list[str]:
        """As many of the folders as can be folded so that each row comes into one of at least twice the size that it was in."""
        def size(name):
            return self.bytes.get(name, {}).get(str(bucket), 0)
        names = sorted(names, key=lambda name: (size(name), name))
        sizes = [size(name) for name in names]
        return names[:max((n for n in range(2, len(names) + 1) if sizes[n - 1] <= sum(sizes[:n - 1])), default=0)]


def _commits(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, f"{path}/commits")


def load(spark: SparkSession, path: str) -> Table | None:
    """The table as committed; None where there is none."""
    folder = _commits(spark, path)
    names = [n for n in folder.names() if n.endswith(".json") and not n.startswith(".")]
    states = sorted(n for n in names if n.endswith(".state.json"))
    table = Table(json.loads(folder.read(states[-1])) if states else None)
    after = sorted(n for n in names if not n.endswith(".state.json") and int(n[:-5]) > table.version)
    for name in after:
        commit = json.loads(folder.read(name))
        if commit["version"] != table.version + 1:
            raise ValueError(f"commit {table.version + 1} of {path} is missing")
        table.apply(commit)
    return table if table.version >= 0 else None


def _commit(spark: SparkSession, path: str, make: Callable[[Table], dict | None]) -> bool:
    """Commit what ``make`` gives for the table as it is; when another writer was first, look again. False where it gives nothing."""
    folder = _commits(spark, path)
    while True:
        table = load(spark, path) or Table()
        commit = make(table)
        if commit is None:
            return False
        version = table.version + 1
        if not folder.claim(f"{version:020d}.json", json.dumps({"version": version, **commit})):
            continue
        states = [int(n.split(".")[0]) for n in folder.names() if n.endswith(".state.json") and n[0] != "."]
        if max(states, default=-1) >= version and commit["kind"] == "add" and not load(spark, path).has(commit["stream"], commit["batch_id"]):
            # The number was free only because old commits have been put together and removed meanwhile.
            folder.delete(f"{version:020d}.json")
            continue
        if version and version % STATE_EVERY == 0:
            table.apply({"version": version, **commit})
            folder.claim(f"{version:020d}.state.json", json.dumps(table.said()))
        return True


def open_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Table:
    """The table, created with so many buckets where there is none."""
    table = load(spark, path)
    if table is None:
        _commit(spark, path, lambda t: {"kind": "create", "buckets": buckets} if t.version < 0 else None)
        table = load(spark, path)
    return table


def bucket_of(df: DataFrame, by: tuple[str, ...], buckets: int) -> Column:
    """Bucket of the key of each row of ``df``."""
    return F.pmod(F.xxhash64(*Keys(df, by).columns), F.lit(buckets)).cast("int")


def touched_buckets(rows: DataFrame, by: tuple[str, ...], table: Table | None) -> set[int]:
    """Buckets that the keys of ``rows`` lie in: at most as many numbers as the table has buckets."""
    if table is None:
        return set()
    return {r[0] for r in rows.select(bucket_of(rows, by, table.buckets)).distinct().collect()}


def _write(rows: DataFrame, path: str, bucket: Column, partition_by: tuple[str, ...]) -> None:
    # Small partitions in few files each, large ones split over many tasks.
    split = ["bucket", *partition_by]
    rows.withColumn("bucket", bucket).hint("rebalance", *map(F.col, split)).write.mode("overwrite").partitionBy(*split).parquet(path)


def _bytes(spark: SparkSession, path: str, name: str) -> dict[str, int]:
    """Bytes of each bucket of a folder, by its number as text."""
    folder = Folder(spark, f"{path}/data/v={name}")
    return {n.split("=")[1]: folder.bytes(n) for n in folder.names() if n.startswith("bucket=")}


def _read(spark: SparkSession, path: str, schema, places: dict[str, Iterable[int]]) -> DataFrame:
    """Rows of some buckets of some folders."""
    parts = [f"{path}/data/v={name}/bucket={b}" for name, own in sorted(places.items()) for b in sorted(own)]
    if not parts:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*parts)
    return read.select(*[f.name for f in schema.fields])


def read_changes(spark: SparkSession, path: str, schema, before: int | None = None, buckets: set[int] | None = None) -> DataFrame:
    """Rows of the table as change rows, of all buckets or some; ``before`` leaves out that batch and later ones of the same
    stream, so that a replayed batch sees the table as it was the first time."""
    table, own = load(spark, path), stream_of(spark)
    if table is None:
        return spark.createDataFrame([], schema)

    def wanted(name):
        stream, batch_id, _ = table.deltas.get(name, (None, 0, 0))
        return before is None or stream != own or batch_id < before
    return _read(spark, path, schema, {name: in_ if buckets is None else in_ & buckets for name, in_ in table.live.items() if wanted(name)})


def read_table(spark: SparkSession, path: str, schema, by: tuple[str, ...] = ("key",),
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Current rows. ``schema`` is that of the change rows that were written."""
    return materialize(read_changes(spark, path, schema), by, keep)


def write_batch(batch: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ("key",), partition_by: tuple[str, ...] = (),
                buckets: int = BUCKETS, bucket_by: tuple[str, ...] | None = None) -> dict:
    """Write the folder of a batch and return the commit that makes it visible. ``bucket_by`` names some of the columns of
    ``by``, where rows are looked up by those; it must always be the same for a table."""
    spark = batch.sparkSession
    table, stream = open_table(spark, path, buckets), stream_of(spark)
    # Stream and id in the name make a rewrite after a crash land on its own unfinished attempt.
    name = f"delta-{stream}-{batch_id}"
    _write(latest_changes(batch, by), f"{path}/data/v={name}", bucket_of(batch, bucket_by or by, table.buckets), partition_by)
    written = _bytes(spark, path, name)
    return {"kind": "add", "stream": stream, "batch_id": batch_id, "data": name, "in": sorted(map(int, written)), "bytes": written, "time": int(time.time() * 1000)}


def commit_batch(spark: SparkSession, path: str, commit: dict) -> bool:
    """Make a written batch visible; False when this batch of this stream is already in."""
    return _commit(spark, path, lambda t: None if t.has(commit["stream"], commit["batch_id"]) else commit)


def upsert_batch(batch: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ("key",),
                 partition_by: tuple[str, ...] = (), compact_every: int = 20, buckets: int = BUCKETS,
                 bucket_by: tuple[str, ...] | None = None) -> bool:
    """Apply change rows; False when this batch of this stream is already in. The last change per key wins."""
    spark = batch.sparkSession
    table = open_table(spark, path, buckets)
    if table.has(stream_of(spark), batch_id):
        return False
    compact(spark, path, batch.schema, by, partition_by, compact_every, bucket_by, whole=False)
    return commit_batch(spark, path, write_batch(batch, path, batch_id, by, partition_by, buckets, bucket_by))


def compact(spark: SparkSession, path: str, schema, by: tuple[str, ...] = ("key",),
            partition_by: tuple[str, ...] = (), over: int = 1, bucket_by: tuple[str, ...] | None = None, whole: bool = True) -> None:
    """Fold the buckets that more than ``over`` folders can be folded in; deleted keys stay as their last change.

    Not ``whole``, a fold leaves out folders larger than all smaller ones together, so that a row is written about as often
    as the table doubles, not once a fold; ``over`` then counts the folders that are left, and readers find a few more.
    """
    table, now = load(spark, path), time.time() * 1000
    if table is None:
        return
    found = {b: table.foldable(b, now) for b in range(table.buckets)}
    due = {b: names for b, own in found.items() if len(names := own if whole else table.small(b, own)) > over}
    if not due:
        return
    places: dict[str, set[int]] = {}
    for bucket, names in due.items():
        for name in names:
            places.setdefault(name, set()).add(bucket)
    name = f"fold-{uuid.uuid4().hex}"
    rows = latest_changes(_read(spark, path, schema, places), by)
    _write(rows, f"{path}/data/v={name}", bucket_of(rows, bucket_by or by, table.buckets), partition_by)
    sizes = _bytes(spark, path, name)
    _commit(spark, path, lambda t: {"kind": "fold", "data": name, "bytes": sizes, "replaces": {str(b): names for b, names in due.items()}})


def vacuum(spark: SparkSession, path: str, older_than_ms: int = 24 * 3600 * 1000) -> None:
    """Delete data folders that no commit uses, and commits that a later state holds, once they are that old. The grace
    must be longer than any reader or writer of the table takes."""
    table, now = load(spark, path), time.time() * 1000
    if table is None:
        return
    data, commits = Folder(spark, f"{path}/data"), _commits(spark, path)
    for name, at in data.names().items():
        if name.startswith("v=") and name[2:] not in table.live and now - at > older_than_ms:
            data.delete(name)
    names = commits.names()
    newest = max((int(n.split(".")[0]) for n in names if n.endswith(".state.json") and n[0] != "."), default=-1)
    for name, at in names.items():
        stray = name.startswith(".")
        if now - at > older_than_ms and (stray or int(name.split(".")[0]) < newest):
            commits.delete(name)


def upsert_sink(stream: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("key",),
                partition_by: tuple[str, ...] = (), compact_every: int = 20, trigger: dict | None = None,
                query_name: str | None = None, buckets: int = BUCKETS):
    """Start a query that keeps the table at ``path`` up to date, each change applied once."""
    def apply(batch, batch_id):
        upsert_batch(batch, path, batch_id, by, partition_by, compact_every, buckets)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


LAKE_KEY = ("db", "table", "key")


def lake_sink(stream: DataFrame, path: str, checkpoint: str, **options):
    """Many tables and shards in one directory: key (db, table, key), partitioned by table so that a
    reader of one table touches only its files."""
    return upsert_sink(stream, path, checkpoint, LAKE_KEY, ("db", "table"), **options)
