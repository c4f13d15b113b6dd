"""Which tables, which columns, from which position."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators import progress
from .position import log_position, wide_position

# ---------------------------------------------------------------- tables

def full_name() -> Column:
    return F.concat_ws(".", "db", "table")


def capture_filter(databases: Sequence[str] = (), tables: Sequence[str] = (),
                   table_list: Sequence[str] = (), name: Column | None = None) -> Column:
    """True for captured names. Patterns must match the whole ``db.table``; exact names are added to
    what the patterns match; without any of them everything is captured."""
    name = full_name() if name is None else name
    parts = []
    if databases or tables:
        any_of = [f"({'|'.join(p)})" if p else ".*" for p in (databases, tables)]
        parts.append(name.rlike(r"^(?:" + any_of[0] + r"\." + any_of[1] + r")$"))
    if table_list:
        parts.append(name.isin(*table_list))
    if not parts:
        return F.lit(True)
    return parts[0] if len(parts) == 1 else parts[0] | parts[1]


def capture_tables(df: DataFrame, databases: Sequence[str] = (), tables: Sequence[str] = (),
                   table_list: Sequence[str] = ()) -> DataFrame:
    return df.where(capture_filter(databases, tables, table_list))


def newly_added_tables(state: DataFrame, catalog: DataFrame, databases: Sequence[str] = (),
                       tables: Sequence[str] = ()) -> DataFrame:
    """Catalog tables that are captured now and have no saved state yet: db, table."""
    named = catalog.select("db", "table").distinct()
    return capture_tables(named, databases, tables).join(state.select("db", "table"), ["db", "table"], "left_anti")


def read_with_new_tables(snapshot: DataFrame, log: DataFrame, state: DataFrame, added: DataFrame,
                         high: DataFrame | None = None) -> DataFrame:
    """New tables from snapshot and log, known ones from their saved position.

    ``high`` (db, table, pos) says up to which position each new table's snapshot may already contain the log's
    changes: those are folded into the snapshot rows, and only later ones follow as changes, so that every change
    counts once. Without it the snapshot is taken to be older than the whole log.
    """
    from ..operators import spread
    from ..operators.changelog import latest_changes
    from ..operators.progress import resume
    kind = log.schema["pos"].dataType
    snapshot = snapshot.withColumn("pos", F.col("pos").cast(kind))
    # A table is one key of these joins, so its rows must not meet in one task.
    by = ["db", "table"]
    new_rows, new_log = (spread.join_small(df, added.select(*by), by, "left_semi") for df in (snapshot, log))
    if high is None:
        fresh = new_rows.unionByName(new_log)
    else:
        marked = spread.join_small(new_log, high.select(*by, F.col("pos").alias("_high")), by, "left")
        marked = marked.withColumn("_high", F.when(F.col("_high").isNotNull(), F.col("_high")).otherwise(
            F.raise_error(F.concat(F.lit("no snapshot position for "), full_name())).cast(kind)))
        early, late = marked.where("pos <= _high").drop("_high"), marked.where("pos > _high").drop("_high")
        none = F.lit(None).cast(snapshot.schema["before"].dataType)
        seen = latest_changes(new_rows.unionByName(early), ("db", "table", "key")).where(F.col("op") != "d")
        fresh = seen.withColumns({"op": F.lit("r"), "before": none}).unionByName(late)
    known = spread.join_small(log, state.select(*by), by, "left_semi")
    return fresh.unionByName(resume(known, state))


# ---------------------------------------------------------------- columns

# Named converters from a change row to a metadata value; callers may add their own.
METADATA: dict[str, Callable[[], Column]] = {
    "database_name": lambda: F.col("db"),
    "schema_name": lambda: F.col("schema"),
    "table_name": lambda: F.col("table"),
    "collection_name": lambda: F.col("table"),
    "tenant_name": lambda: F.col("db"),
    "op_ts": lambda: F.when(F.col("op") == "r", F.lit(0).cast("bigint")).otherwise(F.col("event_ts")),
}


def with_metadata(df: DataFrame, names: Sequence[str],
                  converters: Mapping[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Append read-only metadata columns, in the order asked for."""
    known = {**METADATA, **(converters or {})}
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown metadata columns: {unknown}")
    return df.withColumns({n: known[n]() for n in names})


def project(df: DataFrame, columns: Mapping[str, Callable[[Column], Column] | str]) -> DataFrame:
    """Projection of the payload, applied to both images: name -> source field or function of it."""
    def image(side):
        made = [(F.col(side)[how] if isinstance(how, str) else how(F.col(side))).alias(name)
                for name, how in columns.items()]
        return F.when(F.col(side).isNotNull(), F.struct(*made))
    return df.withColumns({"before": image("before"), "after": image("after")})


def declare(rows: DataFrame, columns: Mapping[str, str], case_sensitive: bool = False) -> DataFrame:
    """Cast to the declared physical columns. Case-sensitive sources must match names exactly."""
    present = {c: c for c in rows.columns} if case_sensitive else {c.lower(): c for c in rows.columns}
    chosen = []
    for name, kind in columns.items():
        source = present.get(name if case_sensitive else name.lower())
        if source is None:
            raise ValueError(f"declared column {name!r} is not in the source")
        chosen.append(F.col(f"`{source}`").cast(kind).alias(name))
    return rows.select(*chosen)


def apply_transforms(df: DataFrame, transforms: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Pass the frame through each function in order."""
    for step in transforms:
        df = df.transform(step)
    return df


def deserialize(df: DataFrame, function: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """User rows from records: ``function`` takes a record as a dict and gives any number of rows of ``schema``.

    Values pass through Arrow with their own types, so nullable integers stay exact.
    """
    target = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def convert(batches):
        for batch in batches:
            rows = [made for record in batch.to_pylist() for made in function(record)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
    return df.mapInArrow(convert, target)


# ---------------------------------------------------------------- positions

MODES = ("initial", "initial-only", "earliest-offset", "latest-offset", "specific-offset", "timestamp")
# Startup modes each source accepts.
SOURCE_MODES = {
    "mysql": ("initial", "earliest-offset", "latest-offset", "specific-offset", "timestamp"),
    "base": ("initial", "latest-offset"),
    "oracle": ("initial", "latest-offset"),
    "postgres": ("initial",),
    "sqlserver": ("initial", "initial-only", "latest-offset"),
    "db2": ("initial", "latest-offset"),
    "tidb": ("initial", "latest-offset"),
    "oceanbase": ("initial", "latest-offset", "timestamp"),
    "mongodb": ("initial", "latest-offset"),
}


def start_after_gtids(df: DataFrame, executed: str, gtid: str = "gtid") -> DataFrame:
    """Log rows whose transaction is not in the set ``executed`` (``sid:1-5:7, sid2:1-9``); column ``gtid`` holds each
    row's ``sid:number``. The set may have gaps and any number of sids: a transaction is left out because it is in the set,
    not because others of its sid come later. Snapshot rows are left out; a log row without an id is an error.
    """
    log = progress.in_gtid_set(df.where(F.col("op") != "r"), F.col(gtid), executed, "_done")
    missing = F.raise_error(F.lit(f"a change has no transaction id in {gtid}")).cast("boolean")
    return log.where(~F.coalesce("_done", missing)).drop("_done")


def start_from(df: DataFrame, mode: str = "initial", *, offset: int | str | tuple[str | int, ...] | None = None,
               now_pos: int | None = None, timestamp_ms: int | None = None, skip_events: int = 0,
               skip_rows: int = 0, source: str | None = None) -> DataFrame:
    """Startup position over snapshot (``op = 'r'``) and log rows. ``offset`` is a position, or a log file (its name
    or number) and a place in it, or the fields of a wide position. ``skip_events`` events, and then ``skip_rows`` rows
    of the next one, are left out."""
    if mode not in (SOURCE_MODES[source] if source else MODES):
        raise ValueError(f"startup mode {mode!r} is not supported" + (f" by {source}" if source else ""))
    log = F.col("op") != "r"
    if mode == "initial":
        return df
    if mode == "initial-only":
        return df.where(~log)
    if mode == "earliest-offset":
        return df.where(log)
    if mode == "latest-offset":
        if now_pos is None:
            now_pos = df.where(log).agg(F.max("pos")).first()[0]
        return df.where(log & (F.col("pos") > F.lit(now_pos)))
    if mode == "timestamp":
        return df.where(log & (F.col("event_ts") >= timestamp_ms))
    if dict(df.dtypes)["pos"] == "string":
        offset = offset if isinstance(offset, str) else wide_position(*(offset if isinstance(offset, tuple) else (offset,)))
    elif isinstance(offset, tuple):
        offset = log_position(*offset)
    rows = df.where(log & (F.col("pos") >= offset))
    if not (skip_events or skip_rows):
        return rows
    # Position of the first event that is kept: the (skip_events + 1)-th one. A bounded top-k.
    first = (rows.select("pos").distinct().orderBy("pos").limit(skip_events + 1)
             .agg(F.max("pos").alias("pos"), F.count(F.lit(1)).alias("n")).first())
    if first.n <= skip_events:
        return rows.limit(0)
    if not skip_rows:
        return rows.where(F.col("pos") >= first.pos)
    # The rows of one event, numbered in their order.
    n = F.dense_rank().over(Window.partitionBy("pos").orderBy("sub"))
    begun = rows.where(F.col("pos") == first.pos).withColumn("_n", n).where(F.col("_n") > skip_rows).drop("_n")
    return rows.where(F.col("pos") > first.pos).unionByName(begun)
