"""Cut a keyed table into key ranges, and find the range a key falls in."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F, types as T

from .. import schema as S
from ..session import reliable_checkpoint
from . import spread

EVEN_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_NUMERIC = EVEN_TYPES + (T.FloatType, T.DoubleType)
MAX_FACTOR = float(np.finfo(np.float64).max)


# ---------------------------------------------------------------- statistics

def key_min_max(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def approx_row_count(df: DataFrame) -> DataFrame:
    """Row count; on parquet Spark answers it from the file footers without reading a column."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distribution_factor(low: Column, high: Column, rows: Column) -> Column:
    """(high - low + 1) / rows, rounded up to 4 digits; the largest double without rows."""
    wide = "decimal(30,10)"
    parts = (high.cast(wide) - low.cast(wide) + F.lit(1)) * F.lit(10000).cast("decimal(5,0)")
    count = rows.cast("decimal(20,0)")
    # Whole quotient plus one for any remainder: exact, where a decimal division would round first.
    remainder = parts % count
    whole = ((parts - remainder) / count).cast("decimal(38,0)")
    up = whole + F.when(remainder > 0, 1).otherwise(0)
    return F.when(rows == 0, F.lit(MAX_FACTOR)).otherwise(up.cast("double") / 10000)


def factor_of(low, high, rows: int) -> float:
    """The same on the driver, for two scalars and a count."""
    if type(low) is not type(high):
        raise TypeError(f"key bounds differ in type: {type(low).__name__}, {type(high).__name__}")
    if rows == 0:
        return MAX_FACTOR
    return math.ceil(Fraction(Decimal(high) - Decimal(low) + 1) * 10000 / rows) / 10000


# ---------------------------------------------------------------- plans

@dataclass(frozen=True)
class ChunkPlan:
    """How a table is cut. ``ends`` (end_no, end) is set on the uneven path only."""
    path: str                 # single | even | uneven
    key: str
    key_type: T.DataType
    chunks: int
    low: object = None
    high: object = None
    step: int | None = None
    ends: DataFrame | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """Chunk table: table, chunk_id, start, end; null bounds are open."""
        kind = self.key_type
        if self.path == "single":
            return spark.range(1).select(
                F.lit(name).alias("table"), F.col("id").alias("chunk_id"),
                F.lit(None).cast(kind).alias("start"), F.lit(None).cast(kind).alias("end"))
        if self.path == "even":
            wide = "decimal(38,%d)" % getattr(kind, "scale", 0)
            last = self.chunks - 1

            def bound(i):
                return (F.lit(str(self.low)).cast(wide) + i.cast("decimal(20,0)") * self.step).cast(kind)
            i = F.col("id")
            return spark.range(self.chunks).select(
                F.lit(name).alias("table"), i.alias("chunk_id"),
                F.when(i > 0, bound(i)).alias("start"),
                F.when(i < last, bound(i + 1)).alias("end"))
        # Chunk i runs from end i-1 to end i; the last one is open.
        end = F.col("end")
        firsts = self.ends.select((F.col("end_no") - 1).alias("chunk_id"), end,
                                  F.lit(None).cast(kind).alias("start"))
        nexts = self.ends.select(F.col("end_no").alias("chunk_id"),
                                 F.lit(None).cast(kind).alias("end"), end.alias("start"))
        return (firsts.unionByName(nexts).groupBy("chunk_id")
                .agg(F.max("start").alias("start"), F.max("end").alias("end"))
                .select(F.lit(name).alias("table"), "chunk_id", "start", "end"))


def chunk_key(key_columns: list[str], override: str | None = None) -> str:
    """First primary-key column unless another one of them is named."""
    if not key_columns:
        raise ValueError("a table without a primary key cannot be split; scan it whole")
    if override is None:
        return key_columns[0]
    if override not in key_columns:
        raise ValueError(f"chunk key {override!r} is not one of the primary key columns {key_columns}")
    return override


def chunk_evenly(key: str, kind: T.DataType, low, high, rows: int, size: int,
                 factor: float) -> ChunkPlan:
    """Ends low+step, low+2*step, ... up to high; one chunk when the table fits in one."""
    if rows <= size:
        return ChunkPlan("single", key, kind, 1, low, high)
    step = max(int(factor * size), 1)
    ends = int((Decimal(high) - Decimal(low)) // step)
    return ChunkPlan("even" if ends else "single", key, kind, ends + 1, low, high, step)


def chunk_unevenly(df: DataFrame, key: str, low, high, size: int, unique: bool,
                   rows_per_block: int = spread.ROWS_PER_BLOCK) -> ChunkPlan:
    """Each end is the largest of the ``size`` smallest keys at or after the previous end (the next
    distinct key if that is no progress); the walk stops at the largest key."""
    kind = df.schema[key].dataType
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    ends = (_ends_unique(keys, low, high, size, rows_per_block) if unique
            else _ends_repeated(keys, low, high, size, rows_per_block))
    ends = reliable_checkpoint(ends)
    n = ends.count()
    return ChunkPlan("uneven" if n else "single", key, kind, n + 1, low, high, None, ends)


def _ends_unique(keys, low, high, size, rows_per_block):
    # The lower bound counts itself, so ends are size-1 rows apart; size 1 moves on by one row.
    stride = max(size - 1, 1)
    ranked = spread.running_total(keys, "k", F.lit(1), "rank",
                                  spread.fences(keys, "k", rows_per_block))
    picked = ranked.where(((F.col("rank") - 1) % stride == 0) & (F.col("k") > F.lit(low))
                          & (F.col("k") < F.lit(high)))
    return picked.select(F.expr(f"(rank - 1) div {stride}").cast("bigint").alias("end_no"),
                         F.col("k").alias("end"))


def _inside(hi: np.ndarray, target: np.ndarray, own_last: bool) -> np.ndarray:
    """The row of the block that each row's step leads to; a step out of it leads to the row itself (``own_last``) or to
    one past the end."""
    rows = np.searchsorted(hi, target, "left")
    return np.where(rows < len(hi), rows, np.arange(len(hi)) if own_last else len(hi))


def _visited(hi: np.ndarray, target: np.ndarray, entry: int) -> np.ndarray:
    """The rows at which a walk from ``entry`` stops, ascending; after each pass twice as many are known."""
    jump = np.append(_inside(hi, target, own_last=False), len(hi))
    known = np.searchsorted(hi, [entry], "left")
    while known[-1] < len(hi):
        known, jump = np.append(known, jump[known]), jump[jump]
    return known[known < len(hi)]


def _ends_repeated(keys, low, high, size, rows_per_block):
    """With repeated keys each step depends on the one before, yet the blocks need not wait for each
    other: a block first says where it would be left for each of the ``size`` rows it can be entered
    at, these answers are followed from block to block, and then every block walks once."""
    counts = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    counts = reliable_checkpoint(counts)
    # The answers of all blocks together stay below 64 million small integers.
    cuts = spread.fences(counts, "k", rows_per_block,
                         max(1, min(spread.MAX_BLOCKS, (1 << 26) // size)))
    placed = spread.running_total(counts, "k", F.col("n"), "hi", cuts, keep_block=True)
    key_type = counts.schema["k"].dataType.simpleString()

    def steps(pdf):
        pdf = pdf.sort_values("hi")
        hi = pdf["hi"].to_numpy("int64")
        lo = hi - pdf["n"].to_numpy("int64")
        return pdf, lo, hi, np.where(lo + size > hi, lo + size, hi + 1)

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, lo, hi, target = steps(pdf)
        first, last = lo[0], hi[-1]
        # Each row's last stop in the block: every pass doubles the steps taken at once.
        stop = _inside(hi, target, own_last=True)
        while not np.array_equal(stop, further := stop[stop]):
            stop = further
        entry = first + np.arange(1, size + 1)
        inside = np.minimum(np.searchsorted(hi, entry, "left"), len(hi) - 1)
        out = np.where(entry > last, entry, target[stop[inside]])
        return pd.DataFrame({"block": [pdf["_block"].iloc[0]], "first": [first],
                             "leave": [(out - last).astype("int32")]})

    def follow(batches):
        offset = 1
        for pdf in batches:
            entries = []
            for first, leave in zip(pdf["first"], pdf["leave"]):
                entries.append(first + offset)
                offset = int(leave[offset - 1])
            yield pd.DataFrame({"block": pdf["block"], "entry": entries})

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, lo, hi, target = steps(pdf)
        return pdf.iloc[_visited(hi, target, int(pdf["entry"].iloc[0]))][["k"]]

    if cuts:
        leaves = placed.groupBy("_block").applyInPandas(exits, "block int, first bigint, leave array<int>")
        # At most MAX_BLOCKS short rows, in block order.
        entries = (leaves.repartition(1).sortWithinPartitions("block")
                   .mapInPandas(follow, "block int, entry bigint"))
        entered = placed.join(F.broadcast(entries), F.col("_block") == F.col("block")).drop("block")
    else:
        entered = placed.withColumn("entry", F.lit(1).cast("bigint"))
    visited = entered.groupBy("_block").applyInPandas(walk, f"k {key_type}")
    # Written once, because numbering the ends reads them more than once.
    ends = reliable_checkpoint(visited.where((F.col("k") > F.lit(low)) & (F.col("k") < F.lit(high))))
    numbered = spread.running_total(ends, "k", F.lit(1), "end_no")
    return numbered.select(F.col("end_no").cast("bigint").alias("end_no"), F.col("k").alias("end"))


def plan_chunks(df: DataFrame, key_columns: list[str], size: int = S.CHUNK_SIZE,
                override: str | None = None, lower: float = S.FACTOR_LOWER,
                upper: float = S.FACTOR_UPPER, even: bool | None = None,
                rows_per_block: int = spread.ROWS_PER_BLOCK) -> ChunkPlan:
    """Choose and run a splitting path. ``even`` forces one of the two for tests and tuning."""
    key = chunk_key(key_columns, override)
    kind = df.schema[key].dataType
    low, high, rows = df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if low is None or low == high:
        return ChunkPlan("single", key, kind, 1, low, high)
    if isinstance(kind, EVEN_TYPES) and even is not False:
        factor = factor_of(low, high, rows)
        if even or lower <= factor <= upper:
            return chunk_evenly(key, kind, low, high, rows, size, factor)
    return chunk_unevenly(df, key, low, high, size, len(key_columns) == 1, rows_per_block)


def chunk_predicates(plan: ChunkPlan, spark: SparkSession, quote: str = "", chunks_per_task: int = 1) -> list[str]:
    """SQL predicates for a JDBC scan with one task for each ``chunks_per_task`` neighbouring chunks.

    ``quote`` goes around the name of the key column. The list has one entry per task, so it is as long as the number of
    tasks the driver schedules; raise ``chunks_per_task`` to keep it short.
    """
    def literal(v):
        if isinstance(v, (int, float, Decimal)):
            return str(v)
        if isinstance(v, (bytes, bytearray)):
            return f"X'{v.hex().upper()}'"
        return "'" + str(v).replace("'", "''") + "'"

    k = f"{quote}{plan.key.replace(quote, quote + quote) if quote else plan.key}{quote}"
    out = []
    # Every task begins where one of its chunks does and ends where the next task begins.
    begins = [row.start for row in plan.table(spark, "t").where(F.col("chunk_id") % chunks_per_task == 0)
              .sort("chunk_id").toLocalIterator()]
    for start, end in zip(begins, [*begins[1:], None]):
        if start is None and end is None:
            out.append("1 = 1")
        elif start is None:
            out.append(f"{k} <= {literal(end)} AND NOT ({k} = {literal(end)})")
        elif end is None:
            out.append(f"{k} >= {literal(start)}")
        else:
            out.append(f"{k} >= {literal(start)} AND {k} <= {literal(end)} AND NOT ({k} = {literal(end)})")
    return out


# ---------------------------------------------------------------- membership

def in_range(key: Column, start: Column, end: Column, key_type: T.DataType | None = None,
             bound_type: T.DataType | None = None) -> Column:
    """start <= key < end with open null bounds. Different types compare as decimals when both are
    numeric and as strings otherwise."""
    if key_type is not None and bound_type is not None and key_type != bound_type:
        both = isinstance(key_type, _NUMERIC) and isinstance(bound_type, _NUMERIC)
        target = "decimal(38,10)" if both else "string"
        key, start, end = (c.cast(target) for c in (key, start, end))
    return (start.isNull() | (key >= start)) & (end.isNull() | (key < end))


def assign_chunk(df: DataFrame, plan: ChunkPlan, key: Column, out: str = "chunk_id",
                 literal_bounds: int = spread.LITERAL_BOUNDS) -> DataFrame:
    """Add the chunk number of ``key``.

    Even chunks are arithmetic. Uneven ones are a binary search in a constant array, as long as the
    bounds fit in one; more of them are found in two levels, through a join on the coarse level.
    """
    if plan.path == "single":
        return df.withColumn(out, F.lit(0).cast("bigint"))
    if plan.path == "even":
        exact = isinstance(plan.key_type, T.DecimalType) or plan.high - plan.low >= 2 ** 63
        kind = f"decimal(38,{getattr(plan.key_type, 'scale', 0)})" if exact else "bigint"
        low, high = (F.lit(str(v)).cast(kind) for v in (plan.low, plan.high))
        # Keys outside the planned range belong to the first and the last chunk.
        distance = F.least(F.greatest(key.cast(kind), low), high) - low
        return (df.withColumn("_d", distance)
                .withColumn(out, F.expr(f"cast(_d div {plan.step} as bigint)")).drop("_d"))
    kind = plan.key_type
    found = df.withColumn("_k", key.cast(kind))
    if plan.chunks - 1 <= literal_bounds:
        ends = [r.end for r in plan.ends.sort("end_no").collect()]
        found = spread.locate(found, F.col("_k"), spread.literal_array(ends, kind), len(ends), out)
        return found.withColumn(out, F.col(out).cast("bigint")).drop("_k")
    # Level one: every m-th end. Level two: the ends below it, as one sorted array per fence row.
    m = math.ceil((plan.chunks - 1) / literal_bounds)
    coarse = [r.end for r in plan.ends.where(F.col("end_no") % m == 0).sort("end_no").collect()]
    found = spread.locate(found, F.col("_k"), spread.literal_array(coarse, kind), len(coarse), "_f")
    # Ends j*m+1 .. j*m+m-1 lie above fence j.
    fine = (plan.ends.where(F.col("end_no") % m != 0)
            .groupBy(F.expr(f"cast(end_no div {m} as int)").alias("_f"))
            .agg(F.array_sort(F.collect_list("end")).alias("_ends")))
    # A fence row holds up to m - 1 ends, so the row limit shrinks with m.
    found = spread.join_small(found, fine, ["_f"], "left", max_rows=spread.BROADCAST_ROWS // m)
    found = found.withColumn("_ends", F.coalesce("_ends", F.array().cast(f"array<{kind.simpleString()}>")))
    found = spread.locate(found, F.col("_k"), F.col("_ends"), m - 1, out)
    return (found.withColumn(out, (F.col("_f") * m + F.col(out)).cast("bigint"))
            .drop("_k", "_f", "_ends"))


def chunk_balance(df: DataFrame, plan: ChunkPlan) -> DataFrame:
    return (assign_chunk(df.select(plan.key), plan, F.col(plan.key))
            .groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows")))


def chunk_by_bytes(df: DataFrame, key: str, target_bytes: int = S.DOCUMENT_CHUNK_MB << 20,
                   rows_per_block: int = spread.ROWS_PER_BLOCK) -> DataFrame:
    """Number each document by the byte position at which it starts in key order."""
    sized = df.select(key, F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint").alias("bytes"))
    total = spread.running_total(sized, key, F.col("bytes"), "_to",
                                 spread.fences(sized, key, rows_per_block))
    return total.select(key, "bytes", F.expr(f"cast((_to - bytes) div {target_bytes} as bigint)")
                        .alias("chunk_id"))
