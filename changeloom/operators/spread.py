"""Order-dependent work without single-task groups.

A window over one key, or over no key at all, puts every row of that group into one task. The
helpers here cut an ordered column into *blocks* of bounded size at fence values, work inside the
blocks, and carry one row per block across the borders. Fences only decide who does which part of
the work, never the result, so a rough estimate of them is good enough.
"""

from __future__ import annotations

import base64
import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from ..session import reliable_checkpoint

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 8192
# Largest list of bounds placed in the plan as one literal array.
LITERAL_BOUNDS = 16_384
# Largest side joined by broadcast on row count; rows are a few columns wide.
BROADCAST_ROWS = 200_000
SALTS = 32

_PERCENTILE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                     T.DecimalType)


def literal_array(values: list, data_type: T.DataType) -> Column:
    """A constant array column; parsed once by constant folding however long it is."""
    def plain(v):
        if isinstance(v, (bytes, bytearray)):
            return base64.b64encode(v).decode()         # how JSON carries binary values
        return v if isinstance(v, (int, float)) else str(v)
    text = json.dumps([plain(v) for v in values])
    return F.from_json(F.lit(text), f"array<{data_type.simpleString()}>")


def locate(df: DataFrame, key: Column, bounds: Column, n: int, out: str) -> DataFrame:
    """Add ``out`` = how many of the ``n`` ascending ``bounds`` are <= ``key``.

    A binary search unrolled into log2(n) projections. They stay separate projections (each refers
    to the previous result twice) and run inside one code-generated stage.
    """
    df = df.withColumn(out, F.lit(0))
    step = 1 << (n.bit_length() - 1) if n else 0
    while step:
        probe = F.get(bounds, F.col(out) + F.lit(step - 1))
        df = df.withColumn(out, F.col(out) + F.when(probe <= key, step).otherwise(0))
        step //= 2
    return df


def fences(df: DataFrame, column: str, rows_per_block: int = ROWS_PER_BLOCK,
           max_blocks: int = MAX_BLOCKS) -> list:
    """At most ``max_blocks`` - 1 ascending values that cut ``column`` into similar parts."""
    dtype = df.schema[column].dataType
    values = df.select(column)
    rows = values.count()
    blocks = min(max_blocks, math.ceil(rows / rows_per_block))
    if blocks <= 1:
        return []
    if isinstance(dtype, _PERCENTILE_TYPES):
        shares = [i / blocks for i in range(1, blocks)]
        found = values.agg(F.percentile_approx(column, shares, 10 * blocks)).first()[0] or []
        return sorted({v for v in found if v is not None})
    # Other types: about 20 distinct values per block, chosen by hash.
    thin = max(1, rows // (blocks * 20))
    picked = (values.where(F.pmod(F.xxhash64(column), F.lit(thin)) == 0).distinct()
              .where(F.col(column).isNotNull()))
    picked = [r[0] for r in picked.sort(column).collect()]
    stride = max(1, math.ceil(len(picked) / blocks))
    return picked[stride::stride]


def with_block(df: DataFrame, column: str, cuts: list, out: str = "_block") -> DataFrame:
    bounds = literal_array(cuts, df.schema[column].dataType)
    return locate(df, F.col(column), bounds, len(cuts), out)


def running_total(df: DataFrame, order: str, value: Column, out: str, cuts: list | None = None,
                  keep_block: bool = False) -> DataFrame:
    """Inclusive running sum of ``value`` over the whole frame in the order of a unique column."""
    cuts = fences(df, order) if cuts is None else cuts
    df = with_block(df.withColumn("_v", value), order, cuts)
    inside = (Window.partitionBy("_block").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn(out, F.sum("_v").over(inside))
    if cuts:
        # One row per block, at most MAX_BLOCKS of them.
        before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        base = (df.groupBy("_block").agg(F.sum("_v").alias("_t"))
                .select("_block", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base")))
        df = (df.join(F.broadcast(base), "_block")
              .withColumn(out, F.col(out) + F.col("_base")).drop("_base"))
    return df.drop("_v") if keep_block else df.drop("_v", "_block")


def has_hot_key(df: DataFrame, keys: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> bool:
    """Whether a key has more than ``rows_per_block`` rows, by a count that is reduced map-side."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return (sizes.agg(F.max("_n")).first()[0] or 0) > rows_per_block


def _blocks_of_hot_keys(df: DataFrame, keys: list[str], order: str, rows_per_block: int | None) -> DataFrame | None:
    """``df`` with ``_block``: 0 for keys of usual size, and the part of ``order`` the row lies in for
    keys with more than ``rows_per_block`` rows. None when there is no such key, or when the caller
    knows so and passes None. There are at most rows / rows_per_block hot keys.
    """
    if rows_per_block is None or not has_hot_key(df, keys, rows_per_block):
        return None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = reliable_checkpoint(sizes.where(F.col("_n") > rows_per_block).select(*keys))
    marked = join_small(df, hot.withColumn("_hot", F.lit(True)), keys, "left")
    cuts = fences(join_small(df.select(*keys, order), hot, keys, "left_semi"), order, rows_per_block)
    located = with_block(marked, order, cuts)
    return located.withColumn("_block", F.when(F.col("_hot"), F.col("_block") + 1).otherwise(0)).drop("_hot")


def previous_by_key(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str,
                    rows_per_block: int | None = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key.

    Keys of usual size take a plain window. A hot key is spread over blocks of ``order[0]``; each
    block receives the last value of the key's previous block as one extra row, so that no group is
    much larger than a block.
    """
    df = df.withColumn(out, value)
    blocks = _blocks_of_hot_keys(df, keys, order[0], rows_per_block)
    if blocks is None:
        return df.withColumn(out, F.lag(out).over(Window.partitionBy(*keys).orderBy(*order)))
    last = (blocks.where(F.col("_block") > 0).groupBy(*keys, "_block")
            .agg(F.max_by(F.struct(F.col(out)), F.struct(*order)).alias("_last")))
    carried = (last.withColumn("_block", F.lead("_block").over(
                   Window.partitionBy(*keys).orderBy("_block")))
               .where(F.col("_block").isNotNull())
               .select(*keys, "_block", F.col(f"_last.{out}").alias(out), F.lit(0).alias("_real")))
    rows = blocks.withColumn("_real", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_block").orderBy("_real", *order)
    return (rows.withColumn(out, F.lag(out).over(inside))
            .where(F.col("_real") == 1).select(*df.columns))


def running_totals_by_key(df: DataFrame, keys: list[str], order: str, values: dict[str, Column],
                          rows_per_block: int | None = ROWS_PER_BLOCK) -> DataFrame:
    """Inclusive running sums per key, spread like :func:`previous_by_key`; ``order`` unique per key."""
    df = df.withColumns(values)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    blocks = _blocks_of_hot_keys(df, keys, order, rows_per_block)
    if blocks is None:
        inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(*so_far)
        return df.withColumns({out: F.sum(out).over(inside) for out in values})
    in_turn = Window.partitionBy(*keys).orderBy("_block")
    carried = (blocks.where(F.col("_block") > 0).groupBy(*keys, "_block")
               .agg(*[F.sum(out).alias(out) for out in values])
               .select(*keys, F.lead("_block").over(in_turn).alias("_block"),
                       *[F.sum(out).over(in_turn.rowsBetween(*so_far)).alias(out) for out in values],
                       F.lit(0).alias("_real"))
               .where(F.col("_block").isNotNull()))
    rows = blocks.withColumn("_real", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_block").orderBy("_real", order).rowsBetween(*so_far)
    return (rows.withColumns({out: F.sum(out).over(inside) for out in values})
            .where(F.col("_real") == 1).select(*df.columns))


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """Join a big side with a side that is expected to be small, and check that it is.

    Up to ``max_rows`` rows ``small`` is broadcast. Beyond that its rows are repeated once per salt
    and both sides are shuffled on (key, salt), which splits any hot key of the big side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if small.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(small), on, how)
    cols = df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols_hashable(df)), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def cols_hashable(df: DataFrame) -> list[str]:
    """Columns a hash function accepts (maps and variants are not hashable)."""
    def plain(t):
        if isinstance(t, (T.MapType, T.VariantType)):
            return False
        if isinstance(t, T.ArrayType):
            return plain(t.elementType)
        if isinstance(t, T.StructType):
            return all(plain(f.dataType) for f in t.fields)
        return True
    return [f.name for f in df.schema.fields if plain(f.dataType)]
