"""Log positions: order, resume points, gaps and lag."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from ..session import reliable_checkpoint
from . import spread


def offset(file: Column, pos: Column, event: Column | None = None, row: Column | None = None) -> Column:
    """A comparable offset; a missing number counts as 0."""
    zero = F.lit(0).cast("bigint")

    def number(c):
        return zero if c is None else F.coalesce(c.cast("bigint"), zero)
    return F.struct(F.coalesce(file, F.lit("")).alias("file"), number(pos).alias("pos"),
                    number(event).alias("event"), number(row).alias("row"))


def is_before(a: Column, b: Column) -> Column:
    return a < b


def is_at_or_before(a: Column, b: Column) -> Column:
    return a <= b


def is_after(a: Column, b: Column) -> Column:
    return a > b


def is_at_or_after(a: Column, b: Column) -> Column:
    return a >= b


def order_offsets(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.withColumns({"is_before": is_before(a, b), "is_at_or_before": is_at_or_before(a, b),
                           "is_after": is_after(a, b), "is_at_or_after": is_at_or_after(a, b)})


def missing_log_files(needed: DataFrame, available: DataFrame) -> DataFrame:
    """Needed log files that no longer exist. One row per distinct file on both sides."""
    files = needed.select("source", "file").distinct()
    kept = available.select("source", "file").distinct()
    return files.join(kept, ["source", "file"], "left_anti")


def earliest_log_file(available: DataFrame) -> DataFrame:
    return available.groupBy("source").agg(F.min("file").alias("earliest_file"))


def parse_gtid_set(df: DataFrame, column: str) -> DataFrame:
    """``sid:1-5:7, sid2:3`` texts to one row (sid, lo, hi) per interval."""
    entry = F.explode(F.split(F.regexp_replace(column, r"\s", ""), ",")).alias("_e")
    parts = df.select(entry).where("_e <> ''").select(F.split("_e", ":").alias("_p"))
    spans = parts.select(F.col("_p")[0].alias("sid"),
                         F.explode(F.slice("_p", F.lit(2), F.size("_p"))).alias("_s"))
    ends = F.split("_s", "-")
    lo = ends[0].cast("bigint")
    return spans.select(F.lower("sid").alias("sid"), lo.alias("lo"),
                        F.coalesce(F.get(ends, F.lit(1)).cast("bigint"), lo).alias("hi"))


def gtid_intervals(text: str) -> dict[str, list[tuple[int, int]]]:
    """The same text on the driver: merged intervals of each sid, in order."""
    found: dict[str, list[tuple[int, int]]] = {}
    for entry in "".join(text.split()).split(","):
        sid, *spans = entry.split(":")
        for span in spans:
            low, _, high = span.partition("-")
            found.setdefault(sid.lower(), []).append((int(low), int(high or low)))
    for sid, spans in found.items():
        merged: list[tuple[int, int]] = []
        for low, high in sorted(spans):
            if merged and low <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        found[sid] = merged
    return found


def in_gtid_set(df: DataFrame, gtid: Column, executed: str, out: str) -> DataFrame:
    """Add ``out``: whether the transaction id ``sid:number`` is in the set; null where it is missing or no such id.

    The set is as long as its text. Its intervals are constant arrays, one for each sid, searched by halving in generated
    code, however many gaps the set has.
    """
    spans = gtid_intervals(executed)
    parts = F.split(gtid, ":")
    number = F.get(parts, F.lit(1)).try_cast("bigint")
    df = df.withColumns({"_sid": F.lower(F.trim(F.get(parts, F.lit(0)))), "_n": number})
    if not spans:
        return df.withColumn(out, F.when(F.col("_n").isNotNull(), F.lit(False))).drop("_sid", "_n")
    none = F.array().cast("array<bigint>")

    def of_sid(side):
        sids = spread.literal_array(list(spans), T.StringType())
        lists = F.from_json(F.lit(json.dumps([[span[side] for span in own] for own in spans.values()])), "array<array<bigint>>")
        return F.coalesce(F.try_element_at(F.map_from_arrays(sids, lists), F.col("_sid")), none)
    df = spread.locate(df.withColumn("_lows", of_sid(0)), F.col("_n"), F.col("_lows"), max(map(len, spans.values())), "_at")
    inside = F.coalesce(F.get(of_sid(1), F.col("_at") - 1) >= F.col("_n"), F.lit(False))
    return df.withColumn(out, F.when(F.col("_n").isNotNull(), inside)).drop("_sid", "_n", "_lows", "_at")


def gtid_difference(a: DataFrame, b: DataFrame, rows_per_block: int = spread.ROWS_PER_BLOCK) -> DataFrame:
    """Transactions of ``a`` that are not in ``b`` as merged intervals (sid, lo, hi).

    A sweep over interval borders: +1 where an interval opens, -1 behind its end. Between two
    borders the running sums say which sets cover the stretch. A sid with many borders is cut into blocks once; the
    sums and the open stretch before a block are carried into it, one row each.
    """
    def borders(df, name, other):
        opened = df.select("sid", F.col("lo").alias("at"), F.lit(1).alias(name))
        closed = df.select("sid", (F.col("hi") + 1).alias("at"), F.lit(-1).alias(name))
        return opened.unionByName(closed).withColumn(other, F.lit(0))

    points = (borders(a, "da", "db").unionByName(borders(b, "db", "da")).groupBy("sid", "at")
              .agg(F.sum("da").alias("da"), F.sum("db").alias("db")).where("da <> 0 or db <> 0"))
    points = reliable_checkpoint(points)
    blocks = spread._blocks_of_hot_keys(points, ["sid"], "at", rows_per_block)
    hot = blocks is not None
    zero = F.lit(0).cast("bigint")
    here = Window.partitionBy("sid", "_block").orderBy("at")
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("sid").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    def of_blocks(rows, **values):
        """One row for each block of a hot sid."""
        per = rows.where(F.col("_block") > 0).groupBy("sid", "_block").agg(*[v.alias(n) for n, v in values.items()])
        return reliable_checkpoint(per)

    if hot:
        sums = of_blocks(blocks, _a=F.sum("da"), _b=F.sum("db"))
        sums = sums.select("sid", "_block", F.sum("_a").over(earlier).alias("_a"), F.sum("_b").over(earlier).alias("_b"))
        points = spread.join_small(blocks, sums, ["sid", "_block"], "left").withColumns({n: F.coalesce(n, zero) for n in ("_a", "_b")})
    else:
        points = points.withColumns({"_block": F.lit(0), "_a": zero, "_b": zero})

    def inside(ca, cb):
        return (ca > 0) & (cb == 0)
    points = points.withColumn("_in", inside(F.col("_a") + F.sum("da").over(so_far), F.col("_b") + F.sum("db").over(so_far)))
    was = F.coalesce(F.lag("_in").over(here), inside(F.col("_a"), F.col("_b")))
    # Keep only the borders where "in a and not in b" switches, then pair each switch-off with the
    # switch-on before it.
    switches = points.withColumn("_was", was).where("_in <> _was").select("sid", "_block", "at", "_in")
    opened = F.when(F.col("_in"), F.col("at"))
    since = F.last(opened, ignorenulls=True).over(so_far)
    if hot:
        switches = reliable_checkpoint(switches)
        last = of_blocks(switches, _open=F.max(opened)).select("sid", "_block", F.max("_open").over(earlier).alias("_open"))
        switches = spread.join_small(switches, last, ["sid", "_block"], "left")
        since = F.coalesce(since, F.col("_open"))
    return switches.withColumn("lo", since).where(~F.col("_in")).select("sid", "lo", (F.col("at") - 1).alias("hi"))


def lag_report(df: DataFrame, emit_ts: Column | None = None, by: tuple[str, ...] = ("db", "table"),
               percentiles: tuple[float, ...] = ()) -> DataFrame:
    """Event-to-fetch and fetch-to-emit lag in milliseconds; rows without the fields do not count.
    ``percentiles`` adds approximate ones of the fetch lag."""
    fetch = F.col("fetch_ts") - F.col("event_ts")
    emit = (F.col("emit_ts") if emit_ts is None else emit_ts) - F.col("fetch_ts")
    measured = df.withColumns({"_f": fetch, "_e": emit})
    return measured.groupBy(*by).agg(
        F.count("_f").alias("events"),
        F.max("_f").alias("max_fetch_lag"), F.avg("_f").alias("avg_fetch_lag"),
        F.max("_e").alias("max_emit_lag"), F.avg("_e").alias("avg_emit_lag"),
        F.max("fetch_ts").alias("last_fetch_ts"),
        *[F.percentile_approx("_f", p).alias(f"p{round(p * 100)}_fetch_lag") for p in percentiles])


def idle_time(report: DataFrame, now_ms: Column) -> DataFrame:
    return report.withColumn("idle_ms", now_ms - F.col("last_fetch_ts"))


def resume(log: DataFrame, state: DataFrame, by: tuple[str, ...] = ("db", "table")) -> DataFrame:
    """Events strictly after the committed offset of their source; unknown sources start at once."""
    known = state.select(*by, F.struct("pos", "sub").alias("_done"))
    joined = spread.join_small(log, known, list(by), "left")
    here = F.struct("pos", "sub")
    return joined.where(F.col("_done").isNull() | (here > F.col("_done"))).select(*log.columns)


def commit_progress(state: DataFrame, batch: DataFrame, by: tuple[str, ...] = ("db", "table")) -> DataFrame:
    """Highest position per source. An empty batch leaves the state as it was."""
    cols = [*by, "pos", "sub"]
    both = state.select(*cols).unionByName(batch.select(*cols))
    return (both.groupBy(*by).agg(F.max(F.struct("pos", "sub")).alias("_o"))
            .select(*by, "_o.pos", "_o.sub"))
