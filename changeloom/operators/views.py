"""Views over materialised changelogs: enrichment joins and live aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def enrich(fact: DataFrame, *dims: tuple[DataFrame, list[str] | str]) -> DataFrame:
    """Left-join each (dim, key columns) to the fact in turn.

    No hint is given: the dims may be any size, and at run time Spark broadcasts one whose measured
    size is below its threshold, and otherwise splits the hot partitions of the sort-merge join.
    """
    for dim, on in dims:
        fact = fact.join(dim, on, "left")
    return fact


@dataclass(frozen=True)
class DimChange:
    """One dim of an incremental join: its rows before and after, and the ``on`` values it touched."""
    old: DataFrame
    new: DataFrame
    touched: DataFrame
    on: str


def enrich_changes(old_fact: DataFrame, new_fact: DataFrame, touched_fact: DataFrame, key: str,
                   dims: list[DimChange], result_key: list[str] | None = None) -> DataFrame:
    """Kinded rows that bring ``fact left join dims`` from its old to its new result.

    Only facts that changed themselves (``touched_fact`` holds their ``key`` values) or that meet a
    touched dim value are recomputed; results that stay the same cancel. ``result_key`` identifies a
    result row; name the dim's key too when a fact can meet several rows of it.
    """
    result_key = result_key or [key]

    def result(fact, side):
        cols = fact.columns
        marks = [(touched_fact, key), *[(d.touched, d.on) for d in dims]]
        hit = F.lit(False)
        for i, (touched, name) in enumerate(marks):
            flag = touched.select(name).distinct().withColumn(f"_hit{i}", F.lit(True))
            fact = fact.join(flag, name, "left")
            hit = hit | F.coalesce(F.col(f"_hit{i}"), F.lit(False))
        fact = fact.where(hit).select(*cols)
        return enrich(fact, *[(getattr(d, side), d.on) for d in dims])

    old, new = result(old_fact, "old"), result(new_fact, "new")
    cols = new.columns

    def side(df, name):
        return df.select(*[F.col(k).alias(f"_k_{k}") for k in result_key], F.struct(*cols).alias(name))
    # Both results meet in one shuffle; null parts of a key group together.
    both = (side(old, "old").unionByName(side(new, "new"), allowMissingColumns=True)
            .groupBy(*[f"_k_{k}" for k in result_key])
            .agg(*[F.first(n, ignorenulls=True).alias(n) for n in ("old", "new")]))

    def row(kind, name):
        return F.struct(F.lit(kind).alias("row_kind"), F.col(name).alias("r"))
    rows = (F.when(F.col("old").isNull(), F.array(row(S.INSERT, "new")))
            .when(F.col("new").isNull(), F.array(row(S.DELETE, "old")))
            .when(~F.col("old").eqNullSafe(F.col("new")),
                  F.array(row(S.UPDATE_BEFORE, "old"), row(S.UPDATE_AFTER, "new"))))
    return both.select(F.explode(rows).alias("_x")).select("_x.row_kind", "_x.r.*")


def sign() -> Column:
    return F.when(F.col("row_kind").isin(S.INSERT, S.UPDATE_AFTER), 1).otherwise(-1)


def aggregate_changes(kinded: DataFrame, group: list[str], measures: dict[str, Column]) -> DataFrame:
    """Live count and sums: additions add, retractions subtract, empty groups vanish."""
    aggs = [F.sum(sign() * m).alias(name) for name, m in measures.items()]
    return (kinded.groupBy(*group).agg(F.sum(sign()).alias("row_count"), *aggs)
            .where(F.col("row_count") != 0))


def change_counts(df: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """Changes per table, operation and time bucket (bucket start in milliseconds)."""
    bucket = F.expr(f"event_ts - pmod(event_ts, {bucket_ms}L)").alias("bucket_ts")
    return df.groupBy("db", "table", "op", bucket).agg(F.count(F.lit(1)).alias("changes"))
