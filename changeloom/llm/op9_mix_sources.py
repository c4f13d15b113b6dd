"""Mixing sources to target weights by Poisson replication.

A source with n documents that is to make up the share s of an output of size N has the repetition rate
r = s * N / n. Each document draws its number of copies from the Poisson distribution with mean r, by inverting its
distribution function at a number in [0, 1) hashed from the seed, the id and the text; so the draw is the same
however the data are partitioned and however often a task is repeated. Copies are exploded and dealt over all tasks
by a hash, within which they are sorted by it: a global shuffle that needs neither a sort of the whole nor a sample.

Only DataFrame functions are used. Sources are counted with partial sums. The table of rates has one row per source;
it is written first, so that Spark knows its size and broadcasts it only if it is small, and otherwise joins by
shuffle, where adaptive execution splits a hot source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .stored import stored

SEED = "mix-1"
# Exponent of the source sizes where no weights are given: 1 keeps the mix, 0 makes all sources equal.
TEMPERATURE = 0.5
_BITS = 52


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, _BITS // 4), 16, 10).cast("bigint") / F.lit(float(1 << _BITS))


def rates(documents: DataFrame, weights: DataFrame | None = None, other: float = 0.0, temperature: float = TEMPERATURE, size: float = 1.0) -> DataFrame:
    """(source, n, rate, cdf) of each source; ``cdf`` are the Poisson probabilities of at most 0, 1, 2, ... copies.

    ``weights`` (source, weight) need not add up to 1; sources without a row get ``other``. Without weights a
    source's weight is its number of documents to the power ``temperature``. ``size`` is the output's size relative
    to the input's.
    """
    counted = documents.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counted = counted.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("_s")).agg(F.max("weight").cast("double").alias("weight"))
        counted = counted.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("weight", F.coalesce("weight", F.lit(other)))
    counted = stored(counted, "sources")
    documents_in, weight = counted.agg(F.sum("n"), F.sum("weight")).first()
    rate = F.col("weight") * (float(size) * (documents_in or 0)) / (float(weight or 0) or 1.0) / F.col("n")
    rated = counted.select("source", "n", rate.alias("rate"))
    # Beyond this number of copies less than 2 ** -52 of the distribution is left.
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = rated.withColumn("k", F.explode(F.sequence(F.lit(0), most)))
    up_to = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    terms = terms.withColumn("log_factorial", F.sum(F.when(F.col("k") > 0, F.ln("k")).otherwise(0.0)).over(up_to))
    p = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_factorial"))).otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    terms = terms.withColumn("c", F.sum(p).over(up_to))
    return (terms.groupBy("source", "n", "rate").agg(F.array_sort(F.collect_list(F.struct("k", "c"))).alias("steps"))
            .select("source", "n", "rate", F.transform("steps", lambda s: s["c"]).alias("cdf")))


def mix_sources(documents: DataFrame, weights: DataFrame | None = None, other: float = 0.0, temperature: float = TEMPERATURE,
                size: float = 1.0, seed: str = SEED) -> DataFrame:
    """The columns of ``documents`` and ``copy`` (1, 2, ...) and ``shuffle_key``, one row per copy, in shuffled order.

    A null source is a source of its own. Null ids and texts count as empty in the draw; equal rows draw equal
    numbers of copies, each for itself, and their copies have equal keys. Empty documents give no rows. Columns named copy or shuffle_key are
    replaced.
    """
    columns = [c for c in documents.columns if c not in ("copy", "shuffle_key")]
    known = stored(rates(documents, weights, other, temperature, size).select(F.col("source").alias("_source"), F.col("cdf").alias("_cdf")), "rates")
    own = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))]
    drawn = documents.select(*columns).withColumn("_u", uniform(*own))
    drawn = drawn.join(known, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.size(F.filter("_cdf", lambda c: c <= F.col("_u")))
    drawn = (drawn.withColumn("_n", copies).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
             .withColumn("shuffle_key", F.substring(F.md5(F.concat_ws(":", *own, F.col("copy").cast("string")).cast("binary")), 1, 16)))
    return drawn.select(*columns, "copy", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


_SQL = f"""WITH s AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), {TEMPERATURE}) AS weight FROM documents GROUP BY source),
t AS (SELECT sum(n) AS docs, sum(weight) AS w FROM s),
r AS (SELECT source, weight * CAST(docs AS DOUBLE) / w / n AS rate FROM s, t),
k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r),
f AS (SELECT *, sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (PARTITION BY source ORDER BY k) AS lf FROM k),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lf)) OVER (PARTITION BY source ORDER BY k) AS c FROM f),
d AS (SELECT *, '{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS own FROM documents),
u AS (SELECT *, CAST('0x' || substr(md5(own), 1, 13) AS BIGINT) / pow(2.0, {_BITS}) AS u FROM d),
n AS (SELECT u.doc_id, u.own, u.source, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.c <= u.u) AS n FROM u)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, substr(md5(own || ':' || CAST(copy AS VARCHAR)), 1, 16) AS shuffle_key
FROM (SELECT doc_id, source, own, unnest(range(1, n + 1)) AS copy FROM n)"""


@query("op9_mix_sources", _SQL)
def op9(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "copy", "shuffle_key")
