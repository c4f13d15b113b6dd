"""Document fingerprints by consistent weighted sampling.

A document is a bag of lower-cased words weighted by their counts. Sample k draws for each term two Gamma(2, 1) variables r
and c and a uniform b, hashed from (term, k) alone. A term of weight w gets t = floor(ln w / r + b) and the rank
ln c - r * (t - b + 1); the term of smallest rank is the sample. Its rank depends on (term, t) only and stands for it,
so two documents agree in a sample with probability sum(min(w, w')) / sum(max(w, w')), the generalised Jaccard
similarity. The fingerprint holds 32 bits of each of SAMPLES samples; likeness is the share of equal ones.

``compare_neighbours`` fingerprints each text, an edited text that borrows from the next document, and compares. Only
DataFrame functions are used. Ids are cut into blocks of BLOCK_IDS; each block also gets the first row of the next one,
so a single shuffle of the texts by block is all that order, fingerprints and comparison need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .stored import stored

SAMPLES = 48
BLOCK_IDS = 256
# Blocks whose order is settled together.
GROUP_BLOCKS = 4096
NULL_ID = -2 ** 63


def _uniform(hashed: str, shift: int, bits: int) -> str:
    return f"((shiftrightunsigned({hashed}, {shift}) & {(1 << bits) - 1}L) + 0.5D) / {float(1 << bits)}D"


def rank(k: int, term: str = "term", log_weight: str = "log_weight") -> Column:
    """Rank of a term of that weight in sample k."""
    # The 64 bits of one hash make all five uniform numbers.
    bits = f"xxhash64({term}, {k})"
    r = f"(-ln({_uniform(bits, 0, 13)} * ({_uniform(bits, 13, 13)})))"
    c = f"(-ln({_uniform(bits, 26, 14)} * ({_uniform(bits, 40, 14)})))"
    b = f"({_uniform(bits, 54, 10)})"
    return F.expr(f"ln({c}) - {r} * (floor({log_weight} / {r} + {b}) - {b} + 1)")


def weighted_terms(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text``, a row for each distinct word with its hash ``term`` and ``log_weight``; a text without words
    keeps one row with nulls.
    """
    hashes = F.transform(F.split(F.lower(F.col(text)), r"\s+"), lambda w: F.xxhash64(w))
    # Splitting gives empty words at the ends.
    df = df.withColumn("_s", F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))).drop(text)
    # Ends of the runs of equal hashes in the sorted array; positions count from 1.
    ends = F.filter(F.sequence(F.lit(1), F.size("_s")), lambda i: (i == F.size("_s")) | (F.get("_s", i - 1) != F.get("_s", i)))
    df = df.withColumn("_e", F.when(F.size("_s") > 0, ends))
    runs = F.transform("_e", lambda i, j: F.struct(F.get("_s", i - 1).alias("t"), (i - F.when(j > 0, F.get("_e", j - 1)).otherwise(0)).alias("w")))
    df = df.select(*[c for c in df.columns if c not in ("_s", "_e")], F.explode_outer(runs).alias("_r"))
    return df.withColumn("term", F.col("_r.t")).withColumn("log_weight", F.ln("_r.w")).drop("_r")


def fingerprints(df: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``signature`` (array of 32-bit numbers) of each group of keys; no words give zeros."""
    terms = weighted_terms(df.select(*keys, text), text)
    least = terms.groupBy(*keys).agg(*[F.min(rank(k)).alias(f"_{k}") for k in range(samples)])
    bits = [F.when(F.col(f"_{k}").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(f"_{k}").bitwiseAND(F.lit(0xFFFFFFFF))) for k in range(samples)]
    return least.select(*keys, F.array(*bits).alias("signature"))


def text_of(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a).cast("double")


def _next_blocks(rows: DataFrame, block_ids: int, group_blocks: int) -> DataFrame:
    """(top, target): the largest id of each block and the block above it, in a circle."""
    blocks = stored(rows.groupBy("block").agg(F.max("id").alias("top")).withColumn("group", F.floor(F.col("block") / group_blocks)), "blocks")
    # One row per group of blocks: a few of a billion ids.
    groups = blocks.groupBy("group").agg(F.min("block").alias("low"), F.max_by("top", "block").alias("top"))
    whole = Window.orderBy("group")
    far = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    across = groups.select("low", F.coalesce(F.lag("top").over(whole), F.last("top").over(far)).alias("before"))
    inside = blocks.withColumn("before", F.lag("top").over(Window.partitionBy("group").orderBy("block")))
    inside = inside.alias("i").join(across.alias("a"), F.col("i.block") == F.col("a.low"), "left")
    return stored(inside.select(F.coalesce("i.before", "a.before").alias("top"), F.col("i.block").alias("target")), "next")


def compare_neighbours(documents: DataFrame, samples: int = SAMPLES, block_ids: int = BLOCK_IDS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each document row.

    The next document has the next smaller doc_id (after the last comes the first); rows with equal ids follow each
    other by a hash of their text, missing ids come last. The edited text is the text with its last third (rounded down)
    replaced by as many first code points of the next one, or all it has. A null text is empty; a text without words
    has a fingerprint of zeros. A single document is its own next. No documents, no rows; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = (documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"), text.alias("text"))
            .withColumn("block", F.floor(F.col("id") / block_ids)).withColumn("extra", F.lit(0)))
    following = _next_blocks(rows, block_ids, group_blocks)
    extra = (rows.select("id", "text").join(following, F.col("id") == F.col("top"))
             .select("id", "text", F.col("target").alias("block"), F.lit(1).alias("extra")))
    order = Window.partitionBy("block").orderBy("extra", F.desc("id"), "hash", "text")
    placed = (rows.unionByName(extra).withColumn("hash", F.xxhash64("text"))
              .select("block", "extra", "id", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next")))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring(F.coalesce("next", F.lit("")), F.lit(1), third))
    placed = placed.select("block", "extra", "id", "place", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    placed = placed.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("said")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("said")))
    keys = ["block", "extra", "id", "place", "n_chars", "edited_sha256", "which"]
    each = placed.withColumn("_b", F.explode(both)).select(*keys[:-1], "_b.which", "_b.said").where("extra = 0 or which = 0")
    signed = fingerprints(each, keys, "said", samples)
    # Text, edited text, next text, ... of one block.
    line = Window.partitionBy("block").orderBy("place", "which")
    out = signed.select("*", F.lead("signature", 1).over(line).alias("edited"), F.lead("signature", 2).over(line).alias("next"))
    return out.where("extra = 0 and which = 0").select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", text_of(F.col("signature")).alias("fingerprint"),
        text_of(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("signature"), F.col("edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next")).alias("near_next"))


@query("op1_fingerprints")
def op1(spark, sf_dir):
    return compare_neighbours(table(spark, sf_dir, "documents"))
