"""The corpus pipeline: toxic documents out, one document of each near-duplicate group, benchmark passages out, personal
data masked, sources mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents`` (the last adds ``copy`` and
``shuffle_key``); ``run`` writes each result below the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import op2_pii, op3_ngram_jaccard, op4_decontaminate, op6_toxicity, op9_mix_sources
from changeloom.llm.registry import table
from changeloom.llm.stored import stored

# Documents in an Arrow batch. Every stage hands whole texts to tasks, where a batch lies in memory twice.
ARROW_ROWS = 1_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT_FROM = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under REJECT_FROM; the model is trained on the labelled ones among ``docs``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    model = op6_toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = op6_toxicity.score_toxicity(docs, model, COLUMNS)
    # A text without words has nothing toxic in it.
    wordless = F.coalesce(F.length(F.trim("text")) == 0, F.lit(True))
    return scored.where((F.col("score") < REJECT_FROM) | wordless).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, the one with the smallest id."""
    return op3_ngram_jaccard.one_of_each_group(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return op4_decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars follows the text where it was known."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return op2_pii.mask_pii(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by their source's target weight, shuffled."""
    return op9_mix_sources.mix_sources(docs.select(*COLUMNS))


STAGES = [("toxicity", toxicity), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal data", personal_data), ("mixing", mixing)]
#: The classifier has no SQL form; tests/llm/test_pipeline.py compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
