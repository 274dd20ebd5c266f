"""The corpus pipeline: stages over ``documents``, each on all that its predecessor kept.

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows
the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import bpe, line_dedup, mixing, near_dups, quality
from offerloom.llm.storage import bounded_batches, work_path


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and so do lines above their host's limit."""
    return _counted(quality.clean(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in the last of them only."""
    return _counted(line_dedup.dedup_lines(docs).select(*docs.columns))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    bounded_batches(spark)
    return near_dups.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; not at all, once or twice."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole text, and whether they decode to it."""
    import public_tokenizers

    bounded_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return both.select("doc_id", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens", exact.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near-dedup", near_dup_stage),
    ("source mixing", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

#: SQL can't express BagMinHash classes or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = work_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
