"""A training corpus from ``documents``: five stages, each written and read again.

``STAGES`` lists (name, function); each function takes (spark, docs,
sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import common, language_id, line_dedup, mixing, near_dedup, packing, queries

#: A text that no language's classifier scores this high is in none of them.
LEAST_SCORE = 0.2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learnt languages; texts without letters go."""
    common.prepare(spark)
    model = language_id.train(docs.where(~queries.held_out()))
    judged = language_id.identify(docs, model)
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE))
    return kept.select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks of earlier ones; n_chars follows the
    text, and documents of which nothing is left go."""
    common.prepare(spark)
    out = line_dedup.line_dedup(docs)
    out = out.where((F.size("_gone") == 0) | (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != ""))
    changed = F.when(F.size("_gone") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    common.prepare(spark)
    return near_dedup.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    common.prepare(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of at most 4,096 tokens."""
    common.prepare(spark)
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("language ID", known_language),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("source mixing", mixed),
    ("best-fit packing", packed),
]

#: SQL can express neither the models and hashes of the stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder."""
    common.prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = common.held(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
