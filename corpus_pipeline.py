"""From raw documents to token ids: quality rules, language, near duplicates,
benchmark leaks, encoding.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of the
documents. They are judged by their texts and languages; where rows share a key, the
stages' modules say what holds.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, decontaminate, language_id, near_dedup, quality_rules
from starloom.llm.queries import ranks
from starloom.llm.stage import Tables, ship, short_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a risk-controlled cutoff go."""
    ship(spark)
    short_batches(spark)
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the model knows with some certainty go."""
    ship(spark)
    short_batches(spark)
    return language_id.keep_identified(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least key of each group of near duplicates stays (five words, 0.8)."""
    return near_dedup.keep_one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other values, go."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and whether they decode to the text."""
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks(),
                            public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        same.alias("decodes"),
    )


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("decontamination", leaks),
    ("byte-level BPE", encode),
]

#: Trained models and tokens have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = Tables(spark)
    before = None
    for name, stage in STAGES:
        docs = tables.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            tables.drop(before)
        before = docs
    return docs
