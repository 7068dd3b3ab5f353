"""The training-data pipeline over ``documents``; each stage calls one operator of lakemart.llm.

``run`` writes each stage's result in the shared folder and reads it again as the next one's input,
so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, jaccard, mixing, pii, quality
from lakemart.llm.common import table, written
from lakemart.llm.queries import WORD


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the isolation forest keep."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word shingles at 80 %."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with confirmed personal data replaced by its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return mixing.mix(docs, size)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    encode = bpe.encoder(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return docs.withColumn("tokens", encode("text")).withColumn("n_tokens", F.size("tokens"))


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]
ORACLE_SQL = None  # forest, components, rounding and merges are beyond SQL; tests hold brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
