"""Corpus pipeline: toxic documents go, near-duplicates go, benchmark passages and personal
data are cut out or masked, and what is left is encoded.

Every stage works on all that its predecessor kept; the result of each is written to the
session's shared folder and read from there by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eclusa.llm import bpe, decontaminate, neardup, pii, toxicity
from eclusa.llm.frames import staged, table


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars`` as their texts now are; a null text keeps its count."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return docs.withColumn("n_chars", n).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark")))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.masked(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and their number instead of the text; ``intact`` if they decode to it."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    rows = docs.select(*kept, "text", digest.alias("digest"))
    return bpe.round_trip(rows, ranks, public_tokenizers.PATTERN).select(
        *kept,
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("intact"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", cut_benchmark),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode),
]
# Training a network and expectation-maximisation have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
