"""The queries of the operators, and their equivalents in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eclusa.llm import (
    bpe,
    counts,
    decontaminate,
    fim,
    licences,
    merkle,
    neardup,
    pii,
    quality,
    rules,
    sharding,
    topk,
    toxicity,
)
from eclusa.llm.frames import held_out, id_and_text, table

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_and_text(table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, score: str, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= threshold).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    net = toxicity.fit(rows, table(spark, sf_dir, "labels"))
    return _judged(*toxicity.scored(rows, net), toxicity.THRESHOLD)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    model = quality.fit(rows, table(spark, sf_dir, "labels"))
    return _judged(*quality.scored(rows, model), quality.THRESHOLD)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.members(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt, _ = sharding.shard(documents(spark, sf_dir), 40)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), topk.integers(F.col("embedding")).alias("vector")
    )
    return topk.search(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return counts.count(documents(spark, sf_dir), model).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit")
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rules.scan(documents(spark, sf_dir)).select(
        "doc_id", *(F.col("measures")[m].alias(m) for m in base), "base_failed", "kept", "quality"
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transformed(documents(spark, sf_dir))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality": op3_quality,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontaminate": op5_decontaminate,
    "op6_shard": op6_shard,
    "op7_topk": op7_topk,
    "op8_token_counts": op8_token_counts,
    "op9_licences": op9_licences,
    "op10_personal_data": op10_personal_data,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE: dict[str, str] = {
    "op9_licences": licences.oracle(),
    "op11_merkle_manifest": merkle.oracle(),
}
