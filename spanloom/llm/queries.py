"""Registered queries of the operators and, where SQL can express them, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import (
    codes,
    decontaminate,
    fmindex,
    jaccard,
    licences,
    manifest,
    mixing,
    neighbours,
    pages,
    quality,
    rlbwt,
    secret_scan,
    sharding,
)
from spanloom.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt.repeated_bytes(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.repeated_words(table(spark, sf_dir, "documents"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        (F.octet_length(body).cast("long") + sharding.ROW_BYTES).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    return sharding.shard_documents(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    drawn = (
        mixing.draw_mix(plan)
        .groupBy("__s", "__block", "__u", "__key", "__copy_of")
        .agg(F.sum("size").alias("taken"), F.array_sort(F.collect_list("shard")).alias("shards"))
    )
    rows = plan.select("__s", "__block", "__u", "__key", "__copy_of", "doc_id", "size", "source_size", "target")
    return rows.join(drawn, ["__s", "__block", "__u", "__key", "__copy_of"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives has lost its line feeds in every other document, by the CRC of the id."""
    text = F.col("text")
    damaged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    received = {"text": F.when(damaged, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)}
    found = manifest.merkle_manifest(table(spark, sf_dir, "documents"), received=received)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(F.flatten("proof"), ""), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.code_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_runs": op2_runs,
    "op3_decontaminate": op3_decontaminate,
    "op4_substrings": op4_substrings,
    "op5_jaccard": op5_jaccard,
    "op6_licences": op6_licences,
    "op7_sharding": op7_sharding,
    "op8_pages": op8_pages,
    "op9_neighbours": op9_neighbours,
    "op10_mixing": op10_mixing,
    "op11_manifest": op11_manifest,
    "op12_secrets": op12_secrets,
    "op13_codes": op13_codes,
}
