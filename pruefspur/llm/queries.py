"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids,
    chat,
    decontaminate,
    importance,
    jaccard,
    langid,
    licenses,
    linededup,
    mixing,
    neardup,
    quality,
    secret_scan,
    tokens,
)
from .frames import sha256_hex, table
from .oracles import ORACLES  # noqa: F401 - registered beside the queries

#: The conversation that is added to the table, and its text.
ADDED, ADDED_TEXT = -7, "</s>[INST] ok [/INST]"


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three of four parts of the labelled documents, predicted for all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = langid.fit(docs.filter(remainder != 2))
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    judged = langid.predict(docs.select("doc_id", held_out, "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label(table(spark, sf_dir, "documents"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the conversations, read back from the formatted examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(ADDED).cast("bigint").alias("conv_id"),
                        F.lit(i).cast("bigint").alias("turn"),
                        F.lit(role).alias("role"),
                        F.lit(ADDED_TEXT).alias("text"),
                    )
                    for i, role in enumerate(("user", "assistant"))
                ]
            )
        )
    )
    examples = chat.format_examples(turns.unionByName(added))
    loss = chat.loss_text(F.col("formatted"), F.col("mask_start"), F.col("mask_chars"))
    per = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("example", loss.alias("t")))), lambda x: x["t"]), ""
        ).alias("loss"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    read = per.withColumn("turns", chat.read_turns(F.col("longest")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        sha256_hex(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        sha256_hex(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "mix_slot", "mix_position")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger under the base policy and the current one."""
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    base_failed = ~quality.passes(quality.BASE)
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality.passes(quality.CURRENT)).alias("kept"),
        "failures",
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal lines of every length are one class."""
    return linededup.report(table(spark, sf_dir, "documents"), least_equal=0)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count(table(spark, sf_dir, "documents"))
    return counted.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id,
    "op2_line_dedup": line_dedup,
    "op3_license_scan": license_scan,
    "op4_chat_format": chat_format,
    "op5_decontamination": decontamination,
    "op6_source_mixing": source_mixing,
    "op7_quality_rules": quality_rules,
    "op8_secret_scan": secrets,
    "op9_near_duplicates": near_duplicates,
    "op10_token_counts": token_counts,
    "op11_jaccard_join": jaccard_join,
    "op12_importance_resampling": importance_resampling,
    "op13_centroid_clustering": centroid_clustering,
}
