"""Registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import short_batches
from . import bpe, chat, decontaminate, exact_dedup, lexical, licences, lm, near_dedup, negatives, oracles, quality_model, quality_rules, records, secrets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the session; batches to Python are kept short, since texts are long."""
    short_batches(spark, 4000, 16_000_000)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    # a table of rows by turn and a record of a nested layout, each by the mapping that its schema's fingerprint names
    record = spark.createDataFrame([(-1, [("user", probe), ("assistant", probe)])], "conv_id bigint, messages array<struct<role string, content string>>")
    turns = chat.turns_from_rows(table(spark, sf_dir, "conversations")).unionByName(chat.turns_from_records(record, "conv_id"))
    return chat.summarise(chat.format_turns(turns), in_order=True)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), usable=quality_model.remainder("doc_id") != 0)
    held_out = quality_model.remainder("doc_id") == 0
    return quality_model.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality_model.remainder("doc_id") == 1
    scored = lm.score(table(spark, sf_dir, "documents"), quality_model.remainder("doc_id") != 1)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return records.summaries(manifest)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_chat, op3_near_dedup, op4_decontaminate, op5_quality_rules, op6_quality_model, op7_licences, op8_lm, op9_secrets, op10_records, op11_hard_negatives, op12_exact_dedup, op13_ranked_search)}
ORACLE: dict[str, str] = {"op2_chat": oracles.OP2, "op3_near_dedup": oracles.OP3, "op4_decontaminate": oracles.OP4, "op5_quality_rules": oracles.OP5, "op11_hard_negatives": oracles.OP11, "op12_exact_dedup": oracles.OP12, "op13_ranked_search": oracles.OP13}
