"""A training corpus from raw documents, in five stages that each write a table for the next one.

The quality classifier drops documents it scores below its bound, near-duplicate groups keep one document,
contaminated documents go, secrets are masked in the texts, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetloom.llm import bpe, decontaminate, near_dedup, quality_model, secrets
from assetloom.llm.blocks import shared_folder, short_batches

#: A document of a lower score is dropped.
MIN_QUALITY = 0.3


def _other(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "doc_id"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality; the classifier learns from labels whose id's crc32 isn't divisible by 5.

    Null and empty texts get the score of a text without words, and go or stay by it; repeated rows alike.
    """
    short_batches(spark, 1000, 4_000_000)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.train(docs, labels, usable=quality_model.remainder("doc_id") != 0)
    clear = {c: f"own_{i}" for i, c in enumerate(_other(docs))}
    scored = quality_model.score(docs.select("doc_id", *[F.col(c).alias(n) for c, n in clear.items()]), model, text_col=clear["text"], keep=list(clear.values()))
    return scored.where(F.col("score") >= MIN_QUALITY).select("doc_id", *[F.col(n).alias(c) for c, n in clear.items()]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity of 0.8 or more), that of the smallest id.

    Null ids, null and empty texts, and other texts of a repeated id stay.
    """
    short_batches(spark, 1000, 4_000_000)
    return near_dedup.deduplicate(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; null and empty texts have none, long ones are scanned whole."""
    short_batches(spark, 1000, 4_000_000)
    clear = {c: f"own_{i}" for i, c in enumerate(_other(docs))}
    found = decontaminate.scan(docs.select("doc_id", *[F.col(c).alias(n) for c, n in clear.items()]), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text_col=clear["text"], keep=list(clear.values()))
    return found.where("n_hit = 0").select("doc_id", *[F.col(n).alias(c) for c, n in clear.items()]).select(*docs.columns)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; n_chars, if there is one, follows the text where it changed. Null texts stay null."""
    short_batches(spark, 1000, 4_000_000)
    clear = {c: f"own_{i}" for i, c in enumerate(_other(docs))}
    found = secrets.scan(docs.select("doc_id", *[F.col(c).alias(n) for c, n in clear.items()]), text_col=clear["text"], keep=[n for c, n in clear.items() if c != "text"], redact=True)
    hit = F.col("spans") != ""
    columns = {"doc_id": F.col("doc_id"), "text": F.col("redacted"), **{c: F.col(n) for c, n in clear.items() if c != "text"}}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(hit, F.length("redacted").cast("bigint")).otherwise(columns["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their digest, and that of the text decoded from them; null and empty texts have no ids."""
    short_batches(spark, 1000, 4_000_000)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=[c for c in ("lang", "source") if c in docs.columns], with_ids=True)


STAGES = [
    ("quality_model", quality),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontamination),
    ("secrets", secret_masking),
    ("bpe", encoding),
]

#: No SQL: a trained classifier and byte-pair merges are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet below the shared folder and read again.

    Texts may be null, empty or very long, rows and ids may repeat, the table may be empty, and it may lack every
    column but doc_id and text; other columns are carried along until the last stage, whatever their names.
    """
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}_{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}_{name}")
    return docs
