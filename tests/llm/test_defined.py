"""Cases that every operator defines: clashing names, other id types, results read back from files."""

import time

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from assetloom.llm import blocks, bpe, chat, decontaminate, licences, quality_model, quality_rules, secrets

PATH = P.path("byte_bpe_multi_50k.tiktoken")
FLAT = licences.Model([*licences.TEMPLATES, "none"], __import__("numpy").zeros((17, len(licences.TEMPLATES) + 1)), 1.0, 0.9)
CLASHING = {
    "bpe": lambda d: bpe.round_trip(d, PATH, P.PATTERN, keep=["n_tokens"]),
    "ids": lambda d: bpe.round_trip(d.withColumnRenamed("kept", "ids"), PATH, P.PATTERN, keep=["ids"], with_ids=True),
    "rules": lambda d: quality_rules.apply_rules(d, keep=["kept"]),
    "score": lambda d: quality_model.score(d.withColumnRenamed("kept", "SCORE"), quality_model.train(d, d.select("doc_id", F.lit(1).alias("quality"))), keep=["SCORE"]),
    "licences": lambda d: licences.scan(d, FLAT, keep=["spans"]),
    "decontaminate": lambda d: decontaminate.scan(d, d.select(F.col("doc_id").alias("item_id"), "text"), keep=["spans"]),
    "secrets": lambda d: secrets.scan(d, keep=["spans"]),
    "redacted": lambda d: secrets.scan(d.withColumnRenamed("kept", "redacted"), keep=["redacted"], redact=True),
    "id": lambda d: secrets.scan(d, keep=["doc_id"]),
}


@pytest.mark.parametrize("name", sorted(CLASHING))
def test_kept_columns_may_not_clash(odd_docs, name):
    with pytest.raises(ValueError, match="rename"):
        CLASHING[name](odd_docs)


def test_chat_takes_other_ids_and_reads_files_back(spark, tmp_path):
    rows = [(i + 0.5, k, "assistant", f"{i} {k} " * 30) for i in range(4) for k in range(9)]
    turns = spark.createDataFrame(rows, "conv_id double, turn int, role string, text string")
    formatted = chat.format_turns(turns, part_chars=100)
    want = sorted(map(tuple, chat.summarise(formatted, in_order=True).collect()))
    formatted.repartition(5).write.parquet(str(tmp_path / "formatted"))
    back = spark.read.parquet(str(tmp_path / "formatted"))
    assert sorted(map(tuple, chat.summarise(back).collect())) == want and len(want) == 4
    with pytest.raises(Exception, match="should follow"):
        chat.summarise(back.repartition(3), in_order=True).collect()


def test_constants_that_double_take_linear_time():
    lines = ['a0 = "Zx81kQ0vLm77TrQ"'] + [f"a{i + 1} = a{i} + a{i}" for i in range(3000)] + ["db_password_key = a3000"]
    text, began = "\n".join(lines), time.process_time()
    found = [text[a:b] for k, a, b in secrets.spans(text)]
    assert found == ["Zx81kQ0vLm77TrQ"] and time.process_time() - began < 20


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        blocks.shared_folder(Session(), "x")
