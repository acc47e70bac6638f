import base64
import hashlib
import zlib

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from assetloom.llm import blocks, bpe, queries, records

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_equals_library_on_all_documents(spark, sf_dir, reference):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op1_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(reference, texts[r.doc_id])


def test_bpe_odd_rows(odd_docs, no_docs, texts, reference):
    rows = bpe.round_trip(odd_docs, PATH, P.PATTERN, keep=["kept"]).collect()
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.kept) for r in rows)
    assert got == sorted((i or 0, *expected(reference, t), "a") for i, t in texts)
    assert bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(odd_docs, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r["bytes"])) for r in back) == sorted((i or 0, (t or "").encode()) for i, t in texts)


def test_replay_takes_the_lowest_rank_first():
    table = bpe.MergeTable(PATH)
    words = [b"banana", b"", b"aaaa", b"\xff\xfe", b"x"]
    flat, lengths = bpe.replay(words, table)
    assert lengths.tolist()[1] == 0 and b"".join(table.bytes[i] for i in flat) == b"".join(words)


def test_other_patterns_are_not_cut(spark, reference):  # noqa: F811
    glued = r"\S+\s*|\s+"  # white space belongs to the word before it
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("glued", pat_str=glued, mergeable_ranks=ranks, special_tokens={})
    texts = ["It is here.\nAnd there, too. x", "", "a\n\nb", "word. word, word"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(df, PATH, glued).collect()}
    assert got == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}
    assert blocks.may_be_cut(bpe.encoder(PATH, P.PATTERN)._split) and not blocks.may_be_cut(bpe.encoder(PATH, glued)._split)
    assert records.library_encoder(P.path("byte_bpe_50k.json"))._cut


def library(texts):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [e.ids + [2] for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_records_equal_library_on_all_documents(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect())
    start, want = 0, []
    for (i, _), ids in zip(docs, library([t for _, t in docs]), strict=True):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op10_records(spark, sf_dir).collect())) == want


def test_records_odd_rows_and_shuffled_reads(spark, odd_docs, no_docs, texts):
    manifest = records.write(odd_docs, P.path("byte_bpe_50k.json"))
    want = sorted(((i or 0), tuple(ids)) for (i, _), ids in zip(texts, library([t for _, t in texts]), strict=True))
    assert sorted((r.doc_id or 0, tuple(r.ids)) for r in records.shuffled(manifest, 5).collect()) == want
    rows = sorted((r.doc_id or -1, r.start, r.n_tokens) for r in records.summaries(manifest).collect())
    assert rows[0][:2] == (-1, 0) and [s for _, s, _ in rows] == [sum(n for *_, n in rows[:k]) for k in range(len(rows))]
    empty = records.write(no_docs, P.path("byte_bpe_50k.json"))
    assert records.summaries(empty).count() == 0


def test_added_tokens_in_texts_are_found_as_the_library_finds_them(spark):
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "a<|endoftext|><|endoftext|>b.", "no such token.", "<|endoftext| >", "It's <|endoftext|>.\nEnd, of it."]
    assert 50256 in library(texts)[0]
    manifest = records.write(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), P.path("byte_bpe_50k.json"))
    assert [list(r.ids) for r in sorted(records.shuffled(manifest, 1).collect(), key=lambda r: r.doc_id)] == library(texts)


def test_damage_is_seen():
    data = bytearray(records.frame(b"abcdefgh1234"))
    assert bytes(records.unframe(memoryview(data))[0]) == b"abcdefgh1234"
    data[14] ^= 1
    with pytest.raises(ValueError):
        records.unframe(memoryview(data))
