import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetloom.llm import lm, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def base(rows, trained):
    counts = Counter(t for i, text in rows if trained(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        out.append((i or 0, len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)))
    return sorted(out)


def compare(got, want):
    assert len(got) == len(want)
    for (i, n, known, total, score, _), w in zip(sorted(got), want, strict=True):
        assert (i, n, known, total) == w[:4] and score == pytest.approx(w[4], rel=1e-9, abs=1e-9)


def plain(rows):
    return [(r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows]


def test_query_base_equals_brute_force_and_model_beats_it(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    got = queries.op8_lm(spark, sf_dir).collect()
    compare(plain(got), base(rows, lambda i: zlib.crc32(str(i).encode()) % 5 != 1))
    held = [r for r in got if r.held_out]
    assert all(r.score < 0 for r in got)
    ours, plain_score, n = sum(r.score for r in held), sum(r.base_score for r in held), sum(r.n_tokens for r in held)
    print("\nlog10 a token", ours / n, plain_score / n)
    assert ours / n > plain_score / n + 0.05


def test_odd_rows_and_a_short_head(spark, odd_docs, no_docs, texts):
    for head in (4, 400_000):
        got = lm.score(odd_docs, F.coalesce(F.col("doc_id"), F.lit(0)) > 4, lm.Settings(head=head, rounds=2), keep=["kept"]).collect()
        compare(plain(got), base(texts, lambda i: (i or 0) > 4))
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(no_docs, F.lit(True)).count() == 0
    untrained = lm.score(odd_docs, F.lit(False), lm.Settings(rounds=1)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 for r in untrained)


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, " ".join("abcdefgh"[(i * k) % 8] for k in range(1, 30)) + f" rare{i} twice{i % 20}") for i in range(40)] + [(50, None), (51, "A b unseen")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    s = lm.Settings(branch=4, occupancy=4, contexts=16, head=40, rounds=3, class_rows=64, node_rows=64)
    vocab = lm.vocabulary(lm.token_counts(df.where("doc_id < 50"), s), s)
    return rows, df, s, vocab


def numbered(df, vocab, s):
    rows = df.select("doc_id", "text", F.lit(True).alias("used"))
    names = ["leaves", "id", "row", "n", "known", "base_sum", "inner", "tail", "used"]
    return rows.mapInArrow(lm._numbering(df.sparkSession.sparkContext.broadcast(vocab), s, names), "leaves binary, id bigint, row bigint, n bigint, known bigint, base_sum double, inner double, tail array<struct<h:bigint,k:int>>, used boolean")


def test_probabilities_of_all_leaves_sum_to_one(small):
    _, df, s, vocab = small
    w = lm.train(numbered(df.where("doc_id < 50"), vocab, s), vocab, s)
    assert vocab.depth >= 2 and all(np.abs(x).max() > 0 for x in w.levels)
    model = lm.Model(vocab, w, s)
    every = np.arange(vocab.leaves, dtype=np.int32)
    for first, second in ((vocab.end, vocab.end), (3, 7), (int(vocab.leaf[0]), vocab.end)):
        logs = model.logs(every, np.full(len(every), first, np.int32), np.full(len(every), second, np.int32))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_leaves_hold_all_tokens_once(small):
    rows, _, _, vocab = small
    counts = Counter(t for i, text in rows if i < 50 for t in tokens(text))
    hashed = {t: 1 if t is None else int(lm.hashes([t])[0]) for t in counts}
    own = dict(zip(vocab.h[vocab.own].tolist(), vocab.leaf[vocab.own].tolist(), strict=True))
    assert len(set(own.values())) == len(own) and hashed[None] in own
    mass = np.zeros(vocab.leaves)
    for t, c in counts.items():
        h = hashed[t]
        mass[own[h] if h in own else vocab.hashed_leaf(np.array([h]))[0]] += c + 0.5
    for h, leaf in own.items():
        assert vocab.mass[leaf] == mass[leaf]
    extra = vocab.mass - mass
    assert set(np.round(extra[vocab.mass > 0], 6).tolist()) <= {0.0, 0.5}  # half a count for the unseen in each shared leaf


def test_score_equals_brute_force(small):
    """Every factor of every token's probability, one at a time."""
    rows, df, s, vocab = small
    train = F.col("doc_id") < 50
    w = lm.train(numbered(df.where(train), vocab, s), vocab, s)
    got = {r.doc_id: r for r in lm.score(df, train, s).collect()}
    counts = Counter(t for i, text in rows if i < 50 for t in tokens(text))
    leaf_of = dict(zip(vocab.h.tolist(), zip(vocab.leaf.tolist(), vocab.own.tolist(), strict=True), strict=True))
    model = lm.Model(vocab, w, s)
    shared = Counter()
    hashed = {t: 1 if t is None else int(lm.hashes([t])[0]) for t in {t for _, text in rows for t in tokens(text)}}

    def place(t):
        h = hashed[t]
        leaf, own = leaf_of.get(h, (None, False))
        return (leaf, True) if own else (int(vocab.hashed_leaf(np.array([h]))[0]), False)

    seen = Counter()
    for t, c in counts.items():
        leaf, own = place(t)
        if not own:
            shared[leaf] += c
            seen[leaf] += 1
    for i, text in rows:
        total, first, second = 0.0, vocab.end, vocab.end
        for t in tokens(text):
            leaf, own = place(t)
            b1, b2 = int(model._context[first]), int(model._context[second])
            for level in range(vocab.depth):
                node, child = leaf // 4 ** (vocab.depth - level), leaf // 4 ** (vocab.depth - level - 1) % 4
                if level == 0:
                    x = vocab.bias[0][0] + sum(w.levels[0][int(lm._mix(np.array([k]), salt, 64)[0])] for k, salt in ((b1, 1), (b2, 2), (b1 * 16 + b2, 3)))
                else:
                    start, n = vocab.buckets(64)[level - 1]
                    x = vocab.bias[level][node] + w.levels[level][start[node] + int(lm._mix(np.array([first]), 4, 1 << 30)[0]) % n[node]]
                total += x[child] - math.log(sum(math.exp(v) for v in x))
            if not own:
                total += math.log((counts[t] + 0.5) / (shared[leaf] + 0.5 * (seen[leaf] + 1)))
            first, second = leaf, first
        assert got[i].score == pytest.approx(total / math.log(10), rel=1e-3)


def test_kept_columns_may_not_clash(odd_docs):
    with pytest.raises(ValueError):
        lm.score(odd_docs, F.lit(True), keep=["n_tokens"])
