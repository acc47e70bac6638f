"""Ranked search by shared sums against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from assetloom.llm import lexical
from assetloom.llm.best import Best


def terms(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "word1 and3 WORD1 word1 word2"), (2, "word1 and3 word1, word1 word2 one"), (3, None), (4, ""), (5, "日本語テキスト ñandú and3"), (6, "nothing-of-this zzz"), (7, "It's here a b"), (7, "x y z x"), (None, "one"), (8, "one id here"), (8, "one id here")]


def test_search_equals_brute_force(spark, odd_docs, no_docs, texts, monkeypatch):
    items = spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id bigint, text string, score string")
    want = brute(texts, list(dict.fromkeys(ITEMS)))
    assert len(want) > 10
    assert sorted(map(tuple, lexical.search(odd_docs, items).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "GROUP_BYTES", 60)  # several groups
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 1)  # a document a block
    assert sorted(map(tuple, lexical.search(odd_docs.where("doc_id <> 8 or doc_id is null"), items, k=2).collect()), key=repr) == brute([d for d in texts if d[0] != 8], list(dict.fromkeys(ITEMS)), 2)
    assert lexical.search(no_docs, items).count() == 0 and lexical.search(odd_docs, items.where("false")).count() == 0


def test_ties_go_by_id_across_tasks(spark):
    docs = [(i, "same words here") for i in range(40)] + [(100 + i, f"other {i}") for i in range(40)]
    items = [(1, "same here"), (2, "other")]
    found = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(9), spark.createDataFrame(items, "item_id bigint, text string"))
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(brute(docs, items)) and [r[2] for r in rows if r[0] == 1] == list(range(10))


def test_shared_sums_are_the_sums_and_save_additions():
    rng = random.Random(3)
    common = [rng.sample(range(60), 6) for _ in range(5)]
    bags = [Counter([*rng.choice(common), *rng.choice(common), *rng.sample(range(60), 3)]) for _ in range(80)] + [Counter()]
    plan = lexical.share(bags, 60)
    values = np.random.default_rng(1).integers(0, 10**9, (60, 7))
    want = np.array([sum((m * values[t] for t, m in bag.items()), np.zeros(7, np.int64)) for bag in bags])
    assert (lexical.evaluate(plan, values) == want).all()
    additions = sum(map(len, plan.levels)) + sum(max(0, len(i) - 1) for i in plan.items)
    assert additions < 0.7 * sum(max(0, len(b) - 1) for b in bags) and len(plan.levels) > 2


@pytest.mark.parametrize("pending", [1, 10**6])
def test_best_keeps_the_first_of_each_list(pending):
    rng = np.random.default_rng(5)
    best, rows = Best(6, 3, pending), []
    for _ in range(30):
        part = rng.integers(0, 5, 40), rng.integers(-4, 4, 40), rng.integers(0, 1000, 40)
        rows += zip(*(p.tolist() for p in part), strict=True)
        best.add(*part)
    got = list(zip(*(c.tolist() for c in best.rows()), strict=True))
    assert got == [r for w in range(6) for r in sorted((r for r in rows if r[0] == w), key=lambda r: (-r[1], r[2]))[:3]]
