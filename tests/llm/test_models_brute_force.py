"""The trained classifiers recomputed one number at a time."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from assetloom.llm import licences, quality_model, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def mixed(x, salt):
    x = (x + salt) * 0x9E3779B97F4A7C15 & MASK
    x ^= x >> 29
    x = x * 0xBF58476D1CE4E5B9 & MASK
    return x ^ (x >> 32)


def indicators(text, buckets):
    words = WORD.findall(text or "")
    steps = [quality_model.shape(w) * 2 + (i > 0 and w == words[i - 1]) for i, w in enumerate(words)]
    found = {mixed(zlib.crc32(w.lower().encode()), 7) % buckets for w in words}
    for n in (1, 2, 3):
        grams = [sum(s << (7 * k) for k, s in enumerate(steps[i : i + n])) for i in range(len(steps) - n + 1)]
        for g in set(grams):
            share = max(-9, math.floor(math.log2(grams.count(g) / len(words))))
            found.add(mixed(g * 32 - share, n) % buckets)
    return sorted(found)


def naive_bayes_machine(rows, labels, s):
    """Log-count ratios, dual coordinate descent and the logistic curve on plain dictionaries."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(rows)).tolist()
    cut = len(rows) // 5
    left_out, used = order[:cut], order[cut:]
    counts = [{}, {}]
    for i in used:
        for f in rows[i]:
            counts[labels[i]][f] = counts[labels[i]].get(f, 0) + 1
    sums = [s.alpha * s.buckets + sum(c.values()) for c in counts]
    ratio = lambda f: math.log((s.alpha + counts[1].get(f, 0)) / sums[1]) - math.log((s.alpha + counts[0].get(f, 0)) / sums[0])
    share = max(1e-6, sum(labels[i] for i in used) / len(used))
    scaled = {}
    for i in order:
        own = {f: ratio(f) for f in rows[i]}
        norm = max(1.0, math.sqrt(sum(v * v for v in own.values())))
        scaled[i] = {f: v / norm for f, v in own.items()}
    w, bias, dual = {}, 0.0, [0.0] * len(rows)
    for _ in range(s.epochs):
        for i in rng.permutation(used).tolist():
            y, x = (1 if labels[i] else -1), scaled[i]
            gradient = y * (sum(w.get(f, 0.0) * v for f, v in x.items()) + bias) - 1
            bound = s.cost * 0.5 / (share if labels[i] else max(1e-6, 1 - share))
            new = min(max(dual[i] - gradient / (sum(v * v for v in x.values()) + 1), 0.0), bound)
            for f, v in x.items():
                w[f] = w.get(f, 0.0) + (new - dual[i]) * y * v
            bias += (new - dual[i]) * y
            dual[i] = new
    held = left_out if len(left_out) >= 20 else order
    margins = [sum(w.get(f, 0.0) * v for f, v in scaled[i].items()) + bias for i in held]
    good = sum(labels[i] for i in held)
    target = [(good + 1) / (good + 2) if labels[i] else 1 / (len(held) - good + 2) for i in held]
    a, b = 1.0, 0.0
    for _ in range(50):
        p = [1 / (1 + math.exp(-min(30, max(-30, a * m + b)))) for m in margins]
        v = [max(q * (1 - q), 1e-6) for q in p]
        g0, g1 = sum((q - t) * m for q, t, m in zip(p, target, margins, strict=True)) + 1e-3 * (a - 1), sum(q - t for q, t in zip(p, target, strict=True))
        h00, h01, h11 = sum(x * m * m for x, m in zip(v, margins, strict=True)) + 1e-3, sum(x * m for x, m in zip(v, margins, strict=True)), sum(v) + 1e-3
        det = h00 * h11 - h01 * h01
        a, b = a - (h11 * g0 - h01 * g1) / det, b - (h00 * g1 - h01 * g0) / det
    a = max(a, 1e-3)

    def score(text):
        own = {f: ratio(f) for f in indicators(text, s.buckets)}
        norm = max(1.0, math.sqrt(sum(v * v for v in own.values())))
        margin = sum(w.get(f, 0.0) * v for f, v in own.items()) / norm + bias
        return 1 / (1 + math.exp(-min(30, max(-30, a * margin + b))))

    return score


def test_quality_model_equals_brute_force(spark):
    rng = random.Random(8)
    texts = {}
    for i in range(160):
        good = i % 3 > 0
        words = [rng.choice(("the", "and", "river", "Stone", "walks", "quiet,", "far.")) if good or rng.random() < 0.5 else rng.choice(("BUY", "$$$", "now!!!", "0x1f", "click")) for _ in range(rng.randrange(1, 40))]
        texts[i] = " ".join(words)
    labels = {i: int(i % 3 > 0) for i in texts}
    s = quality_model.Settings(buckets=1 << 12, epochs=6)
    docs = spark.createDataFrame(list(texts.items()) + [(900, None), (901, ""), (902, "Never seen WORDS here")], "doc_id bigint, text string")
    model = quality_model.train(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int"), s)
    got = {r.doc_id: r.score for r in quality_model.score(docs, model, s).collect()}
    rows = [indicators(texts[i], s.buckets) for i in sorted(texts)]
    flat, at = quality_model.features(pa.array([texts[i] for i in sorted(texts)]), s)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == rows
    score = naive_bayes_machine(rows, [labels[i] for i in sorted(texts)], s)
    for i, text in [*texts.items(), (900, None), (901, ""), (902, "Never seen WORDS here")]:
        assert got[i] == pytest.approx(score(text), abs=2e-3), (i, text)


def test_licence_scan_equals_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    extra = [(10**7, "x. Permission is hereby granted, free of charge, to any person obtaining a copy of this software. " + "and more words " * 40), (10**7 + 1, None), (10**7 + 2, "Licensed under the Banana License, Version 2.0, for this work")]
    model = licences.train(docs)
    s, buckets = licences.Settings(), len(model.weights) - 1
    import xxhash

    def hashed(word):
        return xxhash.xxh3_64_intdigest((re.sub(r"^[^0-9a-z]+|[^0-9a-z]+$", "", word.lower()) or ".").encode())

    def families(text):
        """(start, end, family) of each window that is taken for a notice."""
        out, at = [], 0
        for line in (text or "").replace(". ", ".\n").split("\n"):
            words = list(WORD.finditer(line))
            n = len(words)
            firsts = [0] if 0 < n <= s.window else range(0, max(0, n - s.window // 2), s.window // 2)
            for first in firsts:
                own = words[first : first + s.window]
                h = [hashed(m[0]) for m in own]
                z = model.weights[-1].astype(float)
                total = sum(model.weights[x % buckets].astype(float) for x in h)
                for a, b in zip(h, h[1:], strict=False):
                    pair = (a * 0x9E3779B97F4A7C15 & MASK) ^ ((b + 0x632BE59BD9B4E019) & MASK)
                    total = total + model.weights[(pair >> 17) % buckets].astype(float)
                z = z + total / math.sqrt(max(1, 2 * len(own) - 1))
                p = np.exp(z / model.temperature - (z / model.temperature).max())
                p /= p.sum()
                if p[-1] >= 0.5:
                    continue
                start, end = at + own[0].start(), at + own[-1].end()
                piece, k = text.replace(". ", ".\n")[start:end], int(np.argmax(p[:-1]))

                def like(f, piece=piece):
                    plain = [re.sub(r"^[^0-9a-z]+|[^0-9a-z]+$", "", w.lower()) or "." for w in piece.split()]
                    mine = set(zip(plain, plain[1:], strict=False)) or {(w, "") for w in plain}
                    return max(len(mine & licences._grams(t)) / min(len(licences._grams(t)), max(len(mine), 4)) for t in licences.TEMPLATES[f])

                if p[k] >= model.bound and like(model.families[k]) >= s.likeness:
                    out.append((start, end, model.families[k]))
                elif max(map(like, licences.TEMPLATES)) >= s.trace:
                    out.append((start, end, "unknown"))
            at += len(line) + 1
        return out

    small = docs.select("doc_id", "text").orderBy("doc_id").limit(150).unionAll(spark.createDataFrame(extra, "doc_id bigint, text string"))
    texts = {r.doc_id: r.text for r in small.collect()}
    for r in licences.scan(small, model).collect():
        want = families(texts[r.doc_id])
        assert r.families == ",".join(sorted({f for *_, f in want} - {"unknown"})), r
        covered = lambda spans: {i for a, b, *_ in spans for i in range(a, b)}
        got = [tuple(map(int, x.rsplit(":", 2)[1:])) for x in filter(None, r.spans.split(","))]
        assert covered(got) == covered(want), r
