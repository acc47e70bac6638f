"""Hard negatives over the hyperplane tree against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetloom.llm import negatives as ng

SMALL = ng.Settings(max_sample=200, fanout=4, leaf_rows=20, group_bytes=1500, cells=100)


def brute(rows, every=50, scale=256):
    best = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        e = [math.floor(scale * float(np.float32(x))) for x in e]
        best[i] = min(best.get(i, (label, e)), (label, e))
    width = max((len(e) for _, e in best.values()), default=0)
    ids = sorted(best)
    x = np.array([best[i][1] + [0] * (width - len(best[i][1])) for i in ids], np.int64)
    out = []
    for a, i in enumerate(ids):
        if i % every:
            continue
        scores = (x @ x[a]).tolist()
        order = sorted((-s, j) for s, j in zip(scores, ids, strict=True) if j != i)
        for s, p in [o for o in order if best[o[1]][0] == best[i][0]][:5]:
            s = -s
            window = [(j, -t) for t, j in order if best[j][0] != best[i][0] and 50 * s <= -100 * t <= 95 * s][:3]
            out += [(i, p, r, j, s, t) for r, (j, t) in enumerate(window, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, n, "x") for i, e, n in rows], "vec_id bigint, embedding array<float>, label int, rank string")


def clustered(n=600, dims=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    x = centres[rng.integers(0, 9, n)] + 0.25 * rng.normal(size=(n, dims))
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, rng.integers(0, 3, n), strict=True))]


def test_equals_brute_force(spark):
    rows = clustered()
    found = ng.mine(frame(spark, rows), F.col("id") % 50 == 0, settings=SMALL)
    assert found.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    want = brute(rows)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100
    assert sorted(map(tuple, ng.mine(frame(spark, rows).repartition(5), F.col("id") % 50 == 0).collect())) == want  # one leaf


def test_odd_rows(spark):
    rows = clustered(120)
    zero, nan, inf = [0.0] * 12, float("nan"), float("inf")
    rows += [(200, zero, 1), (201, zero, 2), (202, [], 1), (250, [1.0, 2.0], 1), (251, [0.5], 2), (203, None, 1), (204, [nan] * 12, 1), (205, [inf] + zero[1:], 1), (206, [None] + zero[1:], 1), (207, zero, None), (None, zero, 1)]
    rows += [(300, rows[3][1], 1)] * 3 + [(300, rows[4][1], 0), (350, [-x for x in rows[5][1]], 2)]  # repeated ids
    rows += [(400 + i, rows[7][1], i % 2) for i in range(60)]  # one vector many times
    want = brute(rows)
    assert sorted(map(tuple, ng.mine(frame(spark, rows), F.col("id") % 50 == 0, settings=SMALL).collect())) == want
    assert any(r[0] == 400 for r in want) and any(r[4] == r[5] == 0 for r in want)
    assert ng.mine(frame(spark, rows).where("false"), F.col("id") % 50 == 0).collect() == []
    assert ng.mine(frame(spark, rows), F.lit(False)).collect() == []
    with pytest.raises(ValueError):
        ng.mine(frame(spark, [(0, [1e30, 1.0], 1)]), F.col("id") % 50 == 0)


def test_ranges_eliminate_and_lose_nothing(spark):
    rows = [r for r in clustered(900, 5, 4)]
    made = ng.build(ng.usable(frame(spark, rows), "vec_id", "embedding", F.col("label"), 256.0), SMALL)
    x = np.floor(256 * np.array([np.float32(r[1]) for r in rows]).astype(float))
    leaf = made.tree.leaf(x)
    assert made.tree.leaves > 20 and len(set(leaf.tolist())) > 20
    assert {(r.id, r.leaf) for r in made.rows.select("id", "leaf").collect()} == set(enumerate(leaf.tolist()))
    scores = (x @ x[:100].T).T.astype(np.int64)
    order = np.sort(scores, axis=1)
    for low, high in ((order[:, -20], order[:, -1]), (order[:, -60], order[:, -40])):  # a ball, an annulus
        asked = ng.Queries(np.arange(100), np.zeros(100), x[:100], leaf[:100], low[:, None], high[:, None], True)
        reach, reached = ng.Reach(made.tree, asked), 0
        for i in range(made.tree.leaves):
            live = set(reach.leaf(i).tolist())
            reached += len(live)
            inside = (scores[:, leaf == i] >= low[:, None]) & (scores[:, leaf == i] <= high[:, None])
            assert set(np.flatnonzero(inside.any(axis=1)).tolist()) <= live
        assert reached < 0.6 * 100 * made.tree.leaves
