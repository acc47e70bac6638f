"""Counting quotient filters, and exact duplicates against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assetloom.llm import exact_dedup as ed


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**40 - 1), max_size=60), min_size=1, max_size=5), st.integers(0, 24))
def test_filters_merge_losslessly(parts, drop):
    bits = 40 - drop
    made, want = [], Counter()
    for part in parts:
        part = [x % 2**bits for x in part]
        want.update(part)
        low, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        made.append(ed.encode_filter(low, counts, bits))
    low, counts, kept = ed.decode_filter(ed.merge_filters(made))
    assert kept == bits and dict(zip(low.tolist(), counts.tolist(), strict=True)) == want and low.tolist() == sorted(want)


def test_filter_of_whole_fingerprints():
    low = np.array([0, 5, 2**63, 2**64 - 1], np.uint64)
    for values in (low, low[:1], low[:0]):
        again, counts, bits = ed.decode_filter(ed.encode_filter(values, np.arange(1, len(values) + 1), 64))
        assert bits == 64 and again.tolist() == values.tolist() and counts.tolist() == list(range(1, len(values) + 1))


def brute(rows):
    groups = defaultdict(list)
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), t in zip(rows, normal, strict=True):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, normal, strict=True):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids, default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_bytes", [ed.BROADCAST_BYTES, 0])
def test_copies_equal_brute_force(odd_docs, texts, max_bytes):
    more = [(100 + i, f"copy  {i % 7}\tof\n{i % 3}" + "\r" * (i % 2)) for i in range(80)] + [(None, ""), (None, "alone"), (50, "x\x1cy"), (51, "x y"), (52, "x y")]
    docs = odd_docs.select("doc_id", "text", "kept").union(odd_docs.sparkSession.createDataFrame([(i, t, "z") for i, t in more], "doc_id bigint, text string, kept string"))
    rows = ed.copies(docs, max_bytes=max_bytes)
    assert rows.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, rows.collect()), key=repr) == brute(texts + more)


def test_a_hot_group_beside_others_without_broadcasts(spark):
    rows = [(i, "the same text") for i in range(2500)] + [(5000 + i, f"pair {i // 2}") for i in range(60)] + [(9000 + i, f"single {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert sorted(map(tuple, ed.copies(docs, max_bytes=0).collect()), key=repr) == brute(rows)


def test_bytes_decide_not_fingerprints(spark):
    rows = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, 7, "b"), (4, 8, "c")], "id bigint, fp bigint, body string")
    assert [(r.fp, r.keep_id, r.n) for r in ed.verified(rows).collect()] == [(7, 2, 2)]


def test_many_ranges_and_small_tasks_count_alike(spark):
    rows = spark.range(3000).selectExpr("xxhash64(id % 1000) fp").repartition(5)
    merged = ed.filters(rows, 3000, range_rows=64, task_rows=100)
    assert merged.count() > 16
    assert {r.n for r in ed.repeated(merged).collect()} == {3} and ed.repeated(merged).count() == 1000


def test_deduplicate_keeps_one_of_each(odd_docs, no_docs, texts):
    left = ed.deduplicate(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert left.where("doc_id is null").count() == 1
    assert ed.deduplicate(no_docs).count() == 0 and ed.copies(no_docs).count() == 0
    with pytest.raises(ValueError):
        ed.deduplicate(odd_docs.withColumnRenamed("kept", "_FP"))
