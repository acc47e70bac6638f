"""Names masked by one trie, against an alternation of all variants, longest first."""

import hashlib
import random
import re
import time

from assetloom.operators import explain


def by_pattern(text, masks):
    parts = [re.escape(v) if len(v) >= 4 else rf"(?<![0-9a-zA-Z]){re.escape(v)}(?![0-9a-zA-Z])" for v in sorted(masks, key=lambda v: (-len(v), v))]
    return re.sub("|".join(parts), lambda m: masks[explain.folded(m[0])], text, flags=re.IGNORECASE)


def test_masker_equals_pattern():
    rng = random.Random(9)
    names = ["js", "a", "ab-c", "abc", "abcd", "bcda", "cd.ab", "straße", "élan vital", "stripe", "ss", "İx-y", "aaaa", "aaaaaa"]
    masks = {explain.folded(n): f"<{i}>" for i, n in enumerate(names)}
    own = explain.Masker(masks)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b", "c", "d", "-", ".", " ", "AB", "js", "ss", "ſtripe", "STRIPE", "straße", "ÉLAN VITAL", "İX-Y", "1", "日"]) for _ in range(rng.randint(0, 14)))
        assert own.mask(text) == by_pattern(text, masks), text
    assert explain.Masker({}).mask("abc") == "abc"


def test_many_names_in_time_of_the_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = docs.where("text is not null").first().text
    some = sorted({w for w in re.findall(r"[a-z]{6,}", text.lower())})[:3]
    names = spark.range(100_000).selectExpr("concat('vendor ', hex(xxhash64(id))) name").union(spark.createDataFrame([(w,) for w in some], "name string"))
    began = time.perf_counter()
    rows = explain.pseudonymise(docs, ["text"], names).collect()
    assert time.perf_counter() - began < 60
    masks = {w: "plugin_" + hashlib.sha1(w.encode()).hexdigest()[:6] for w in some}
    assert {r.doc_id: r.text for r in rows} == {r.doc_id: by_pattern(r.text, masks) if r.text else r.text for r in docs.collect()}
