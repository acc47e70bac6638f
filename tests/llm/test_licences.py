import re

import pytest

from assetloom.llm import licences, queries

LINES = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return licences.train(queries.table(spark, sf_dir, "documents"))


def test_query_finds_the_lines_and_nothing_else(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op7_licences(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sorted({f for line, f in LINES.items() if line in texts[r.doc_id]})
        assert r.families == ",".join(want) and r.n_unknown == 0, (r, want)
        for s in filter(None, r.spans.split(",")):
            family, a, b = s.rsplit(":", 2)
            assert LINES[texts[r.doc_id][int(a) : int(b)]] == family


def test_unseen_wordings_long_paragraphs_and_unknown_licences(spark, model):
    filler = " ".join(f"word{i}" for i in range(300))
    rows = [
        (1, f"{filler} This project is licensed under the MIT License and more {filler}"), (2, "You may redistribute under the terms of the GNU General Public License version 2 of the License"),
        (3, "The driver kept his license in the car."), (4, "Licensed under the Banana Source License, Version 9.1"), (5, "Nothing to see"),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\nx"),
    ]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert got[1].families == "MIT" and got[2].families == "GPL-2.0" and got[6].families == "MIT"
    assert got[3].families == got[5].families == got[4].families == "" and got[3].n_unknown == got[5].n_unknown == 0


def test_unseen_wordings_of_families_named_nowhere_in_the_corpus(spark, model):
    rows = {
        "this module is available under the Eclipse Public License 2.0 (see NOTICE)": "EPL-2.0",
        "it is provided 'as-is' without any express or implied warranty, use it freely": "Zlib",
        "our tool is free and unencumbered software, released into the public domain": "Unlicense",
        "Redistribution in binary form must reproduce the above copyright notice and this list of conditions": "BSD",
        "Redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation": "AGPL-3.0",
        "Distributed by the team under the Boost Software License, Version 1.0, see its text": "BSL-1.0",
        "The public library lent out a free book about the eclipse.": "",
    }
    got = licences.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"), model).orderBy("doc_id").collect()
    assert [r.families for r in got] == list(rows.values())


def test_sample_is_that_of_the_smallest_hashes(spark, sf_dir, odd_docs):
    docs = queries.table(spark, sf_dir, "documents").where("doc_id < 400")
    every = dict(sorted((r.h, r.p) for r in licences.paragraphs(docs).groupBy("h").agg({"p": "min"}).toDF("h", "p").collect()))
    for n in (3, 400):
        assert licences.sample(docs, licences.Settings(max_negatives=n)) == list(every.values())[:n]
    want = set()
    for r in odd_docs.select("text").collect():
        for line in (r.text or "").replace(". ", ".\n").split("\n"):
            own = re.findall(r"[^\x20\x09-\x0D]+", line)
            firsts = [0] if 0 < len(own) <= 24 else range(0, max(0, len(own) - 12), 12)
            want |= {" ".join(own[k : k + 24]) for k in firsts if len(" ".join(own[k : k + 24])) <= 2000}
    plain = lambda p: " ".join(map(licences._plain, p.split(" ")))
    got = [r.p for r in licences.paragraphs(odd_docs).collect()]
    assert set(got) <= want and {plain(p) for p in got} == {plain(p) for p in want}
    all_of_it = licences.sample(odd_docs, licences.Settings(max_negatives=10**6))
    assert sorted(map(plain, all_of_it)) == sorted({plain(p) for p in want})


def test_odd_rows(spark, odd_docs, no_docs, texts, model):
    got = licences.scan(odd_docs, model, keep=["kept"]).collect()
    assert sorted((r.doc_id or 0, r.n_paragraphs) for r in got) == sorted((i or 0, len([p for p in (t or "").replace(". ", ".\n").split("\n") if re.search(r"[^\x20\x09-\x0D]", p)])) for i, t in texts)
    assert licences.scan(no_docs, model).count() == 0
    assert licences.train(no_docs).families[-1] == "none"
