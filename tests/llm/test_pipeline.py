import hashlib

import pytest

import corpus_pipeline
from assetloom.llm import queries, secrets

from .test_encoding import PATH, expected, reference  # noqa: F401
from .test_filters import all_windows, hits
from .test_near_dedup import brute_force


def test_run_equals_brute_force(spark, sf_dir, reference):  # noqa: F811
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    good = {r.doc_id for r in queries.op6_quality_model(spark, sf_dir).collect() if r.predicted}
    kept = {i for i, (_, c) in brute_force([(i, texts[i]) for i in good], percent=80).items() if i == c}
    windows = all_windows(map(tuple, queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()))
    clean = {i for i in kept if not hits(texts[i], windows)[1]}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == clean and len(rows) == len(clean) and 0 < len(clean) < len(texts)
    for r in rows:
        text = secrets.redacted(texts[r.doc_id], secrets.spans(texts[r.doc_id]))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(reference, text)
        assert hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256


def test_near_copies_of_eighty_percent_go(spark, sf_dir):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words))]
    for i, changed in ((2, 8), (3, 9), (4, 10)):  # 5 shingles a changed word of 396: 0.816, 0.794, 0.775
        own = list(words)
        for k in range(changed):
            own[20 + 30 * k] = f"x{i}-{k}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()} == {1, 3, 4}


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_tables(spark, sf_dir, texts, stage):
    rows = [(i, t, None, "s", len(t) if t else None, 1.0, "x") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, spans string")
    f = corpus_pipeline.STAGES[stage][1]
    out = f(spark, docs, sf_dir)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.dtypes == docs.dtypes
    if stage == 1:
        assert out.where("doc_id = 7").count() == 1 and out.where("doc_id = 10").count() == 0
    assert out.count() <= len(rows) and f(spark, docs.where("false"), sf_dir).count() == 0
