import zlib

from assetloom.llm import quality_model, queries


def test_held_out_accuracy(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = queries.op6_quality_model(spark, sf_dir).collect()
    assert len(rows) == queries.table(spark, sf_dir, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, q in held if q], [s for s, _, q in held if not q]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    print("auc", wins / len(good) / len(bad), "accuracy", sum(p == q for _, p, q in held) / len(held))
    assert wins >= 0.97 * len(good) * len(bad) and sum(p == q for _, p, q in held) >= 0.95 * len(held)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (5, 1), (6, 0), (8, 1), (99, 0), (7, 5)], "doc_id bigint, quality int")
    model = quality_model.train(odd_docs, labels)
    rows = quality_model.score(odd_docs, model, keep=["kept"]).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[1] == by[2] == by[3]
    assert quality_model.score(no_docs, model).count() == 0
    untrained = quality_model.train(odd_docs, labels.where("false"))
    assert {r.score for r in quality_model.score(odd_docs, untrained).collect()} == {0.5}
