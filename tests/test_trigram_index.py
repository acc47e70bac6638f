"""A stored trigram index against a scan."""

import pytest

from assetloom.operators import trigram_index as ti

WORDS = ["net", "flix", "cdn", "youtube", "googlevideo", "shop", "élan", "a", ""]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    values = [(i, ".".join([WORDS[i % 9], WORDS[i * 7 % 9], f"n{i % 40}", "com"])) for i in range(900)] + [(1000, None), (None, "x.youtube.com"), (1001, ""), (1002, "yo")]
    path = str(tmp_path_factory.mktemp("index"))
    df = spark.createDataFrame(values, "id bigint, value string")
    ti.add_batch(df.where("id < 500 or id is null"), path, 0, 3)
    ti.add_batch(df.where("id >= 500"), path, 1, 3)
    return path, [(i, v) for i, v in values if i is not None and v is not None]


@pytest.mark.parametrize("term", ["youtube", "n3.com", "e.n1", "élan.", "com", "zzz", "youtubezzz", "yo", "", ".n39.", "(.*)"])
def test_search_equals_scan(spark, stored, term, monkeypatch):
    path, values = stored
    want = sorted((i, v, int(i >= 500)) for i, v in values if term in v)
    assert sorted(map(tuple, ti.search(spark, path, term).collect())) == want
    monkeypatch.setattr(ti, "MAX_KEYS", 1)
    assert sorted(map(tuple, ti.search(spark, path, term, k=1).collect())) == want


def test_a_batch_sent_again_replaces_itself(spark, tmp_path):
    first = spark.createDataFrame([(1, "one.net"), (2, "two.net")], "id bigint, value string")
    for _ in range(2):
        ti.add_batch(first, str(tmp_path), 0)
    ti.add_batch(spark.createDataFrame([(3, "three.net")], "id bigint, value string"), str(tmp_path), 1)
    assert ti.rarest(spark, str(tmp_path), "o.net", 2) == ["o.n", ".ne"]
    assert [r.n for r in ti._of(ti._read(spark, str(tmp_path), "counts", "gram string, n bigint"), [".ne"]).collect()] in ([2, 1], [1, 2])
    assert {r.id for r in ti.search(spark, str(tmp_path), "net").collect()} == {1, 2, 3}
    ti.add_batch(spark.createDataFrame([(2, "two.org")], "id bigint, value string"), str(tmp_path), 0)
    assert {r.id for r in ti.search(spark, str(tmp_path), "net").collect()} == {3}


def test_reads_are_pruned_by_folder_and_gram(spark, stored):
    path, _ = stored
    plan = ti.candidates(spark, path, ti.rarest(spark, path, "googlevideo", 2))._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "postings" in line)
    assert "PartitionFilters: [isnotnull(bucket" in scan or "PartitionFilters: [bucket" in scan
    assert "In(gram" in scan.split("PushedFilters")[1]
    by_id = ti.search(spark, path, "googlevideo.n1")._jdf.queryExecution().toString()
    assert "In(id" in by_id
