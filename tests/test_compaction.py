"""Compaction of the folders of a stored table that changed."""

from assetloom.operators import merge
from assetloom.schema import NODE
from assetloom.sources import sinks


def test_only_changed_folders_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "node")
    schema = NODE + ", rev_value string"

    def add(*rows):
        sinks.append(spark.createDataFrame(rows, NODE), path, "node")

    def files():
        return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in (tmp_path / "node").glob("node_type=*")}

    add(("fqdn", "a.com", 9, 7, 1, 0), ("fqdn", "b.com", 2, None, 1, 0), ("ip", "1.2.3.4", 1, 3, 1, 0))
    add(("fqdn", "a.com", 4, None, 3, 1))
    first = merge.compact_changed(spark, path, "node", schema)
    assert sorted(map(tuple, first.collect())) == [("fqdn", 3, 2, 1), ("ip", 1, 1, 0)]
    assert merge.compact_changed(spark, path, "node", schema).collect() == []
    before = files()
    add(("ip", "1.2.3.4", 8, 5, 0, 2))
    second = merge.compact_changed(spark, path, "node", schema)
    assert list(map(tuple, second.collect())) == [("ip", 2, 1, 2)]
    after = files()
    assert after["node_type=fqdn"] == before["node_type=fqdn"] and after["node_type=ip"] != before["node_type=ip"]
    rows = spark.read.schema(schema).parquet(path).select("node_type", "value", "id", "rank", "version", "ingest_seq", "rev_value").collect()
    assert sorted(map(tuple, rows)) == [("fqdn", "a.com", 4, 7, 3, 1, "moc.a"), ("fqdn", "b.com", 2, None, 1, 0, "moc.b"), ("ip", "1.2.3.4", 1, 5, 1, 2, None)]
