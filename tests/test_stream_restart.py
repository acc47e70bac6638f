"""A stream whose last batch is run again, by a restart, leaves the same tables."""

import os

from assetloom.sources.sinks import BatchFolders
from assetloom.streaming import upsert


class Counting(BatchFolders):
    puts: list = []

    def put(self, table, rows, number):
        self.puts.append((table, number))
        super().put(table, rows, number)


def contents(store):
    return {t: sorted(map(tuple, store.read(t).collect()), key=repr) for t in upsert.TABLES}


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    source = spark.createDataFrame([("u", 4)], "uuid string, id_source int")
    store = Counting(spark, str(tmp_path / "tables"), upsert.TABLES)
    none = spark.createDataFrame([], upsert.PROPERTY_RECORD)

    def drain():
        stream = spark.readStream.schema(upsert.LINK_RECORD).json(str(tmp_path / "in"))
        upsert.stream_into(stream, none, source, store, lambda number: 1000 + number, str(tmp_path / "state")).awaitTermination()

    def send(*rows):
        spark.createDataFrame([(a, b, "fqdn", kind, "U", None, None) for a, b, kind in rows], upsert.LINK_RECORD).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        drain()

    send(("a.com", "10.0.0.1", "ip"), ("b.com", "10.0.0.1", "planet"))
    send(("a.com", "10.0.0.2", "ip"), ("c.com", "10.0.0.3", "ip"), ("c.com", "c.com", "fqdn"))
    once, n = contents(store), len(store.puts)
    assert [r[:3] for r in once["node"]] == [("fqdn", "a.com", 1), ("fqdn", "c.com", 2), ("ip", "10.0.0.1", 1), ("ip", "10.0.0.2", 2), ("ip", "10.0.0.3", 3)]
    assert [r[:3] for r in once["reject"]] == [("link", "self_link", 1), ("link", "unknown_type", 1)]
    for name in ("1", ".1.crc"):
        os.remove(tmp_path / "state" / "commits" / name)
    drain()
    assert len(store.puts) == n + 4 and {x for _, x in store.puts[n:]} == {1}
    assert contents(store) == once
    assert {r.value for r in store.read("node", before=1).collect()} == {"a.com", "10.0.0.1"}
