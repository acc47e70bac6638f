"""Files, sinks, the generator and the stream."""

import gzip

import pytest
from pyspark.sql import functions as F

from assetloom.operators import merge
from assetloom.schema import LINK, NODE, PROPERTY
from assetloom.sources import files, generator, sinks
from assetloom.streaming import upsert


def test_routing_by_name():
    names = ["a/node_properties.csv", "nodes.csv", "links.csv", "edges.csv", "d.json", "d.json.gz", "x.txt"]
    assert [files.kind_of(n) for n in names] == ["property", "node", "link", "link", "domain", "domain", None]
    assert files.route(names)["link"] == ["edges.csv", "links.csv"]


def test_staged_files(spark, tmp_path):
    (tmp_path / "nodes.csv").write_text('id;value;type;creation_date;rank\n"1";"a;b.com";"fqdn";"";"3"\n2;c.com;fqdn;;\n')
    good, bad = files.read_staged(spark, str(tmp_path / "nodes.csv"), "node")
    assert [(r.id, r.value, r["rank"]) for r in good.orderBy("id").collect()] == [("1", "a;b.com", "3"), ("2", "c.com", None)] and files.tolerated(good, bad) == 0
    (tmp_path / "properties.csv").write_bytes(b'id_node;type;id_source;payload;version;detection_date\r\n1;fqdn;2;"{\\"k\\": \\"v;w\\"}";;\r\n')
    good, _ = files.read_staged(spark, str(tmp_path / "properties.csv"), "property")
    assert good.first().payload == '{"k": "v;w"}'
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write('{"cn": "a.com", "dns": ["b.com", null], "ip": null}\nnot json\n{"cn": null, "dns": null, "ip": "1.1.1.1"}\n')
    good, bad = files.read_staged(spark, str(tmp_path / "d.json.gz"), "domain")
    assert good.count() == 2 and bad.count() == 1
    with pytest.raises(ValueError):
        files.tolerated(good, bad, max_rows=0, max_share=0.1)


def test_rankings_verdicts_and_lists(spark, tmp_path):
    (tmp_path / "r1.csv").write_text("﻿rank,domain\n1,a.com\n2,b.com\nbad\n")
    (tmp_path / "r2.csv").write_text("a.com;5\nb.com;x\n")
    assert [tuple(r) for r in files.read_ranks(spark, str(tmp_path / "r1.csv")).collect()] == [("a.com", 1), ("b.com", 2)]
    assert [tuple(r) for r in files.read_ranks(spark, str(tmp_path / "r2.csv")).collect()] == [("a.com", 5)]
    (tmp_path / "g.tsv").write_text("#harmonicc_pos\tv\tp\tq\thost\n3\t1.0\t4\t2.0\tcom.google.www\t9\n4\tshort\n")
    assert [tuple(r) for r in files.read_web_graph_ranks(spark, str(tmp_path / "g.tsv")).collect()] == [("www.google.com", 3)]
    (tmp_path / "v.csv").write_text("﻿fqdn;plugin;status;score;signals;verdict;commentaire\n a.com ;p;s;2;ip; ok ;note\n;p;;;;KO;\n")
    assert [tuple(r) for r in files.read_verdicts(spark, str(tmp_path / "v.csv")).collect()] == [("a.com", "p", "OK", "note")]
    (tmp_path / "n.txt").write_text("# all\nb # x\n\na\nb\n")
    assert [r.name for r in files.read_names(spark, str(tmp_path / "n.txt")).collect()] == ["a", "b"]


def test_sinks(spark, tmp_path):
    node = spark.createDataFrame([("fqdn", "a.com", 1, None, 0, 0), ("ip", "1.1.1.1", 1, None, 0, 0)], NODE)
    for _ in range(2):
        sinks.append(node, str(tmp_path / "node"), "node")
    back = spark.read.parquet(str(tmp_path / "node"))
    assert back.count() == 4 and back.where("rev_value = 'moc.a'").count() == 2
    rank = spark.createDataFrame([("fqdn", 1, 1, 1577836800, 5, 0), ("fqdn", 1, 1, 86400, 5, 0)], "node_type string, id_node bigint, id_source int, creation_date int, rank int, ingest_seq bigint")
    sinks.append(rank, str(tmp_path / "rank"), "rank")
    assert sinks.drop_months(spark, str(tmp_path / "rank"), "201912") == ["197001"]
    assert [r.creation_date for r in spark.read.parquet(str(tmp_path / "rank")).collect()] == [1577836800]
    assert sinks.drop_months(spark, str(tmp_path / "rank"), "201912") == [] and sinks.drop_months(spark, str(tmp_path / "none"), "201912") == []
    sinks.export_csv(spark.createDataFrame([(1, 86400)], "id int, first_seen int"), str(tmp_path / "csv"))
    assert "1970-01-02" in spark.read.text(str(tmp_path / "csv")).where("value like '1%'").first().value
    sinks.replace(node, str(tmp_path / "node2"))
    sinks.export_sample(node.select("value", F.lit("").alias("verdict")), str(tmp_path / "sample"))
    assert spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "sample")).count() == 2


def test_generator_is_repeatable_and_symmetric(spark):
    node, link = generator.generate(spark, 1000, 300, 2000)
    again, _ = generator.generate(spark, 1000, 300, 2000)
    assert node.exceptAll(again).count() == 0 and node.where("node_type = 'fqdn'").select("value").distinct().count() == 1000
    assert link.count() == 4000 and node.where("value like '%youtube%' or value like '%google%'").count() == 20
    back = link.selectExpr("type_2 as type_1", "id_2 as id_1", "type_1 as type_2", "id_1 as id_2")
    assert back.exceptAll(link.select("type_1", "id_1", "type_2", "id_2")).count() == 0


def test_property_files_may_have_line_breaks_on_request(spark, tmp_path):
    (tmp_path / "properties.csv").write_bytes(b'id_node;type;id_source;payload;version;detection_date\r\n1;fqdn;2;"a\nb";;\r\n')
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    good, bad = files.read_staged(spark, str(tmp_path / "properties.csv"), "property", multi_line=True)
    assert good.first().payload == "a\nb" and bad.count() == 0 and len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_properties_stream_beside_links(spark, tmp_path):
    links = [("h1.com", "1.1.1.1", "fqdn", "ip", "u1", "2020-01-01", None)]
    spark.createDataFrame(links, upsert.LINK_RECORD).write.json(str(tmp_path / "links"))
    props = [(f"h{i % 3}.com", "fqdn", "u1" if i < 8 else "u9", {"k": str(i)}, "2020-01-01 00:00:00.5+00:00", None, i) for i in range(9)]
    schema = upsert.PROPERTY_RECORD.replace("payload string", "payload map<string,string>")
    spark.createDataFrame(props, schema).repartition(3).write.json(str(tmp_path / "props"))
    source = spark.createDataFrame([("u1", 3)], "uuid string, id_source int")
    schemas = {"node": NODE, "link": LINK, "property": PROPERTY, "reject": "kind string, reason string, n bigint"}

    def read(table):
        return spark.read.schema(schemas[table]).parquet(str(tmp_path / table)) if (tmp_path / table).exists() else spark.createDataFrame([], schemas[table])

    streams = (spark.readStream.schema(s).option("maxFilesPerTrigger", 1).json(str(tmp_path / d)) for s, d in ((upsert.LINK_RECORD, "links"), (schema, "props")))
    q = upsert.stream_upsert(*streams, source, lambda: read("node"), lambda t, df: df.write.mode("append").parquet(str(tmp_path / t)), lambda: 1000, str(tmp_path / "c"))
    assert q.awaitTermination(120)
    node = {r.value: r.id for r in merge.current(read("node"), "node").collect()}
    assert sorted(node) == ["1.1.1.1", "h0.com", "h1.com", "h2.com"] and read("link").count() == 2
    rows = merge.current(read("property"), "property").collect()
    assert {r.id_node for r in rows} == {node[f"h{i}.com"] for i in range(3)} and all(r.version == 1577836800 and r.payload.startswith('{"k":"') for r in rows)
    assert [tuple(r) for r in read("reject").groupBy("kind", "reason").agg(F.sum("n")).collect()] == [("property", "unknown_source", 1)]


def test_stream_equals_batch_and_repeats_change_nothing(spark, tmp_path):
    rows = [(f"h{i % 9}.com", f"1.1.1.{i % 5}", "fqdn", "ip", "u1", "2020-01-01", None) for i in range(40)]
    spark.createDataFrame(rows, upsert.LINK_RECORD).repartition(4).write.json(str(tmp_path / "in"))
    source = spark.createDataFrame([("u1", 3)], "uuid string, id_source int")
    none = spark.createDataFrame([], upsert.PROPERTY_RECORD)
    schemas = {"node": NODE, "link": LINK, "property": PROPERTY}

    def read(table):
        return spark.read.schema(schemas[table]).parquet(str(tmp_path / table)) if (tmp_path / table).exists() else spark.createDataFrame([], schemas[table])

    def run(checkpoint, per_file):
        stream = spark.readStream.schema(upsert.LINK_RECORD).option("maxFilesPerTrigger", per_file).json(str(tmp_path / "in"))
        q = upsert.stream_upsert(stream, none, source, lambda: read("node"), lambda t, df: df.write.mode("append").parquet(str(tmp_path / t)), lambda: 1000, str(tmp_path / checkpoint))
        assert q.awaitTermination(120)
        node = {(r.node_type, r.value): r.id for r in merge.current(read("node"), "node").collect()}
        link = {(r.type_1, r.id_1, r.type_2, r.id_2, r.id_source, r.detection_date) for r in merge.current(read("link"), "link").collect()}
        return node, link

    node, link = run("c1", 1)
    assert len(node) == 14 and sorted(i for (t, _), i in node.items() if t == "fqdn") == list(range(1, 10))
    assert len(link) == 2 * len({(r[0], r[1]) for r in rows})
    assert run("c2", 4) == (node, link)
