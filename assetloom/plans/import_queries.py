"""Registered queries of whole imports: a folder of mixed files, an import that is sent twice, payloads that are objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest, merge
from ..operators.stable import delete_at_end, shared_folder
from ..sources import files, sinks
from . import queries as q
from .derived import GRAPH, graph, table
from .load_queries import NOW
from .registry import query


@query("""WITH c AS (SELECT 'domain' AS kind, count(*) AS good, count(*) FILTER (page_id % 10 = 0) AS rejected FROM pages UNION ALL SELECT 'node', count(*), 0 FROM customer
UNION ALL SELECT 'link', count(*), 0 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'property', count(*), 0 FROM events)
SELECT *, NOT (rejected > 20 AND rejected > 0.05 * (good + rejected)) AS within_limit FROM c""")
def staged_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder go by their names; each kind says how many lines are good and whether the others are few enough."""
    folder = shared_folder(spark, "staged")
    c = F.col("c_custkey").cast("string")
    own = q._domains(spark, sf_dir)
    bad = F.when(F.col("record_id") % 10 == 0, F.array(F.lit('{"cn": broken'))).otherwise(F.array().cast("array<string>"))
    write = lambda rows, name: rows.write.option("sep", ";").option("header", True).option("escape", "\\").csv(f"{folder}/{name}")
    write(table(spark, sf_dir, "customer").select(c.alias("id"), F.concat(c, F.lit(".com")).alias("value"), F.lit("fqdn").alias("type"), F.lit("2020-01-01").alias("creation_date"), F.lit("1").alias("rank")), "2020_nodes.csv")
    write(q._staged(spark, sf_dir).select("value_1", "value_2", "type_1", "type_2", "id_source", "creation_date", "update_date"), "2020_edges.csv")
    write(q._props(spark, sf_dir).select("id_node", "type", "id_source", "payload", "version", "detection_date"), "node_properties.csv")
    own.select(F.explode(F.concat(F.array(F.to_json(F.struct("cn", "dns", "ip"))), bad)).alias("line")).write.text(f"{folder}/domains.json")
    own.select(F.lit("notes").alias("line")).limit(1).write.text(f"{folder}/readme.txt")
    delete_at_end(spark, folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f"{folder}/{s.getPath().getName()}" for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    counts = None
    for kind, paths in files.route(names).items():
        good, rejected = files.read_staged(spark, paths, kind)
        try:
            files.tolerated(good, rejected, max_rows=20, max_share=0.05)
            within = True
        except ValueError:
            within = False
        n = good.agg(F.count(F.lit(1)).alias("good")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("rejected")))  # a row each
        rows = n.select(F.lit(kind).alias("kind"), "good", "rejected", F.lit(within).alias("within_limit"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


@query(f"""{GRAPH}, {q._STAGED}, r AS (SELECT type_1, id_1, type_2, id_2, id_source, e::INT AS detection_date FROM j WHERE id_1 IS NOT NULL AND id_2 IS NOT NULL AND NOT (type_2 = 'fqdn' AND id_1 = id_2)),
b AS (SELECT * FROM r UNION ALL SELECT type_2, id_2, type_1, id_1, id_source, detection_date FROM r)
SELECT type_1, id_1, type_2, id_2, id_source, min(detection_date) AS detection_date, 2 AS batches FROM b GROUP BY ALL""")
def reimported_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of links that is imported twice: the table holds both, its current rows are those of one."""
    path, node = shared_folder(spark, "reimported"), graph(spark, sf_dir).node.select("node_type", "value", "id")
    for seq in (1, 2):
        rows = ingest.resolve_links(q._staged(spark, sf_dir), node, NOW, seq)[0]
        sinks.append(rows, path, "link")
    delete_at_end(spark, path)
    stored = spark.read.parquet(path)
    n = stored.agg(F.count_distinct("ingest_seq").cast("int").alias("batches"))
    return merge.current(stored, "link").select(*merge.KEYS["link"], "detection_date").crossJoin(n)  # n is a row


@query("""WITH r AS (SELECT 'h' || (user_id % 500) || '.com' AS value, '{"event":"' || event_type || '","at":{"user":' || user_id || ',"ids":[' || event_id || ']}}' AS payload, event_id AS pos, floor(epoch(ts))::BIGINT AS v FROM events WHERE user_id IS NOT NULL)
SELECT 'fqdn' AS node_type, dense_rank() OVER (ORDER BY value) AS id_node, 0 AS id_source, arg_max(payload, pos) AS payload, max(v) AS version, min(v)::INT AS detection_date FROM r GROUP BY value""")
def upsert_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties whose payload is a nested object, written as JSON."""
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    payload = F.struct(F.col("event_type").alias("event"), F.struct(F.col("user_id").alias("user"), F.array("event_id").alias("ids")).alias("at"))
    props = table(spark, sf_dir, "events").where("user_id is not null").select(F.concat(F.lit("h"), (F.col("user_id") % 500).cast("string"), F.lit(".com")).alias("value"), F.lit("fqdn").alias("type"), F.lit("u0").alias("source_uuid"), payload.alias("payload"), at.alias("version"), at.alias("detection_date"), F.col("event_id").alias("pos"))
    links = spark.createDataFrame([], "value_1 string, value_2 string, type_1 string, type_2 string, source_uuid string, detection_date string, update_date string")
    source = spark.createDataFrame([("u0", 0)], "uuid string, id_source int")
    node = spark.createDataFrame([], "node_type string, value string, id bigint, rank int, version bigint, ingest_seq bigint")
    return ingest.upsert_batch(links, props, source, node, NOW)[1].drop("ingest_seq")
