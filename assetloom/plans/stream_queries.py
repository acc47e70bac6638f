"""Registered queries over tables that a stream of records filled, with a batch run twice on the way."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.stable import delete_at_end, shared_folder
from ..sources.sinks import BatchFolders
from ..streaming import upsert
from .derived import table
from .registry import query

_stored: dict[tuple[str, str], BatchFolders] = {}


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as link and property records: sources of number 3 are unknown, each 11th link has an unknown type, each 7th property no payload."""
    e = F.col("event_id")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    host = F.concat(F.lit("h"), (F.col("user_id") % 500).cast("string"), F.lit(".com"))
    uuid = F.concat(F.lit(" U"), (e % 4).cast("string"))
    events = table(spark, sf_dir, "events").withColumn("part", e % 2)
    links = events.select("part", host.alias("value_1"), F.concat(F.lit("10.9.0."), (e % 50).cast("string")).alias("value_2"), F.lit("FQDN").alias("type_1"), F.when(e % 11 == 0, "planet").otherwise("ip").alias("type_2"), uuid.alias("source_uuid"), at.alias("detection_date"), at.alias("update_date"))
    properties = events.select("part", host.alias("value"), F.lit("fqdn").alias("type"), uuid.alias("source_uuid"), F.when(e % 7 != 0, F.col("props")).alias("payload"), at.alias("version"), at.alias("detection_date"), e.alias("pos"))
    return links, properties


def _streamed(spark: SparkSession, sf_dir: str) -> BatchFolders:
    """The tables after two batches and a restart that runs the second again, filled once an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _stored:
        return _stored[key]
    root = shared_folder(spark, "streamed")
    schemas = (upsert.LINK_RECORD, upsert.PROPERTY_RECORD)
    paths = [posixpath.join(root, name) for name in ("links", "properties")]
    store = BatchFolders(spark, posixpath.join(root, "tables"), upsert.TABLES)
    source = spark.createDataFrame([("u0", 0), ("u1", 1), ("u2", 2)], "uuid string, id_source int")

    def drain() -> None:
        streams = [spark.readStream.schema(s).json(p) for s, p in zip(schemas, paths, strict=True)]
        upsert.stream_into(*streams, source, store, lambda number: 1_700_000_000 + number, posixpath.join(root, "state")).awaitTermination()

    for part in (0, 1):
        for rows, path in zip(_records(spark, sf_dir), paths, strict=True):
            rows.where(F.col("part") == part).drop("part").write.mode("append").json(path)
        drain()
    commit = spark._jvm.org.apache.hadoop.fs.Path(posixpath.join(root, "state", "commits", "1"))
    commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)  # as if the driver had been lost after its writes
    drain()
    delete_at_end(spark, root)
    _stored[key] = store
    return store


_E = "WITH e AS (SELECT *, 'h' || (user_id % 500) || '.com' AS host, floor(epoch(ts))::BIGINT AS v, (event_id % 4)::INT AS s FROM events)"


@query(f"""{_E} SELECT host AS value, s AS id_source, arg_max(props, (event_id % 2, event_id)) AS payload, max(v) AS version, min(v)::INT AS detection_date
FROM e WHERE s < 3 AND host IS NOT NULL AND event_id % 7 <> 0 AND props IS NOT NULL GROUP BY ALL""")
def streamed_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _streamed(spark, sf_dir)
    node = merge.current(store.read("node"), "node").where("node_type = 'fqdn'").select(F.col("id").alias("id_node"), "value")
    return merge.current(store.read("property"), "property").join(node, "id_node").select("value", "id_source", "payload", "version", "detection_date")


@query(f"""{_E} SELECT host AS value_1, '10.9.0.' || (event_id % 50) AS value_2, s AS id_source, min(v)::INT AS detection_date, max(v) AS version FROM e WHERE s < 3 AND host IS NOT NULL AND event_id % 11 <> 0 GROUP BY ALL""")
def streamed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _streamed(spark, sf_dir)
    node = merge.current(store.read("node"), "node")
    end = lambda kind, i: node.where(F.col("node_type") == kind).select(F.col("id").alias(f"id_{i}"), F.col("value").alias(f"value_{i}"))
    rows = merge.current(store.read("link"), "link").where("type_1 = 'fqdn' and type_2 = 'ip'")
    return rows.join(end("fqdn", 1), "id_1").join(end("ip", 2), "id_2").select("value_1", "value_2", "id_source", "detection_date", "version")


@query(f"""{_E}, r AS (SELECT 'link' AS kind, CASE WHEN s = 3 THEN 'unknown_source' WHEN event_id % 11 = 0 THEN 'unknown_type' WHEN host IS NULL THEN 'empty_value' END AS reason FROM e
 UNION ALL SELECT 'property', CASE WHEN s = 3 THEN 'unknown_source' WHEN host IS NULL THEN 'empty_value' WHEN event_id % 7 = 0 OR props IS NULL THEN 'no_payload' END FROM e)
SELECT kind, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""")
def streamed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted once, though a batch was run twice."""
    return _streamed(spark, sf_dir).read("reject").groupBy("kind", "reason").agg(F.sum("n").alias("n"))


@query(f"{_E}, v AS (SELECT 'fqdn' AS node_type, host AS value FROM e WHERE s < 3 AND host IS NOT NULL AND (event_id % 11 <> 0 OR (event_id % 7 <> 0 AND props IS NOT NULL)) UNION SELECT 'ip', '10.9.0.' || (event_id % 50) FROM e WHERE s < 3 AND host IS NOT NULL AND event_id % 11 <> 0) SELECT node_type, count(*) AS n, count(*) AS n_ids, min(1)::BIGINT AS first_id, count(*) AS last_id FROM v GROUP BY 1")
def streamed_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are dense and none is given twice."""
    rows = _streamed(spark, sf_dir).read("node")
    return rows.groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
