"""A typed asset graph derived from the star-schema tables, in Spark and as common table expressions for DuckDB.

Customers are hosts under nation and segment hosts, suppliers addresses, parts captures, nations and segments
plugins; order lines are the links.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import both_ways, reverse
from ..operators.neighbourhood import ROWS_OF_A_TASK
from ..operators.stable import delete_at_end, shared_folder
from ..schema import LINK, NODE
from ..sources import sinks

SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass
class Graph:
    """one_way has the links of order lines, in ranges by host, and those of plugins, each from its host; link has all of them both ways."""

    node: DataFrame
    link: DataFrame
    one_way: tuple[DataFrame, DataFrame] | None = None


_stored: dict[tuple[str, str], Graph] = {}


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph of a folder's tables, stored once an application as the library stores batches, and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        own = derived(spark, sf_dir)
        node, link = shared_folder(spark, "node"), shared_folder(spark, "link")
        for path in (node, link):
            delete_at_end(spark, path)
        sinks.append(own.node, node, "node")
        lined, plug = own.one_way
        sinks.append(lined, link, "link", ranged=True)
        sinks.append(plug, link, "link")
        # the other direction comes from the stored one, so that only its rows are moved
        sinks.append(reverse(spark.read.schema(LINK).parquet(link)), link, "link")
        read = lambda path, schema: spark.read.schema(schema).parquet(path)
        _stored[key] = Graph(read(node, NODE + ", rev_value string").select(*own.node.columns, "rev_value"), read(link, LINK).select(*own.link.columns))
    return _stored[key]


def derived(spark: SparkSession, sf_dir: str) -> Graph:
    t = lambda name: table(spark, sf_dir, name)
    segment = F.lower("c_mktsegment")
    seg_id = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), segment).cast("bigint")
    customer = t("customer").select(F.col("c_custkey").alias("c"), F.col("c_nationkey").cast("bigint").alias("n"), segment.alias("seg"), seg_id.alias("k"))
    c, n = F.col("c"), F.col("n")
    rank = F.when(c % 5 != 0, 1 + (c * 7919) % 100003).cast("int")
    seg_rows = spark.createDataFrame([(i + 1, s) for i, s in enumerate(SEGMENTS)], "id bigint, s string")
    nations = t("nation").select(F.col("n_nationkey").cast("bigint").alias("n"), "n_name")
    typed = lambda df, kind, value, id_, r=None: df.select(F.lit(kind).alias("node_type"), value.alias("value"), id_.alias("id"), (r if r is not None else F.lit(None).cast("int")).alias("rank"))
    parts = t("part").select((F.col("p_partkey") % 200).alias("p")).distinct()
    node = typed(seg_rows, "fqdn", F.concat("s", F.lit(".com")), F.col("id"))
    for more in (
        typed(nations, "fqdn", F.concat(F.lit("nat"), n.cast("string"), F.lit(".com")), 101 + n),
        typed(customer, "fqdn", F.concat(F.lit("c"), c.cast("string"), F.lit(".nat"), n.cast("string"), F.lit("."), "seg", F.lit(".com")), 1000 + c, rank),
        typed(t("supplier").select(F.col("s_suppkey").alias("s")), "ip", F.concat(F.lit("10.0."), F.expr("s div 256").cast("string"), F.lit("."), (F.col("s") % 256).cast("string")), F.col("s") + 1),
        typed(parts, "capture", F.concat(F.lit("cap"), F.col("p").cast("string")), F.col("p") + 1),
        typed(nations, "plugin", F.col("n_name"), 1 + n),
        typed(seg_rows, "plugin", F.col("s"), 100 + F.col("id")),
    ):
        node = node.unionAll(more)
    zero = F.lit(0).cast("bigint")
    node = node.select("*", zero.alias("version"), zero.alias("ingest_seq"))

    lines = t("lineitem").select("l_orderkey", (F.col("l_partkey") % 200).alias("p"), F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("ln"), F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("ts"))
    co = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c")).join(lines, "l_orderkey")
    chosen = ((F.col("p") % 25) == (c % 25)) | ((F.col("ln") == 1) & ((F.col("p") % 50) == 0)) | (((c % 75) == 7) & ((F.col("p") % 25) == 8))
    # a line is joined once: what it links to comes after
    ends = F.filter(F.array(F.struct(F.lit(False).alias("cap"), (F.col("s") + 1).alias("id_2")), F.when(chosen, F.struct(F.lit(True).alias("cap"), (F.col("p") + 1).alias("id_2")))), lambda x: x.isNotNull())
    rows = co.select((1000 + c).alias("id_1"), (F.col("ln") % 5).cast("int").alias("id_source"), "ts", F.inline(ends))
    # ranges of whole keys hold all rows of a group, so rows are moved once for the aggregation and for the order in which they are stored
    key = ["id_1", "cap", "id_2", "id_source"]
    parts = max(1, -(-t("lineitem").count() // ROWS_OF_A_TASK))
    lined = rows.repartitionByRange(parts, *key).groupBy(*key).agg(F.min("ts").cast("int").alias("detection_date"), F.max("ts").alias("version"))
    lined = lined.select(F.lit("fqdn").alias("type_1"), "id_1", F.when(F.col("cap"), "capture").otherwise("ip").alias("type_2"), "id_2", "id_source", "detection_date", "version")
    classified = seg_rows.select(F.col("id").alias("f"), (100 + F.col("id")).alias("g")).unionAll(nations.select(101 + n, 1 + n)).unionAll(customer.where(c % 3 != 0).select(1000 + c, 1 + c % 25))
    plug = classified.select(F.lit("fqdn").alias("type_1"), F.col("f").alias("id_1"), F.lit("plugin").alias("type_2"), F.col("g").alias("id_2"), F.lit(0).alias("id_source"), F.lit(0).alias("detection_date"), zero.alias("version"))
    lined, plug = lined.withColumn("ingest_seq", zero), plug.withColumn("ingest_seq", zero)
    return Graph(node, both_ways(lined.unionByName(plug)), (lined, plug))


_SEG = "CASE lower(c_mktsegment) " + " ".join(f"WHEN '{s}' THEN {i + 1}" for i, s in enumerate(SEGMENTS)) + " END"
_SEGS = ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(SEGMENTS))

#: The same graph for DuckDB; queries go on with a comma or SELECT.
GRAPH = f"""WITH seg(id, s) AS (VALUES {_SEGS}),
node AS (
  SELECT 'fqdn' AS node_type, s || '.com' AS value, id::BIGINT AS id, NULL::INT AS rank FROM seg
  UNION ALL SELECT 'fqdn', 'nat' || n_nationkey || '.com', 101 + n_nationkey, NULL FROM nation
  UNION ALL SELECT 'fqdn', 'c' || c_custkey || '.nat' || c_nationkey || '.' || lower(c_mktsegment) || '.com', 1000 + c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN (1 + (c_custkey * 7919) % 100003)::INT END FROM customer
  UNION ALL SELECT 'ip', '10.0.' || (s_suppkey // 256) || '.' || (s_suppkey % 256), s_suppkey + 1, NULL FROM supplier
  UNION ALL SELECT DISTINCT 'capture', 'cap' || (p_partkey % 200), p_partkey % 200 + 1, NULL::INT FROM part
  UNION ALL SELECT 'plugin', n_name, 1 + n_nationkey, NULL FROM nation
  UNION ALL SELECT 'plugin', s, 100 + id, NULL FROM seg),
co AS (SELECT o_custkey AS c, l_partkey AS p, l_suppkey AS s, l_linenumber AS ln, epoch(l_shipdate)::BIGINT AS ts FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
one AS (
  SELECT 'fqdn' AS type_1, 1000 + c AS id_1, 'ip' AS type_2, s + 1 AS id_2, (ln % 5)::INT AS id_source, min(ts)::INT AS detection_date, max(ts) AS version FROM co GROUP BY ALL
  UNION ALL SELECT 'fqdn', 1000 + c, 'capture', p % 200 + 1, (ln % 5)::INT, min(ts)::INT, max(ts) FROM co WHERE p % 25 = c % 25 OR (ln = 1 AND p % 50 = 0) OR (c % 75 = 7 AND p % 25 = 8) GROUP BY ALL
  UNION ALL SELECT 'fqdn', id, 'plugin', 100 + id, 0, 0, 0 FROM seg
  UNION ALL SELECT 'fqdn', 101 + n_nationkey, 'plugin', 1 + n_nationkey, 0, 0, 0 FROM nation
  UNION ALL SELECT 'fqdn', 1000 + c_custkey, 'plugin', 1 + c_custkey % 25, 0, 0, 0 FROM customer WHERE c_custkey % 3 <> 0),
link AS (SELECT * FROM one UNION ALL SELECT type_2, id_2, type_1, id_1, id_source, detection_date, version FROM one)"""
