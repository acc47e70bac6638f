"""Registered queries that go through files: staged imports, rankings, exports and stored tables, each with its SQL for DuckDB.

Each query writes files below the shared folder from the given tables and reads them back as a user's files are read.
"""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, domains, explain, ids, ingest, merge, normalize, ranks, search
from ..operators.stable import delete_at_end, shared_folder
from ..schema import LINK, NODE, RANK
from ..sources import files, sinks
from . import queries as q
from .derived import GRAPH, graph, table
from .registry import query

NOW = 1_700_000_000


def _folder(spark: SparkSession, name: str) -> str:
    return shared_folder(spark, name)


def _csv(df: DataFrame, name: str) -> str:
    """df as staged CSV files: semicolons, quotes, backslashes before quotes."""
    path = _folder(df.sparkSession, name)
    df.write.option("sep", ";").option("header", True).option("quote", '"').option("escape", "\\").option("quoteAll", True).csv(path)
    delete_at_end(df.sparkSession, path)
    return path


def _lines(df: DataFrame, name: str) -> str:
    path = _folder(df.sparkSession, name)
    df.select("line").write.text(path)
    delete_at_end(df.sparkSession, path)
    return path


# ---------------------------------------------------------------- staged files


@query("""SELECT 'fqdn' AS node_type, 'c"' || c_custkey || ';x.com' AS value, c_custkey::BIGINT AS id, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey::INT END AS rank,
 CASE WHEN c_custkey % 3 = 0 THEN 1700000000 ELSE epoch(DATE '2020-01-01' + (c_custkey % 9)::INT)::BIGINT END AS version FROM customer WHERE c_custkey % 4 <> 0""")
def staged_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (c % 9).cast("int")).cast("string")
    rows = table(spark, sf_dir, "customer").select(c.cast("string").alias("id"), F.concat(F.lit('c"'), c.cast("string"), F.lit(";x.com")).alias("value"), F.when(c % 4 == 0, "planet").otherwise("FQDN").alias("type"), F.when(c % 3 == 0, "").otherwise(day).alias("creation_date"), F.when(c % 5 == 0, "").otherwise(c.cast("string")).alias("rank"))
    good, _ = files.read_staged(spark, _csv(rows, "nodes"), "node")
    return ingest.distribute_nodes(good, NOW).drop("ingest_seq")


@query(f"""{GRAPH}, {q._STAGED}, r AS (SELECT type_1, id_1, type_2, id_2, id_source, e::INT AS detection_date, 1700000000::BIGINT AS version FROM j WHERE id_1 IS NOT NULL AND id_2 IS NOT NULL AND NOT (type_2 = 'fqdn' AND id_1 = id_2))
SELECT * FROM r UNION ALL SELECT type_2, id_2, type_1, id_1, id_source, detection_date, version FROM r""")
def staged_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q._staged(spark, sf_dir).select("value_1", "value_2", "type_1", "type_2", "id_source", "creation_date", "update_date")
    good, _ = files.read_staged(spark, _csv(rows, "links"), "link")
    return ingest.resolve_links(good, graph(spark, sf_dir).node.select("node_type", "value", "id"), NOW)[0].drop("ingest_seq")


@query(f"WITH {q._PROPS} SELECT * FROM t WHERE node_type IN {q._TYPES_SQL} AND id_node <> 0")
def staged_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q._props(spark, sf_dir).select("id_node", "type", "id_source", "payload", "version", "detection_date")
    good, _ = files.read_staged(spark, _csv(rows, "properties"), "property")
    return ingest.distribute_properties(good, NOW)[0].drop("ingest_seq")


@query(f"""WITH {q._PROPS} SELECT node_type, id_node, id_source, payload || chr(10) || '; "' || id_node || '"' || chr(10) || chr(10) || '\\' AS payload, version, detection_date FROM t WHERE node_type IN {q._TYPES_SQL} AND id_node <> 0""")
def staged_property_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of one file, whose cells hold line breaks, separators, quotes and backslashes."""
    broken = F.concat(F.col("payload"), F.lit('\n; "'), F.coalesce(F.col("id_node").try_cast("bigint"), F.lit(0)).cast("string"), F.lit('"\n\n\\'))
    rows = q._props(spark, sf_dir).select("id_node", "type", "id_source", broken.alias("payload"), "version", "detection_date")
    good, rejected = files.read_staged(spark, _csv(rows.coalesce(1), "records"), "property", multi_line=True)
    bad = rejected.select(F.lit("rejected").alias("node_type"), F.lit(0).cast("bigint").alias("id_node"), F.lit(0).alias("id_source"), F.col("line").alias("payload"), F.lit(0).cast("bigint").alias("version"), F.lit(0).alias("detection_date"))
    return ingest.distribute_properties(good, NOW)[0].drop("ingest_seq").unionByName(bad)


@query(f"""WITH {q._DOMAINS} SELECT field, kind AS type, value, count(*) AS n FROM k WHERE kind IN ('fqdn', 'ip') GROUP BY ALL
UNION ALL SELECT 'rejected', '', '', count(*) FROM pages WHERE page_id % 10 = 0""")
def staged_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q._domains(spark, sf_dir)
    bad = F.when(F.col("record_id") % 10 == 0, F.array(F.lit('{"cn": broken'))).otherwise(F.array().cast("array<string>"))
    lines = own.select(F.explode(F.concat(F.array(F.to_json(F.struct("cn", "dns", "ip"))), bad)).alias("line"))
    good, rejected = files.read_staged(spark, _lines(lines, "domains"), "domain")
    kept, _ = normalize.normalize_domains(good.withColumn("record_id", F.monotonically_increasing_id()))
    counts = kept.groupBy("field", "type", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(rejected.agg(F.lit("rejected").alias("field"), F.lit("").alias("type"), F.lit("").alias("value"), F.count(F.lit(1)).alias("n")))


@query(f"""{GRAPH}, {q._DOMAINS}, w AS (SELECT DISTINCT kind AS node_type, value FROM k WHERE kind IN ('fqdn', 'ip')), base AS (SELECT node_type, max(id) AS base FROM node GROUP BY 1)
SELECT node_type, value, min(id)::BIGINT AS id FROM w JOIN node USING (node_type, value) GROUP BY ALL
UNION ALL SELECT w.node_type, value, (coalesce(base, 0) + row_number() OVER (PARTITION BY w.node_type ORDER BY value))::BIGINT FROM w LEFT JOIN base USING (node_type) WHERE (w.node_type, value) NOT IN (SELECT node_type, value FROM node)""")
def domain_import_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = normalize.normalize_domains(q._domains(spark, sf_dir))
    return ids.resolve_or_create(normalize.domain_values(kept), graph(spark, sf_dir).node, NOW)[0]


@query("""SELECT 'nat' || c_nationkey || '-' || (c_custkey % 50) || '.com' AS value, min(c_custkey)::INT AS rank FROM customer WHERE c_custkey > 0 GROUP BY 1""")
def rank_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(",NAT"), F.col("c_nationkey").cast("string"), F.lit("-"), (F.col("c_custkey") % 50).cast("string"), F.lit(".com."))
    rows = table(spark, sf_dir, "customer").select(F.explode(F.array(line, F.lit("rank,domain"), F.lit("no rank here"))).alias("line"))
    return ranks.normalize_ranks(files.read_ranks(spark, _lines(rows, "ranking")))


@query(f"""{GRAPH}, r AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'www.new' || c_custkey || '.org' ELSE 'c' || c_custkey || '.nat' || c_nationkey || '.' || lower(c_mktsegment) || '.com' END AS value, c_custkey::INT AS rank FROM customer WHERE c_custkey > 0),
i AS (SELECT r.*, id FROM r JOIN node n ON n.node_type = 'fqdn' AND n.value = r.value UNION ALL SELECT r.*, (SELECT max(id) FROM node WHERE node_type = 'fqdn') + row_number() OVER (ORDER BY value) FROM r WHERE value NOT IN (SELECT value FROM node WHERE node_type = 'fqdn'))
SELECT 'fqdn' AS node_type, id::BIGINT AS id_node, 4 AS id_source, epoch(DATE '2026-10-10')::INT AS creation_date, rank FROM i""")
def web_graph_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    host = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("org.new"), c, F.lit(".www"))).otherwise(F.concat(F.lit("com."), F.lower("c_mktsegment"), F.lit(".nat"), n, F.lit(".c"), c))
    cells = F.concat_ws("\t", c, F.lit("1.5"), c, F.lit("0.1"), host, F.lit("3"))
    lines = table(spark, sf_dir, "customer").select(F.explode(F.array(cells, F.lit("#harmonicc_pos\tharmonicc_val"), F.lit("7\tshort"))).alias("line"))
    source, day = spark.createDataFrame([("abc", 4)], "uuid string, id_source int"), datetime.date(2026, 10, 5)
    return ranks.load_web_graph(spark, _lines(lines, "webgraph"), " ABC", day, graph(spark, sf_dir).node, source, 0, day)[0].drop("ingest_seq")


@query("""SELECT 'h' || c_custkey || '.com' AS fqdn, lower(c_mktsegment) AS plugin, CASE c_custkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'KO' ELSE '' END AS verdict, '' AS commentaire FROM customer WHERE c_custkey % 7 <> 0""")
def verdict_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    said = F.when(c % 3 == 0, " ok").when(c % 3 == 1, "Ko ").otherwise("")
    rows = table(spark, sf_dir, "customer").select(F.when(c % 7 == 0, "").otherwise(F.concat(F.lit(" h"), c.cast("string"), F.lit(".com "))).alias("fqdn"), F.lower("c_mktsegment").alias("plugin"), F.lit("non_classe").alias("status"), F.lit("2").alias("score"), F.lit("ip").alias("signals"), said.alias("verdict"), F.lit("").alias("commentaire"))
    return files.read_verdicts(spark, _csv(rows, "verdicts"))


@query("SELECT DISTINCT n_name AS name FROM nation")
def name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "nation").select(F.explode(F.array(F.concat(F.col("n_name"), F.lit("  # a nation")), F.col("n_name"), F.lit("# a comment"), F.lit(""))).alias("line"))
    return files.read_names(spark, _lines(lines, "names"))


# ---------------------------------------------------------------- stored tables and exports


@query(f"{GRAPH}, {q._BATCHES} SELECT node_type, value, min(id) AS id, arg_max(rank, seq) FILTER (rank IS NOT NULL) AS rank, max(version)::BIGINT AS version, count(*) AS n FROM b GROUP BY node_type, value")
def stored_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended batches, read as one table and merged."""
    path = _folder(spark, "node")
    batches = q._node_batches(graph(spark, sf_dir))
    for k in (0, 1):
        sinks.append(batches.where(F.col("ingest_seq") == k), path, "node")
    delete_at_end(spark, path)
    rows = spark.read.schema(NODE).parquet(path)
    return merge.current(rows, "node").drop("ingest_seq").join(rows.groupBy("node_type", "value").agg(F.count(F.lit(1)).alias("n")), ["node_type", "value"])


@query(f"{GRAPH} SELECT type_2, count(*) AS n, sum(id_1)::BIGINT AS ids FROM link WHERE type_1 = 'capture' GROUP BY 1")
def stored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result that is written twice in a row stays once; reading one type of node reads one partition."""
    path = _folder(spark, "link")
    for _ in range(2):
        sinks.replace(graph(spark, sf_dir).link, path)
    delete_at_end(spark, path)
    rows = spark.read.schema(LINK).parquet(path).where("type_1 = 'capture'")
    return rows.groupBy("type_2").agg(F.count(F.lit(1)).alias("n"), F.sum("id_1").alias("ids"))


@query(f"WITH {q._WEEKLY} SELECT 1000 + c AS id_node, epoch(week)::INT AS creation_date, arg_max(rank, seq) AS rank FROM w WHERE strftime(week, '%Y%m') >= '199706' GROUP BY ALL")
def stored_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by month, of which expired months are deleted as a whole."""
    path = _folder(spark, "rank")
    sinks.append(q._weekly(spark, sf_dir), path, "rank")
    delete_at_end(spark, path)
    sinks.drop_months(spark, path, "199706")
    return merge.current(spark.read.schema(RANK).parquet(path), "rank").select("id_node", "creation_date", "rank")


@query(f"{GRAPH} SELECT type_2, id_2, strftime(to_timestamp(min(detection_date)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS first_day, count(*) AS n FROM link WHERE type_1 = 'fqdn' AND type_2 = 'ip' GROUP BY ALL")
def exported_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV export with dates as text, read back."""
    path = _folder(spark, "export")
    rows = graph(spark, sf_dir).link.where("type_1 = 'fqdn' and type_2 = 'ip'").select("type_2", "id_2", F.col("detection_date").alias("first_seen"))
    sinks.export_csv(rows, path)
    delete_at_end(spark, path)
    back = spark.read.option("header", True).schema("type_2 string, id_2 bigint, first_seen string").csv(path)
    return back.groupBy("type_2", "id_2").agg(F.substring(F.min("first_seen"), 1, 10).alias("first_day"), F.count(F.lit(1)).alias("n"))


@query(f"{q.classes()} SELECT status, array_to_string(list_sort(signals), '+') AS signals, least(3, count(*)) AS n FROM cand GROUP BY ALL")
def exported_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample for review, three candidates of each status and combination of signals, exported and read back."""
    path = _folder(spark, "sample")
    sinks.export_sample(explain.sample_candidates(_named_candidates(spark, sf_dir), 3, 1), path)
    delete_at_end(spark, path)
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    return back.groupBy("status", "signals").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- incremental batches

_RECORDS = """rec AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE lower(c_mktsegment) || '.com' END AS v1, CASE WHEN o_orderkey % 13 = 0 THEN lower(c_mktsegment) || '.com' ELSE n_name END AS v2, CASE WHEN o_orderkey % 13 = 0 THEN 'fqdn' WHEN o_orderkey % 17 = 0 THEN 'planet' ELSE 'plugin' END AS t2,
 o_orderkey % 4 AS s, epoch(o_orderdate)::BIGINT AS e, o_orderkey % 5 = 0 AS unread FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
rr AS (SELECT *, CASE WHEN s = 3 THEN 'unknown_source' WHEN t2 = 'planet' THEN 'unknown_type' WHEN v1 = ' ' THEN 'empty_value' WHEN t2 = 'fqdn' AND v1 = v2 THEN 'self_link' END AS reason FROM rec)"""


def _upserted(spark: SparkSession, sf_dir: str) -> tuple:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    o, host = F.col("o_orderkey"), F.concat(F.lower("c_mktsegment"), F.lit(".com"))
    links = rows.select(
        F.when(o % 11 == 0, " ").otherwise(host).alias("value_1"), F.when(o % 13 == 0, host).otherwise(F.col("n_name")).alias("value_2"), F.lit("FQDN").alias("type_1"), F.when(o % 13 == 0, "fqdn").when(o % 17 == 0, "planet").otherwise("Plugin").alias("type_2"),
        F.concat(F.lit("U"), (o % 4).cast("string")).alias("source_uuid"), F.when(o % 5 == 0, "no day").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSXXX")).alias("detection_date"), F.lit(None).cast("string").alias("update_date"),
    )
    none = spark.createDataFrame([], "value string, type string, source_uuid string, payload string, version string, detection_date string, pos bigint")
    source = spark.createDataFrame([("u0", 0), ("u1", 1), ("u2", 2)], "uuid string, id_source int")
    return ingest.upsert_batch(links, none, source, graph(spark, sf_dir).node, NOW)


@query(f"""{GRAPH}, {_RECORDS}, r AS (SELECT 'fqdn' AS type_1, a.id AS id_1, 'plugin' AS type_2, b.id AS id_2, s::INT AS id_source, CASE WHEN unread THEN 1700000000 ELSE e END::INT AS detection_date, 1700000000::BIGINT AS version FROM rr JOIN node a ON a.node_type = 'fqdn' AND a.value = v1 JOIN node b ON b.node_type = 'plugin' AND b.value = v2 WHERE reason IS NULL)
SELECT * FROM r UNION ALL SELECT type_2, id_2, type_1, id_1, id_source, detection_date, version FROM r""")
def upsert_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)[0].drop("ingest_seq")


@query(f"WITH {_RECORDS} SELECT 'link' AS kind, coalesce(reason, CASE WHEN unread THEN 'unread_date' END) AS reason, count(*) AS n FROM rr WHERE reason IS NOT NULL OR unread GROUP BY ALL")
def upsert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)[3]


# ---------------------------------------------------------------- results by name


def _named_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, s = q._steps(spark, sf_dir, domains.Params(max_age_days=100_000))
    return classify.candidate_table(s, q._first_seen(spark, sf_dir), q._NOW)


@query(f"""{q.classes()} SELECT c.id_fqdn, f.value AS fqdn, p.value AS plugin, status, score FROM cand c JOIN f USING (id_fqdn) JOIN node p ON p.node_type = 'plugin' AND p.id = id_plugin""")
def candidate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_candidates(spark, sf_dir).select("id_fqdn", "fqdn", "plugin", "status", "score")


@query(f"""{q.classes()}, pn AS (SELECT id AS p, min(value) AS name FROM node WHERE node_type = 'plugin' GROUP BY 1)
SELECT anchor AS platform, nb_tenants, nb_brand_plugins, coalesce((SELECT list_sort(list(name)) FROM pn WHERE list_contains(plugins, p)), []) AS plugins FROM st WHERE anchor IN (SELECT anchor FROM plat)""")
def platform_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, s = q._steps(spark, sf_dir)
    return classify.platform_table(s, s.plugin).select("platform", "nb_tenants", "nb_brand_plugins", "plugins")


@query(f"""{q._VERDICT} SELECT verdict, vd.host AS fqdn, vd.plugin FROM vd LEFT JOIN cn USING (host, plugin) WHERE (verdict = 'KO') = (cn.id_fqdn IS NOT NULL)""")
def verdict_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q._verdicts(spark, sf_dir)[1]


@query(f"""{q._VERDICT}, j AS (SELECT verdict, signals FROM vd LEFT JOIN cn USING (host, plugin)),
s AS (SELECT 'combination' AS scope, coalesce(array_to_string(list_sort(signals), '+'), 'none') AS signals, verdict FROM j UNION ALL SELECT 'signal', unnest(coalesce(signals, ['none'])), verdict FROM j)
SELECT scope, signals, count(*) FILTER (verdict = 'OK') AS ok, count(*) FILTER (verdict = 'KO') AS ko, count(*) FILTER (verdict = 'OK') / count(*) AS precision FROM s GROUP BY ALL""")
def verdict_by_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q._verdicts(spark, sf_dir)[2]


@query("SELECT user_id AS id_node, event_type AS node_type, (event_id % 3)::INT AS id_source, props AS payload FROM events WHERE event_type = 'click' AND user_id = 7 AND event_id % 3 = 1")
def properties_of_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id_node"), F.col("event_type").alias("node_type"), (F.col("event_id") % 3).cast("int").alias("id_source"), F.col("props").alias("payload"))
    return search.from_source(search.properties_of(rows, "click", 7), 1)


@query(f"{GRAPH} SELECT * FROM link WHERE (type_1, id_1) IN (SELECT 'ip', s_suppkey + 1 FROM supplier WHERE s_nationkey = 3)")
def links_at_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of a list of nodes."""
    keys = table(spark, sf_dir, "supplier").where("s_nationkey = 3").select(F.lit("ip").alias("type_1"), (F.col("s_suppkey") + 1).alias("id_1"))
    return search.at_keys(graph(spark, sf_dir).link, keys, ["type_1", "id_1"]).drop("ingest_seq")


@query(f"""{GRAPH} SELECT type_1 AS pivot_type, id_1, CASE type_1 WHEN 'capture' THEN 'capture_' || substr(sha1(value), 1, 8) ELSE value END AS value FROM (SELECT DISTINCT node_type AS type_1, id AS id_1, value FROM node WHERE node_type IN ('ip', 'capture'))""")
def pseudonymise_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of pivots as a masked report shows them."""
    rows = graph(spark, sf_dir).node.where("node_type in ('ip', 'capture')").select(F.col("node_type").alias("pivot_type"), F.col("id").alias("id_1"), "value").distinct()
    return explain.pseudonymise_values(rows, table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))


_TWICE = """t AS (SELECT * FROM link UNION ALL SELECT type_1, id_1, type_2, id_2, id_source, detection_date - 86400, version + 5 FROM link WHERE type_1 = 'ip' AND id_1 % 2 = 0),
c AS (SELECT type_1, id_1, type_2, id_2, id_source, min(detection_date) AS detection_date, max(version) AS version FROM t GROUP BY ALL)"""


@query(f"""{GRAPH}, {_TWICE} SELECT c.type_1 AS folder, count(*) AS n_rows, sum(detection_date)::BIGINT AS dates, sum(version)::BIGINT AS versions, any_value(x.n) AS first_run, CASE WHEN c.type_1 = 'ip' THEN any_value(y.n) END AS second_run
FROM c JOIN (SELECT type_1, count(*) AS n FROM link GROUP BY 1) x USING (type_1) JOIN (SELECT type_1, count(*) AS n FROM t GROUP BY 1) y USING (type_1) GROUP BY 1""")
def compacted_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links stored, compacted, appended to in one folder and compacted again; what each run read of a folder that it rewrote."""
    link, path = graph(spark, sf_dir).link, _folder(spark, "compacted")
    sinks.append(link, path, "link")
    schema = LINK
    first = merge.compact_changed(spark, path, "link", schema)
    later = link.where("type_1 = 'ip' and id_1 % 2 = 0").withColumns({"detection_date": F.col("detection_date") - 86400, "version": F.col("version") + 5, "ingest_seq": F.lit(1).cast("bigint")})
    sinks.append(later, path, "link")
    second = merge.compact_changed(spark, path, "link", schema)
    for own in (path, path + "-compacted"):
        delete_at_end(spark, own)
    found = spark.read.schema(schema).parquet(path).groupBy(F.col("type_1").alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("detection_date").alias("dates"), F.sum("version").alias("versions"))
    runs = first.select("folder", F.col("rows_before").alias("first_run")).join(second.select("folder", F.col("rows_before").alias("second_run")), "folder", "left")
    return found.join(runs, "folder")


@query(f"""{GRAPH}, n AS (SELECT 'fqdn' AS node_type, 'c' || c_custkey || '.example.org' AS value FROM customer UNION ALL SELECT 'ip', '10.9.' || (s_suppkey // 256) || '.' || (s_suppkey % 256) FROM supplier)
SELECT node_type, count(*) AS n, count(*) AS n_ids, max(id) + 1 AS first_id, max(id) + count(*) AS last_id FROM n JOIN (SELECT node_type, max(id) AS id FROM node GROUP BY 1) USING (node_type) GROUP BY node_type, id""")
def concurrent_id_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads at once, each of half the customers and suppliers, give out different ids without a gap."""
    node, claims = graph(spark, sf_dir).node.drop("rev_value"), _folder(spark, "claims")
    host = table(spark, sf_dir, "customer").select(F.lit("fqdn").alias("node_type"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".example.org")).alias("value"), (F.col("c_custkey") % 2).alias("half"))
    ip = table(spark, sf_dir, "supplier").select(F.lit("ip").alias("node_type"), F.concat(F.lit("10.9."), F.expr("s_suppkey div 256").cast("string"), F.lit("."), (F.col("s_suppkey") % 256).cast("string")).alias("value"), (F.col("s_suppkey") % 2).alias("half"))
    values = host.unionAll(ip)
    load = lambda half: ids.resolve_or_create(values.where(F.col("half") == half), node, NOW, 1, claims)[1]
    with ThreadPoolExecutor(2) as pool:
        first, second = pool.map(load, (0, 1))
    delete_at_end(spark, claims)
    return first.unionByName(second).groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
