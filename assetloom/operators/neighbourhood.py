"""Bounded neighbourhood graphs around one or more nodes."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import NODE_TYPES, RANKED
from .search import without_plugins
from .stable import stable

# Candidates looked at for a frontier, links that a task groups, and what stands for a node whose value is missing.
POOL_BUDGET = 10_000
ROWS_OF_A_TASK = 500_000
NAMELESS = "<{} {} without value>"


def _hash(column: str) -> Column:
    return F.md5(F.col(column).cast("string").cast("binary"))


_OWN = ["type_1", "id_1", "type_2"]


def _seen(frontier: DataFrame, link: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(type_1, id_1, type_2, id_2, sources, first_seen): all neighbours, keyed by both ends, so a hub's are dealt over tasks."""
    near = link.where(F.col("type_2").isin(*types)).join(frontier.select("type_1", "id_1"), ["type_1", "id_1"], "left_semi")
    return near.groupBy("type_1", "id_1", "type_2", "id_2").agg(F.count_distinct("id_source").alias("sources"), F.min("detection_date").alias("first_seen"))


def _degrees(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_OWN).agg(F.count(F.lit(1)).alias("degree"))


def _pooled(rows: DataFrame, pool: int, parts: int = 64) -> DataFrame:
    """The pool most seen neighbours of each node and type, ties by hash.

    In two steps: a hub's neighbours are dealt over parts by hash, each part keeps pool of them (Spark drops others before
    the shuffle), and the last choice is among parts * pool rows at most.
    """
    order = [F.desc("sources"), _hash("id_2"), "id_2"]
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("id_2"), F.lit(parts)))
    some = dealt.withColumn("_n", F.row_number().over(Window.partitionBy(*_OWN, "_part").orderBy(*order))).where(F.col("_n") <= pool)
    return some.withColumn("_n", F.row_number().over(Window.partitionBy(*_OWN).orderBy(*order))).where(F.col("_n") <= pool).drop("_n", "_part")


def neighbour_candidates(frontier: DataFrame, link: DataFrame, types: tuple[str, ...] = NODE_TYPES, pool: int | None = POOL_BUDGET) -> DataFrame:
    """(type_1, id_1, type_2, id_2, sources, first_seen, degree): the pool most seen neighbours of each node and type (all if pool is None); degree counts all."""
    rows = _seen(frontier, link, types)
    return (rows if pool is None else _pooled(rows, pool)).join(_degrees(rows), _OWN)


def priority(kind: str, hub: int) -> Column:
    """Score of a neighbour by its sources and number of links n: linked elsewhere, exclusive, or most seen."""
    log = F.log2(1 + F.col("n"))
    return {
        "linked": F.when(F.col("n") > hub, 0.0).otherwise(F.col("sources") * log),
        "exclusive": F.col("sources") / F.log2(1 + F.greatest("n", F.lit(1))),
        "sources": F.col("sources").cast("double"),
    }[kind]


def neighbours(frontier: DataFrame, link: DataFrame, all_links: DataFrame, k: int = 20, hub: int = 500, kind: str = "linked", types: tuple[str, ...] = NODE_TYPES, pool: int | None = POOL_BUDGET) -> DataFrame:
    """The k best neighbours of each node and type with degree, n (own links, by all_links) and score.

    Degrees are one aggregation, joined to the k rows that are left of a node, so no task sees a whole hub.
    """
    rows = stable(_seen(frontier, link, types))
    cand = rows if pool is None else stable(_pooled(rows, max(k, pool)))
    return _best(cand, all_links, k, hub, kind).join(_degrees(rows), _OWN).select(*_BEST)


_BEST = ["type_1", "id_1", "type_2", "id_2", "sources", "first_seen", "degree", "n", "score", "place"]


def _best(cand: DataFrame, all_links: DataFrame, k: int, hub: int, kind: str) -> DataFrame:
    """The k best of the candidates by priority, with n, score and place; a degree that they have goes along."""
    ends = cand.select(F.col("type_2").alias("type_1"), F.col("id_2").alias("id_1")).distinct()
    n = all_links.join(ends, ["type_1", "id_1"], "left_semi").select("type_1", "id_1", "type_2", "id_2").distinct().groupBy(F.col("type_1").alias("type_2"), F.col("id_1").alias("id_2")).agg(F.count(F.lit(1)).alias("n"))
    rows = cand.join(n, ["type_2", "id_2"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("score", priority(kind, hub))
    own = Window.partitionBy(*_OWN).orderBy(F.desc("score"), F.desc("sources"), "first_seen", "id_2")
    rows = rows.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k)
    return rows.select(*[c for c in _BEST if c in rows.columns])


def parts_for(link: DataFrame) -> int:
    """In how many parts a stored table of links is dealt, so that a task holds about ROWS_OF_A_TASK of them, whatever its size."""
    return max(int(link.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-link.count() // ROWS_OF_A_TASK))


def _dealt(rows: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    return rows if parts is None else rows.repartition(parts, *keys)


def leaf_links(leaves: DataFrame, link: DataFrame, inside: DataFrame, types: tuple[str, ...] = NODE_TYPES, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(degrees, links) of leaves: degree by neighbour type, and links to nodes inside with sources and first_seen.

    Given parts (parts_for), for leaves that are many, every step is dealt over so many tasks, and links are dealt by both ends before
    they are grouped: stored links are so small that a task which groups what it reads would hold tens of millions.
    """
    near = link.where(F.col("type_2").isin(*types)).join(_dealt(leaves.select("type_1", "id_1"), parts, "type_1", "id_1"), ["type_1", "id_1"], "left_semi")
    near = _dealt(near.select("type_1", "id_1", "type_2", "id_2", "id_source", "detection_date"), parts, "type_1", "id_1", "type_2", "id_2")
    rows = near.groupBy("type_1", "id_1", "type_2", "id_2").agg(F.count_distinct("id_source").alias("sources"), F.min("detection_date").alias("first_seen"))
    degrees = rows.groupBy("type_1", "id_1", "type_2").agg(F.count(F.lit(1)).alias("degree"))
    ends = inside.select(F.col("node_type").alias("type_2"), F.col("id").alias("id_2"))
    return degrees, rows.join(_dealt(ends, parts, "type_2", "id_2"), ["type_2", "id_2"], "left_semi")


def unordered(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """One row a pair of nodes in either order: the sources and date of the most seen row, and whether any is of the tree. parts as in leaf_links."""
    a, b = F.struct(F.col("type_1").alias("t"), F.col("id_1").alias("i")), F.struct(F.col("type_2").alias("t"), F.col("id_2").alias("i"))
    rows = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "sources", "first_seen", "tree")
    # most sources, then the first date, in one number, so that the aggregation needs no sort; no date comes last
    wide = lambda n: F.lit(n).cast("decimal(18,0)")
    date = F.coalesce((1 << 31) - F.col("first_seen").cast("bigint"), F.lit(0)).cast("decimal(18,0)")
    best = F.max(F.col("sources").cast("decimal(19,0)") * wide(1 << 33) + date)
    rows = _dealt(rows, parts, "a", "b").groupBy("a", "b").agg(best.alias("x"), F.max("tree").alias("tree"))
    date = F.pmod("x", wide(1 << 33)).cast("bigint")
    rows = rows.withColumns({"sources": F.floor((F.col("x") - F.pmod("x", wide(1 << 33))) / wide(1 << 33)).cast("bigint"), "first_seen": F.when(date > 0, (1 << 31) - date).cast("int")})
    return rows.select(F.col("a.t").alias("type_1"), F.col("a.i").alias("id_1"), F.col("b.t").alias("type_2"), F.col("b.i").alias("id_2"), "sources", "first_seen", "tree")


def within_budget(edges: DataFrame, max_edges: int) -> tuple[DataFrame, int]:
    """All tree edges and the most seen others up to max_edges in all, and how many were dropped."""
    tree, other = edges.where("tree"), edges.where("not tree")
    n_tree, n_other = tree.count(), other.count()
    room = max(0, max_edges - n_tree)
    if n_other <= room:
        return edges, 0
    first = other.orderBy(F.desc("sources"), "type_1", "id_1", "type_2", "id_2").limit(room)
    return tree.unionByName(first), n_other - room


@dataclass
class _Node:
    level: int
    seq: int
    degree: dict[str, int] = field(default_factory=dict)
    hub: bool = False
    shown: int = 0

    def links(self) -> int:
        return sum(self.degree.values())


_Key = tuple[str, int]
_ENDS = [("type_1", pa.string()), ("id_1", pa.int64()), ("type_2", pa.string()), ("id_2", pa.int64())]
_EDGE = pa.schema([*_ENDS, ("sources", pa.int64()), ("first_seen", pa.int32()), ("tree", pa.bool_())])
_NODE = pa.schema(
    [("node_type", pa.string()), ("id", pa.int64()), ("level", pa.int32()), ("value", pa.string()), ("rank", pa.int32()), ("degree", pa.int64()), ("degrees", pa.map_(pa.string(), pa.int64())), ("hub", pa.bool_()), ("shown", pa.int64())]
)


def _local(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """Rows of the driver as a table that no Python worker has to read."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


def _of(link: DataFrame, keys: list[_Key]) -> DataFrame:
    """The links of some nodes, by conditions that reach the scan: partitions by type, row groups by id."""
    by: dict[str, list[int]] = {}
    for kind, i in keys:
        by.setdefault(kind, []).append(i)
    wanted = F.lit(False)
    for kind, own in sorted(by.items()):
        wanted = wanted | ((F.col("type_1") == kind) & F.col("id_1").isin(own))
    return link.where(wanted)


def _keys(spark: SparkSession, keys: list[_Key], kind: str, number: str) -> DataFrame:
    return F.broadcast(_local(spark, keys, pa.schema([(kind, pa.string()), (number, pa.int64())])))


def _admit(graph: dict[_Key, _Node], found: list[Row], level: int, max_nodes: int) -> tuple[list[tuple], bool]:
    """Take in the neighbours found at a level, and say which edges are drawn and whether a node found no room.

    Rows come in order of the frontier, type, score and so on. A new node's first row is its tree edge; rows
    before that one, which then come from hubs, aren't drawn.
    """
    edges, first, full = [], {}, False
    present = set(graph)
    for seq, r in enumerate(found, 1):
        source, end = graph[r.type_1, r.id_1], (r.type_2, r.id_2)
        if end not in present and end not in first and not source.hub:
            if len(graph) < max_nodes:
                graph[end] = _Node(level, seq)
                first[end] = seq
            else:
                full = True
        if end in present or end in first:
            edges.append((r.type_1, r.id_1, r.type_2, r.id_2, r.sources, r.first_seen, first.get(end) == seq))
    return edges, full


def build_graph(
    node: DataFrame, link: DataFrame, roots: DataFrame, depth: int = 2, per_type: int = 20, hub: int = 500, max_nodes: int = 800, types: tuple[str, ...] = NODE_TYPES,
    close_leaves: bool = True, max_edges: int = 2000, kind: str = "linked", banned: DataFrame | None = None, matches: tuple[int, int] | None = None,
) -> tuple[DataFrame, DataFrame, dict]:
    """(nodes, edges, info) around the roots (node_type, id, place), level by level.

    nodes: node_type, id, level, value, rank, degree, degrees (by type of neighbour), hub, shown. edges: both ends,
    sources, first_seen, tree. info: roots, matches and linked (those given, as find_roots counts them, or else
    the number of roots), truncated, hubs, dropped_edges, blacklisted (whether a root was banned).
    A node beyond the roots with more than hub neighbours adds no new node; at most max_nodes nodes come in, in
    order of the frontier and then of its neighbours.

    The graph being built is held by the driver, bounded by max_nodes: a level costs two jobs over the links, each
    with the frontier or its candidates as the small side. A level's candidates are POOL_BUDGET rows, or per_type
    for each node and type if those are more; the last job's links join nodes of the graph only.
    """
    spark = node.sparkSession
    links = without_plugins(link, banned) if banned is not None else link
    given = [r for r in roots.select("node_type", "id", "place").orderBy("place", "node_type", "id").limit(max_nodes).collect()]
    out = set()
    if banned is not None and any(r.node_type == "plugin" for r in given):
        asked = _keys(spark, [(r.node_type, r.id) for r in given if r.node_type == "plugin"], "kind", "id")
        out = {("plugin", r.id) for r in banned.join(asked, "id", "left_semi").select("id").distinct().collect()}
    graph: dict[_Key, _Node] = {}
    for i, r in enumerate(given):
        if (r.node_type, r.id) not in out:
            graph.setdefault((r.node_type, r.id), _Node(0, i))
    n_roots, edges, truncated, level = len(graph), [], False, 0
    for level in range(1, depth + 1):
        front = sorted((k for k, x in graph.items() if x.level == level - 1), key=lambda k: graph[k].seq)
        if not front:
            break
        f = _keys(spark, front, "type_1", "id_1")
        pool = max(per_type, POOL_BUDGET // (len(front) * max(len(types), 1)))
        cand = spark.createDataFrame(neighbour_candidates(f, _of(links, front), types, pool).toArrow())
        found = _best(cand, link, per_type, hub, kind).collect()
        for r in found:
            graph[r.type_1, r.id_1].degree[r.type_2] = r.degree
        for k in front:
            graph[k].hub = level > 1 and graph[k].links() > hub
        found.sort(key=lambda r: (graph[r.type_1, r.id_1].seq, r.type_2, r.place))
        drawn, full = _admit(graph, found, level, max_nodes)
        edges, truncated = edges + drawn, truncated or full
    leaves = [k for k, x in graph.items() if x.level == level] if depth > 0 else []
    if leaves:
        degrees, inner = leaf_links(_keys(spark, leaves, "type_1", "id_1"), _of(links, leaves), _keys(spark, list(graph), "node_type", "id"), types)
        for r in degrees.collect():
            graph[r.type_1, r.id_1].degree[r.type_2] = r.degree
        for k in leaves:
            graph[k].hub = graph[k].links() > hub
        if close_leaves:
            edges += [(r.type_1, r.id_1, r.type_2, r.id_2, r.sources, r.first_seen, False) for r in inner.collect()]
    drawn = _undirected(edges)
    tree, other = [e for e in drawn if e[6]], sorted((e for e in drawn if not e[6]), key=lambda e: (-e[4], *e[:4]))
    room = max(0, max_edges - len(tree))
    drawn = tree + other[:room]
    for e in drawn:
        graph[e[:2]].shown += 1
        graph[e[2:4]].shown += 1
    all_ = _keys(spark, list(graph), "node_type", "id")
    last_rank = F.max_by(F.when(F.col("rank").isNotNull(), F.col("rank")), F.when(F.col("rank").isNotNull(), F.col("ingest_seq")))
    values = node.join(all_, ["node_type", "id"], "left_semi").groupBy("node_type", "id").agg(F.min("value").alias("value"), F.when(F.col("node_type").isin(*RANKED), last_rank).alias("rank"))
    named = {(r.node_type, r.id): (r.value, r["rank"]) for r in values.collect()}
    rows = []
    for k, x in graph.items():
        value, rank = named.get(k, (None, None))
        rows.append((*k, x.level, value if value is not None else NAMELESS.format(*k), rank, x.links(), list(x.degree.items()), x.hub, x.shown))
    n_matches, n_linked = matches or (n_roots, n_roots)
    info = {"roots": list(graph)[:n_roots], "matches": n_matches, "linked": n_linked, "truncated": truncated, "hubs": sum(x.hub for x in graph.values()), "dropped_edges": max(0, len(other) - room), "blacklisted": bool(out)}
    return _local(spark, rows, _NODE), _local(spark, drawn, _EDGE), info


def _undirected(edges: list[tuple]) -> list[tuple]:
    """One edge a pair of nodes, as unordered() makes them of tables."""
    best: dict[tuple, tuple] = {}
    for t1, i1, t2, i2, sources, first_seen, tree in edges:
        a, b = sorted(((t1, i1), (t2, i2)))
        had = best.get((a, b))
        seen = (sources, -first_seen) if first_seen is not None else (sources, -(1 << 40))
        best[a, b] = (max(seen, had[0]) if had else seen, tree or bool(had and had[1]))
    return [(*a, *b, seen[0], None if seen[1] == -(1 << 40) else -seen[1], tree) for (a, b), (seen, tree) in best.items()]


def display_facts(nodes: DataFrame, edges: DataFrame, weight: str = "degree", top: int = 25) -> tuple[DataFrame, DataFrame]:
    """nodes with size (log of the weight) and labelled (whether among the top by weight), and edges with width."""
    place = F.row_number().over(Window.orderBy(F.desc(weight), "node_type", "id"))
    return nodes.withColumns({"size": F.log1p(weight), "labelled": place <= top}).orderBy("level", F.desc(weight), "node_type", "value"), edges.withColumn("width", 1 + F.log2("sources"))
