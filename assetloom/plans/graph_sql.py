"""SQL for DuckDB of a neighbourhood graph: each level's admission spelled out as common table expressions.

A level's proposals are numbered in order of the frontier, the neighbour's type and its place. A new node comes in at its
first proposal by a node that is no hub, as long as there is room; what came before that proposal isn't drawn.
"""

from __future__ import annotations

N_TYPES = 9


def graph_sql(roots: str, depth: int, per_type: int = 20, hub: int = 500, max_nodes: int = 800, max_edges: int = 2000, banned: tuple[int, ...] = (), totals: str = "SELECT NULL AS matches, NULL AS linked") -> str:
    """Expressions that go on after the graph's; at the end are gn (nodes), ge (edges) and gi (one row of facts).

    roots is a SELECT of (node_type, id, place), totals one of (matches, linked), NULL for the number of roots.
    """
    out_of = ", ".join(map(str, banned)) or "NULL"
    allowed = f"NOT (type_2 = 'plugin' AND coalesce(id_2 IN ({out_of}), false))"
    parts = [
        f"gl AS MATERIALIZED (SELECT * FROM link WHERE {allowed})",
        f"asked AS MATERIALIZED (SELECT * FROM ({roots}) ORDER BY place, node_type, id LIMIT {max_nodes})",
        f"root AS MATERIALIZED (SELECT node_type AS t, id AS i, 0 AS level, min(place) AS seq FROM asked WHERE NOT (node_type = 'plugin' AND coalesce(id IN ({out_of}), false)) GROUP BY ALL)",
        "g0 AS (SELECT * FROM root)",
        "links_of AS MATERIALIZED (SELECT type_1, id_1, count(*) AS n FROM (SELECT DISTINCT type_1, id_1, type_2, id_2 FROM link) GROUP BY ALL)",
    ]
    for level in range(1, depth + 1):
        had, front = f"g{level - 1}", f"(SELECT * FROM g{level - 1} WHERE level = {level - 1})"
        score = f"CASE WHEN n > {hub} THEN 0 ELSE sources * log2(1 + n) END"
        own = "PARTITION BY type_1, id_1, type_2"
        parts += [
            f"near{level} AS MATERIALIZED (SELECT type_1, id_1, type_2, id_2, f.seq AS front, count(DISTINCT id_source) AS sources, min(detection_date) AS first_seen FROM gl JOIN {front} f ON type_1 = t AND id_1 = i GROUP BY ALL)",
            f"pool{level} AS MATERIALIZED (SELECT *, count(*) OVER ({own}) AS degree FROM near{level} QUALIFY row_number() OVER ({own} ORDER BY sources DESC, md5(id_2::VARCHAR), id_2) <= greatest({per_type}, 10000 // greatest(1, (SELECT count(*) FROM {front}) * {N_TYPES})))",
            f"best{level} AS MATERIALIZED (SELECT p.*, row_number() OVER ({own.replace('type_1', 'p.type_1').replace('id_1', 'p.id_1')} ORDER BY round({score}, 9) DESC, sources DESC, first_seen, id_2) AS place FROM pool{level} p JOIN links_of n ON n.type_1 = p.type_2 AND n.id_1 = p.id_2 QUALIFY place <= {per_type})",
            f"hubs{level} AS MATERIALIZED (SELECT type_1 AS t, id_1 AS i, sum(degree) > {hub} AND {level} > 1 AS is_hub, sum(degree) AS links FROM (SELECT DISTINCT type_1, id_1, type_2, degree FROM best{level}) GROUP BY ALL)",
            f"said{level} AS MATERIALIZED (SELECT b.*, is_hub, row_number() OVER (ORDER BY front, type_2, place) AS seq, (type_2, id_2) IN (SELECT t, i FROM {had}) AS present FROM best{level} b JOIN hubs{level} ON type_1 = t AND id_1 = i)",
            f"news{level} AS MATERIALIZED (SELECT type_2 AS t, id_2 AS i, min(seq) AS seq FROM said{level} WHERE NOT present AND NOT is_hub GROUP BY ALL)",
            f"in{level} AS MATERIALIZED (SELECT * FROM news{level} ORDER BY seq LIMIT greatest(0, {max_nodes} - (SELECT count(*) FROM {had})))",
            f"g{level} AS MATERIALIZED (SELECT * FROM {had} UNION ALL SELECT t, i, {level}, seq FROM in{level})",
            f"drawn{level} AS MATERIALIZED (SELECT type_1, id_1, type_2, id_2, sources, first_seen, coalesce(s.seq = n.seq, false) AS tree FROM said{level} s LEFT JOIN in{level} n ON type_2 = t AND id_2 = i WHERE present OR s.seq >= n.seq)",
        ]
    last = f"g{depth}"
    leaf = f"(SELECT * FROM {last} WHERE level = {depth})"
    each = range(1, depth + 1)
    parts += [
        f"leafs AS MATERIALIZED (SELECT type_1, id_1, type_2, id_2, count(DISTINCT id_source) AS sources, min(detection_date) AS first_seen FROM gl JOIN {leaf} ON type_1 = t AND id_1 = i GROUP BY ALL)",
        f"alln AS MATERIALIZED (SELECT t, i, links, is_hub FROM (" + " UNION ALL ".join(f"SELECT * FROM hubs{n}" for n in each) + f" UNION ALL SELECT type_1, id_1, count(*) > {hub}, count(*) FROM leafs GROUP BY ALL))",
        "pairs AS MATERIALIZED (SELECT least(x, y) AS a, greatest(x, y) AS b, sources, first_seen, tree FROM (SELECT {'t': type_1, 'i': id_1} AS x, {'t': type_2, 'i': id_2} AS y, sources, first_seen, tree FROM ("
        + " UNION ALL ".join(f"SELECT * FROM drawn{n}" for n in each)
        + f" UNION ALL SELECT *, false FROM leafs WHERE (type_2, id_2) IN (SELECT t, i FROM {last}))))",
        "one_each AS MATERIALIZED (SELECT a, b, max(sources) AS sources, arg_min(first_seen, (-sources, first_seen)) AS first_seen, bool_or(tree) AS tree FROM pairs GROUP BY ALL)",
        "ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY sources DESC, a, b) AS r FROM one_each)",
        f"ge AS MATERIALIZED (SELECT a.t AS type_1, a.i AS id_1, b.t AS type_2, b.i AS id_2, sources, first_seen, tree FROM ranked WHERE tree OR r <= greatest(0, {max_edges} - (SELECT count(*) FROM ranked WHERE tree)))",
        "shown_ AS MATERIALIZED (SELECT t, i, count(*) AS shown FROM (SELECT type_1 AS t, id_1 AS i FROM ge UNION ALL SELECT type_2, id_2 FROM ge) GROUP BY ALL)",
        "gn AS (SELECT t AS node_type, i AS id, level, coalesce(min(v.value), '<' || t || ' ' || i || ' without value>') AS value, max(v.rank) AS rank, coalesce(any_value(links), 0)::BIGINT AS degree, coalesce(any_value(is_hub), false) AS hub, coalesce(any_value(shown), 0)::BIGINT AS shown "
        f"FROM {last} LEFT JOIN alln USING (t, i) LEFT JOIN shown_ USING (t, i) LEFT JOIN node v ON v.node_type = t AND v.id = i GROUP BY t, i, level)",
        f"gi AS (SELECT coalesce(matches, (SELECT count(*) FROM root))::BIGINT AS matches, coalesce(linked, (SELECT count(*) FROM root))::BIGINT AS linked, ("
        + " OR ".join(f"(SELECT count(*) FROM news{n}) > (SELECT count(*) FROM in{n})" for n in each)
        + f") AS truncated, (SELECT count(*) FILTER (hub) FROM gn) AS hubs, ((SELECT count(*) FROM one_each) - (SELECT count(*) FROM ge)) AS dropped_edges, (SELECT count(*) > 0 FROM asked WHERE node_type = 'plugin' AND coalesce(id IN ({out_of}), false)) AS blacklisted FROM ({totals}))",
    ]
    return ", ".join(parts)
