"""Steps whose rows a task grew faster than the tables, or more than a task can hold."""

import datetime
from collections import defaultdict

import pytest

from assetloom.operators import classify
from assetloom.operators import neighbourhood as nb
from assetloom.operators.domains import Params
from assetloom.plans import derived


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("params", [Params(), Params(min_purity=0.3, guard_purity=0.2, min_votes=2), Params(max_degree=6, min_votes=1, min_purity=0.0)])
def test_signals_equal_each_host_judged_by_itself(spark, params):
    ends = [("ip", p, h) for p in range(12) for h in range(60) if (h * 7 + p * 3) % 12 < 2 + p % 4 or (p == 3 and h == 50)]
    pairs = [(h, g) for h in range(60) for g in range(5) if (h * 5 + g * 11) % 7 == 0 or (h % 10 < 8 and g == h % 2)]
    direct = [("ip", 1, 4), ("ip", 2, 0), ("ip", 5, 3)]
    rows = [("ip", p, "fqdn", h) for _, p, h in ends] + [("plugin", g, "ip", p) for _, p, g in direct]
    rows = rows + [(c, d, a, b) for a, b, c, d in rows]
    link = spark.createDataFrame(rows, "type_1 string, id_1 bigint, type_2 string, id_2 bigint")
    classified = spark.createDataFrame(pairs, "id_fqdn bigint, id_plugin bigint")
    labels = classify.pivot_labels(link, classified, params).cache()
    own, want = defaultdict(set), defaultdict(set)
    for h, g in pairs:
        own[h].add(g)
    near = defaultdict(list)
    for _, p, h in ends:
        near[p].append(h)
    for r in labels.where("pivot_type = 'ip'").collect():
        for h in near[r.id_pivot]:
            rest = max(r.total - len(own[h]), 0)
            purity = 1.0 if rest == 0 else r.n / rest
            votes = (r.direct and (rest == 0 or purity >= params.guard_purity)) or (r.n >= params.min_votes and purity >= params.min_purity)
            if votes and r.id_plugin not in own[h]:
                want[h, r.id_plugin].add(r.id_pivot)
    got = classify.pivot_signals(link, labels, classified, params)
    assert {(r.id_fqdn, r.id_plugin): r.nb_pivots for r in got.where("signal = 'ip'").collect()} == {k: len(v) for k, v in want.items()}


def test_links_are_not_copied_for_each_label(spark):
    hosts = range(1, 41)
    link = spark.createDataFrame([("ip", p, "fqdn", h) for p in range(6) for h in hosts] + [("fqdn", h, "ip", p) for p in range(6) for h in hosts], "type_1 string, id_1 bigint, type_2 string, id_2 bigint")
    classified = spark.createDataFrame([(h, h % 8) for h in hosts], "id_fqdn bigint, id_plugin bigint")
    labels = classify.pivot_labels(link, classified)
    assert labels.where("pivot_type = 'ip'").count() == 48  # eight plugins a pivot, none of them pure enough
    assert classify._possible(labels, classify.domains.own_plugins(classified), Params()).where("pivot_type = 'ip'").count() == 0
    lines = plan(classify.pivot_signals(link, labels, classified)).splitlines()
    at = [next(i for i, x in enumerate(lines) if word in x) for word in ("Generate explode", "Join")]
    assert at[0] < at[1]  # votes are spread above all joins


def test_links_are_dealt_before_they_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(nb, "ROWS_OF_A_TASK", 100)
    link = spark.range(4000).selectExpr("'ip' type_1", "id % 40 id_1", "'fqdn' type_2", "id % 50 id_2", "cast(id % 3 as int) id_source", "cast(id as int) detection_date")
    back = link.selectExpr("type_2 type_1", "id_2 id_1", "type_1 type_2", "id_1 id_2", "id_source", "detection_date")
    link = link.union(back)
    front = link.select("type_1", "id_1").distinct()
    assert nb.parts_for(link) == 80
    found = {}
    for parts in (None, nb.parts_for(link)):
        _, near = nb.leaf_links(front, link, front.toDF("node_type", "id"), parts=parts)
        edges = nb.unordered(near.selectExpr("*", "id_1 % 10 = 0 tree"), parts)
        found[parts] = sorted(map(tuple, edges.collect()))
        assert "SortAggregate" not in edges._jdf.queryExecution().executedPlan().toString()
    assert found[None] == found[80] and len(found[80]) == 200


def test_most_seen_row_of_a_pair(spark):
    rows = [("a", 1, "b", 2, 3, 50, False), ("b", 2, "a", 1, 3, -7, False), ("a", 1, "b", 2, 2, -90, True), ("a", 1, "b", 3, 1, None, False), ("b", 3, "a", 1, 1, 2147483647, False), ("a", 2, "b", 3, 9, None, False)]
    df = spark.createDataFrame(rows, "type_1 string, id_1 bigint, type_2 string, id_2 bigint, sources bigint, first_seen int, tree boolean")
    assert sorted(map(tuple, nb.unordered(df).collect())) == [("a", 1, "b", 2, 3, -7, True), ("a", 1, "b", 3, 1, 2147483647, False), ("a", 2, "b", 3, 9, None, False)]


def test_tenants_and_platforms_read_no_pivots(spark, monkeypatch):
    def never(*_):
        raise AssertionError("pivots were read")

    monkeypatch.setattr(classify, "pivot_labels", never)
    monkeypatch.setattr(classify, "pivot_signals", never)
    hosts = {1: "big.com", 2: "acme.com", 3: "bolt.com", 4: "acme.big.com", 5: "bolt.big.com"}
    node = [("fqdn", v, i, None) for i, v in hosts.items()] + [("plugin", f"p{i}", i, None) for i in (100, 101, 102)]
    link = [("plugin", 99 + i, "fqdn", i) for i in (1, 2, 3)] + [("ip", 7, "fqdn", i) for i in hosts]
    node = spark.createDataFrame(node, "node_type string, value string, id bigint, rank int")
    link = spark.createDataFrame(link + [(c, d, a, b) for a, b, c, d in link], "type_1 string, id_1 bigint, type_2 string, id_2 bigint")
    s = classify.steps(node, link, classify.domains.suffix_rules(spark), Params(platform_plugins=2, platform_diversity=0.1))
    assert sorted((r.fqdn, *r.plugins_proposes) for r in classify.tenant_table(s).collect()) == [("acme.big.com", "p101"), ("bolt.big.com", "p102")]
    assert [(r.platform, *r.plugins) for r in classify.platform_table(s, s.plugin).collect()] == [("big.com", "p100")]
    assert sorted((r.id_fqdn, r.id_plugin) for r in s.tenant.collect()) == [(4, 101), (5, 102)]


def test_known_hosts_are_one_row_before_a_join(spark):
    link = spark.createDataFrame([("fqdn", h, "ip", p) for h in range(1, 6) for p in range(50)], "type_1 string, id_1 bigint, type_2 string, id_2 bigint")
    rows = [(1, "non_classe", 0), (2, "non_classe", 0), (5, "conflit", 0), (8, "non_classe", 0), (9, "non_classe", 1)]
    cand = spark.createDataFrame(rows, "id_fqdn bigint, status string, nb_pivots bigint")
    first = spark.createDataFrame([("fqdn", 2, 0)], "node_type string, id_node bigint, detection_date int")
    rank = spark.createDataFrame([("fqdn", 8)] * 3, "node_type string, id_node bigint")
    for more, kept in ((None, {1, 5, 9}), (rank, {1, 5, 8, 9})):
        out = classify.dated(cand, link, first, more, datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC))
        assert {r.id_fqdn for r in out.where("keep").collect()} == kept and out.count() == 5
        lines = plan(out).splitlines()
        at = next(i for i, x in enumerate(lines) if "Aggregate" in x and "type_1" not in x and "min(" not in x)
        assert not any("Join" in x for x in lines[at:])  # the links under it meet no other table


def test_order_lines_of_the_derived_graph_are_joined_once(spark, sf_dir):
    lines = plan(derived.derived(spark, sf_dir).link).splitlines()
    assert sum("Relation" in x and "l_orderkey" in x for x in lines) == 1
