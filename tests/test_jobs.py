"""Whole jobs on a small graph: results, explanations, samples and display."""

import datetime

import pytest
from pyspark.sql import functions as F

from assetloom.operators import classify, domains, explain, neighbourhood, search
from assetloom.operators.domains import Params

NODE = "node_type string, value string, id bigint, rank int, version bigint, ingest_seq bigint"
LINK = "type_1 string, id_1 bigint, type_2 string, id_2 bigint, id_source int, detection_date int, version bigint, ingest_seq bigint"
NOW = datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC)
PARAMS = Params(platform_plugins=2, platform_diversity=0.1)


@pytest.fixture(scope="module")
def tables(spark):
    hosts = {1: "zendesk.com", 2: "monapp.com", 3: "other.com", 4: "monapp.zendesk.com", 5: "other.zendesk.com", 6: "www.zendesk.com", 7: "lone.org", 8: "peer1.net", 9: "peer2.net", 10: "peer3.net"}
    node = [("fqdn", v, i, None, 0, 0) for i, v in hosts.items()] + [("plugin", f"plug{i}", i, None, 0, 0) for i in range(100, 105)] + [("capture", "cap", 50, None, 0, 0)]
    one = [("plugin", 100, "fqdn", 1), ("plugin", 101, "fqdn", 2), ("plugin", 102, "fqdn", 3), ("plugin", 103, "fqdn", 8), ("plugin", 103, "fqdn", 9), ("plugin", 103, "fqdn", 10)]
    one += [("capture", 50, "fqdn", i) for i in (7, 8, 9, 10, 4)]
    link = [(a, i, b, j, 0, 1, 0, 0) for a, i, b, j in one] + [(b, j, a, i, 0, 1, 0, 0) for a, i, b, j in one]
    return spark.createDataFrame(node, NODE), spark.createDataFrame(link, LINK)


@pytest.fixture(scope="module")
def results(spark, tables):
    property_ = spark.createDataFrame([], "node_type string, id_node bigint, id_source int, detection_date int")
    return [df.cache() for df in classify.find_misclassified(*tables, property_, domains.suffix_rules(spark), NOW, params=PARAMS)]


def test_results(results):
    candidate, tenant, platform = results
    assert {(r.fqdn, r.plugin, r.status, r.score, tuple(r.signals)) for r in candidate.collect()} == {("lone.org", "plug103", "non_classe", 2, ("capture",)), ("monapp.zendesk.com", "plug103", "non_classe", 2, ("capture",))}
    assert {(r.fqdn, r.tenant, tuple(r.plugins_proposes), r.domaine_marque) for r in tenant.collect()} == {("monapp.zendesk.com", "monapp", ("plug101",), "monapp.com"), ("other.zendesk.com", "other", ("plug102",), "other.com")}
    assert [(r.platform, list(r.plugins), r.nb_tenants, r.nb_brand_plugins) for r in platform.collect()] == [("zendesk.com", ["plug100"], 2, 2)]
    assert [r.fqdn for r in classify.by_plugin(candidate, "plug103").collect()] == ["lone.org", "monapp.zendesk.com"]
    assert [r.tenant for r in classify.by_platform(tenant, "zendesk.com").collect()] == ["monapp", "other"]


def test_explanations_of_many_pairs(spark, tables, results):
    node, link = tables
    s = classify.steps(node, link, domains.suffix_rules(spark), PARAMS)
    pairs = spark.createDataFrame([(7, 103), (4, 103), (4, 101)], "id_fqdn bigint, id_plugin bigint")
    got = {(r.id_fqdn, r.id_plugin): r for r in explain.explain_pairs(pairs, s, results[0]).collect()}
    assert got[(7, 103)].proposed and got[(7, 103)].anchor is None and not got[(4, 101)].proposed
    assert got[(4, 103)].anchor == "zendesk.com" and got[(4, 103)].is_platform and got[(4, 103)].tenant == "monapp"
    pivots = explain.explain_pivots(pairs, link, PARAMS)
    own = pivots.where("id_fqdn = 7").collect()
    assert [(r.pivot_type, r.id_pivot, r.degree, r.id_plugin, r.n, r.total, r.kept) for r in own] == [("capture", 50, 5, 103, 3, 3, True)]
    assert [(t.id_plugin, t.n) for t in own[0].top] == [(103, 3)]
    assert explain.pivot_detail(pivots, pairs).count() == 2
    few = explain.explain_pivots(pairs, link, Params(max_degree=2)).where("id_fqdn = 7").collect()
    assert [(r.degree, r.id_plugin, r.kept) for r in few] == [(5, None, False)]
    tenant = s.signals.where("signal = 'tenant'").select("id_fqdn", "id_plugin")
    best = explain.competition(pivots, s.classified, s.anc, tenant, PARAMS).where("id_fqdn = 4").collect()
    assert [(r.id_plugin, r.score, r.place, r.tie) for r in best] == [(103, 2, 1, False)]


def test_samples_and_verdicts(spark, results):
    sample = explain.sample_candidates(results[0], 1, 3)
    assert sample.count() == 1 and sample.columns[-2:] == ["verdict", "commentaire"]
    verdicts = explain.clean_verdicts(spark.createDataFrame([(" lone.org", "plug103", "ok", None), ("monapp.zendesk.com", "plug103", "KO ", ""), ("gone.com", "plug1", "OK", ""), ("", "x", "OK", "")], "fqdn string, plugin string, verdict string, commentaire string"))
    totals, changed, by_signal = explain.verdict_report(verdicts, results[0])
    assert {(r.verdict, r.judged, r.still, r.gone, r.precision) for r in totals.collect()} == {("OK", 2, 1, 1, 0.5), ("KO", 1, 1, 0, 0.5)}
    assert {(r.verdict, r.fqdn) for r in changed.collect()} == {("KO", "monapp.zendesk.com"), ("OK", "gone.com")}
    assert ("signal", "capture", 1, 1, 0.5) in {tuple(r) for r in by_signal.collect()}
    assert explain.mapping_table(spark.createDataFrame([("A",), ("a",), ("a",)], "name string")).count() == 2
    assert explain.judged_pairs(verdicts).count() == 3
    blank = verdicts.withColumn("verdict", F.lit(""))
    assert explain.judged_pairs(blank).count() == 3


def test_display_and_exclusion(spark, tables):
    node, link = tables
    roots = spark.createDataFrame([("fqdn", 7, 0)], "node_type string, id bigint, place bigint")
    banned = spark.createDataFrame([(103,)], "id bigint")
    nodes, edges, info = neighbourhood.build_graph(node, link, roots, 2, banned=banned)
    assert info == {"roots": [("fqdn", 7)], "matches": 1, "linked": 1, "truncated": False, "hubs": 0, "dropped_edges": 0, "blacklisted": False}
    assert {r.value: r.degrees for r in nodes.collect()}["cap"] == {"fqdn": 5} and nodes.where("value = 'cap'").first().degree == 5
    gone, none, info = neighbourhood.build_graph(node, link, spark.createDataFrame([("plugin", 103, 0)], "node_type string, id bigint, place bigint"), 2, banned=banned, matches=(9, 4))
    assert gone.count() == none.count() == 0 and info["blacklisted"] and (info["matches"], info["linked"], info["roots"]) == (9, 4, [])
    assert {r.value for r in nodes.collect()} == {"lone.org", "cap", "peer1.net", "peer2.net", "peer3.net", "monapp.zendesk.com"}
    shown, drawn = neighbourhood.display_facts(nodes, edges, top=1)
    assert shown.where("labelled").count() == 1 and shown.first().level == 0 and {r.width for r in drawn.collect()} == {1.0}
    assert search.at_keys(link, spark.createDataFrame([("capture", 50)], "type_1 string, id_1 bigint"), ["type_1", "id_1"]).count() == 5
    assert search.from_source(link, 0).count() == link.count() and search.trigram_search(node.select("id", "value"), search.trigrams(node.select("id", "value")), "zendesk").count() == 4
    assert neighbourhood.neighbours(spark.createDataFrame([("fqdn", 7)], "type_1 string, id_1 bigint"), link, link, kind="exclusive").select(F.round("score", 6)).first()[0] == round(1 / 2.584962500721156, 6)
