"""Golden rows of single rules."""

import datetime
import hashlib
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from assetloom.functions import scalars
from assetloom.operators import classify, domains, explain, ids, ingest, merge, neighbourhood, normalize, ranks, search
from assetloom.operators.domains import Params

NODE = "node_type string, value string, id bigint, rank int, version bigint, ingest_seq bigint"
LINK = "type_1 string, id_1 bigint, type_2 string, id_2 bigint, id_source int, detection_date int, version bigint, ingest_seq bigint"

VALUES = {
    " Netflix.COM. ": ("fqdn", "netflix.com"), "2001:DB8:0::1": ("ip", "2001:db8::1"), "10.0.0.1": ("ip", "10.0.0.1"), "192.168.0.1": ("ip", "192.168.0.1"),
    "*.x.com": ("x_wildcard", "*.x.com"), "localhost": ("x_invalid", "localhost"), "a b.com": ("x_invalid", "a b.com"), "admin@x.com": ("x_invalid", "admin@x.com"),
    "x.com/path": ("x_invalid", "x.com/path"), "CN=foo.com": ("x_invalid", "cn=foo.com"), "999.1.1.1": ("x_invalid", "999.1.1.1"), "01.2.3.4": ("x_invalid", "01.2.3.4"),
    "fe80::1%eth0": ("x_invalid", "fe80::1%eth0"), "bücher.example": ("fqdn", "bücher.example"), "": ("", ""), None: ("", ""), "a:b": ("x_invalid", "a:b"),
    "x" * 64 + ".com": ("x_invalid", "x" * 64 + ".com"), ".".join(["abcdefghi"] * 26): ("x_invalid", ".".join(["abcdefghi"] * 26)),
} | {v: ("x_nonroutable", v) for v in ("127.0.0.1", "0.1.2.3", "169.254.1.1", "224.0.0.1", "255.255.255.255", "::", "::1", "fe80::1", "ff02::1", "::ffff:127.0.0.1")}


def test_classify_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", scalars.classify(F.col("v")).alias("k"))
    assert {r.v: (r.k.kind, r.k.value) for r in df.collect()} == VALUES
    loose = spark.createDataFrame([("127.0.0.1",), ("::1",)], "v string").select(scalars.classify(F.col("v"), False)["kind"].alias("k"))
    assert [r.k for r in loose.collect()] == ["ip", "ip"]


def test_ipv6_equals_the_standard_library(spark):
    rng = random.Random(4)
    texts = ["1::", "::", "1:2:3:4:5:6:7::", "1::2:3:4:5:6:7:8", "::1.2.3.4", "::ffff:8.8.8.8", "1:::2", ":", "1::2::3", "::01.2.3.4", "febf::1", "fec0::1", "12345::", "1:0:0:2:0:0:3:4", "1:0:0:2:0:0:0:4", "::1.2.3", "1.2.3.4::", "1:", "::256.1.1.1"]
    for _ in range(1500):
        n = rng.choice((8, 8, 7, 6, 5, 4, 3, 9))
        groups = [rng.choice(("0", "0", "0", "1", "ffff", "7f00", "0abc", "00", "fe80", f"{rng.randrange(65536):x}")) for _ in range(n)]
        k = rng.randrange(n + 1)
        text = ":".join(groups) if rng.random() < 0.4 else ":".join(groups[:k]) + "::" + ":".join(groups[k:])
        texts.append(text + ":" + ".".join(str(rng.choice((0, 1, 127, 255, 256))) for _ in range(4)) if rng.random() < 0.2 else text)
    never = [ipaddress.ip_network(n) for n in ("::/127", "fe80::/10", "ff00::/8", "::ffff:0.0.0.0/104", "::ffff:127.0.0.0/104")]

    def want(text):
        try:
            own = ipaddress.IPv6Address(text)
        except ValueError:
            return None
        return "x_nonroutable" if any(own in n for n in never) else "ip", str(own)

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.ipv6(F.col("t")).alias("k"))
    assert {r.t: r.k and tuple(r.k) for r in df.collect()} == {t: want(t) for t in texts}


def test_classify_stays_in_the_jvm(spark, capsys):
    spark.range(3).select(scalars.classify(F.col("id").cast("string"))).explain("formatted")
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Pandas"))


def test_search_values_are_normalised(spark):
    node = spark.createDataFrame([("fqdn", "netflix.com", 1, 5, 0, 0), ("plugin", "Net Flix", 2, None, 0, 0)], NODE)
    link = spark.createDataFrame([], LINK)
    assert search.search(node, "fqdn", " Netflix.COM. ").count() == 1 and search.search(node, "plugin", " Net Flix ").count() == 1
    assert search.search(node, "plugin", "net flix").count() == 0 and search.find_roots(node, link, "fqdn", " NETF%.com. ").count() == 1


def test_order_statistics_equal_a_sort(spark):
    rng = random.Random(2)
    values = {"a": [rng.randrange(1, 2**31) for _ in range(500)] + [7] * 40, "b": [rng.randrange(1, 900) for _ in range(77)]}
    df = spark.createDataFrame([(s, v) for s, own in values.items() for v in own] + [("a", None)], "scope string, rank int")
    places = {s: [0, 1, len(own) // 3, len(own) // 2, len(own) - 1] for s, own in values.items()}
    assert ranks.order_statistics(df, places) == {(s, k): sorted(values[s])[k] for s, own in places.items() for k in own}


def test_domain_records(spark):
    rows = [(1, "CN.com", ["a.com", "A.com.", "2001:DB8::1", None], "x.com"), (2, "1.2.3.4", None, "1.2.3.4"), (3, "2001:db8::2", ["*.b.com"], None)]
    kept, rejects = normalize.normalize_domains(spark.createDataFrame(rows, "record_id int, cn string, dns array<string>, ip string"))
    got = {(r.record_id, r.field, r.type, r.value) for r in kept.collect()}
    assert got == {(1, "cn", "fqdn", "cn.com"), (1, "dns", "fqdn", "a.com"), (1, "dns", "ip", "2001:db8::1"), (2, "cn", "ip", "1.2.3.4"), (2, "ip", "ip", "1.2.3.4"), (3, "cn", "ip", "2001:db8::2")}
    assert {(r.field, r.reason, r.n) for r in rejects.collect()} == {("ip", "x_invalid", 1), ("dns", "x_wildcard", 1)}
    links = {(r.value_1, r.value_2) for r in normalize.domain_links(kept).collect()}
    assert links == {("cn.com", "a.com"), ("cn.com", "2001:db8::1")}


def test_dates(spark):
    days = {"2026-10-04": "2026-10-10", "2026-10-05": "2026-10-10", "2026-10-10": "2026-10-10", "2026-10-11": "2026-10-17"}
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", scalars.saturday(F.col("d")).cast("string").alias("s"))
    assert {r.d: r.s for r in df.collect()} == days and all(ranks.week_of(datetime.date.fromisoformat(d)).isoformat() == s for d, s in days.items())
    texts = {"0000-00-00 00:00:00": None, "1970-01-02": 86400, "2020-01-01T00:00:00+01:00": 1577833200, "1577836800": 1577836800, "": None, "soon": None, "2020-01-01 00:00:00": 1577836800}
    texts |= {"2020-01-01T00:00:00.123456+00:00": 1577836800, "2020-01-01 00:00:00+00:00": 1577836800, "2020-01-01T00:00:00Z": 1577836800, "2020-01-01 01:00:00+0100": 1577836800, "2019-12-31 19:00:00,5-05": 1577836800, "2020-13-01": None, "01/01/2020": 1577836800}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.seconds(F.col("t")).alias("s"))
    assert {r.t: r.s for r in df.collect()} == texts
    assert spark.range(1).select(scalars.reversed_labels(F.lit("com.google.www"))).first()[0] == "www.google.com"


def test_merge_rules(spark):
    nodes = [("fqdn", "a.com", 9, 7, 5, 0), ("fqdn", "a.com", 4, None, 3, 1), ("fqdn", "b.com", 1, 2, 1, 0), ("fqdn", "b.com", 1, 9, 1, 2), ("fqdn", "b.com", 1, 5, 1, 1)]
    got = {r.value: (r.id, r["rank"], r.version) for r in merge.current(spark.createDataFrame(nodes, NODE), "node").collect()}
    assert got == {"a.com": (4, 7, 5), "b.com": (1, 9, 1)}
    links = [("fqdn", 1, "ip", 2, 0, 20, 5, 0), ("fqdn", 1, "ip", 2, 0, 10, 3, 1)]
    df = spark.createDataFrame(links, LINK)
    for rows in (df, df.orderBy("detection_date"), merge.current(df, "link").unionByName(df)):
        r = merge.current(rows, "link").first()
        assert (r.detection_date, r.version) == (10, 5)


def test_ids_are_dense_and_reimport_is_idempotent(spark):
    node = spark.createDataFrame([("fqdn", "b.com", 7, None, 0, 0), ("fqdn", "b.com", 5, None, 0, 1), ("ip", "1.1.1.1", 3, None, 0, 0)], NODE)
    values = spark.createDataFrame([("fqdn", f"h{i:03}.com") for i in range(300)] + [("fqdn", "b.com"), ("ip", "2.2.2.2"), ("fqdn", ""), ("fqdn", None), ("fqdn", "h001.com"), ("phone", "1")], "node_type string, value string")
    node_map, new = ids.resolve_or_create(values, node, 99, 4)
    got = {(r.node_type, r.value): r.id for r in node_map.collect()}
    assert got[("fqdn", "b.com")] == 5 and got[("ip", "2.2.2.2")] == 4 and got[("phone", "1")] == 1
    assert [got[("fqdn", f"h{i:03}.com")] for i in range(300)] == list(range(8, 308)) and len(got) == 303
    again, none = ids.resolve_or_create(values, node.unionByName(new), 100, 5)
    assert none.count() == 0 and {(r.node_type, r.value): r.id for r in again.collect()} == got


def test_upsert_batch_rejects_and_merges(spark):
    links = spark.createDataFrame(
        [("A.com", "1.1.1.1", "FQDN", "ip", " U1", "2020-01-02", None), ("A.com", "A.com", "fqdn", "fqdn", "u1", None, None), ("a", "b", "planet", "ip", "u1", None, None), ("a", "b", "fqdn", "ip", "zz", None, None), ("", "b", "fqdn", "ip", "u1", None, None)],
        "value_1 string, value_2 string, type_1 string, type_2 string, source_uuid string, detection_date string, update_date string",
    )
    props = spark.createDataFrame([("A.com", "fqdn", "u1", "p1", "100000", "90000", 1), ("A.com", "fqdn", "u1", "p2", "95000", "", 2), ("A.com", "fqdn", "u1", None, "", "", 3), ("A.com", "fqdn", None, "p", "", "", 4)], "value string, type string, source_uuid string, payload string, version string, detection_date string, pos bigint")
    source = spark.createDataFrame([("u1", 9), ("U1", 8)], "uuid string, id_source int")
    rows, prop, new, rejects = ingest.upsert_batch(links, props, source, spark.createDataFrame([], NODE), 500_000, 3)
    assert {(r.type_1, r.type_2, r.id_source, r.detection_date, r.version) for r in rows.collect()} == {("fqdn", "ip", 8, 1577923200, 500000), ("ip", "fqdn", 8, 1577923200, 500000)}
    assert [(r.payload, r.version, r.detection_date) for r in prop.collect()] == [("p2", 100000, 90000)]
    assert {(r.kind, r.reason, r.n) for r in rejects.collect()} == {("link", "self_link", 1), ("link", "unknown_type", 1), ("link", "unknown_source", 1), ("link", "empty_value", 1), ("property", "no_payload", 1), ("property", "unknown_source", 1)}
    assert {r.value for r in new.collect()} == {"A.com", "1.1.1.1"}


def test_staged_nodes_and_properties(spark):
    staged = spark.createDataFrame([("x", "a.com", "FQDN", "", "0"), ("5", "b.com", "fqdn", "1970-01-02", "7"), ("6", "c", "planet", "", "")], "id string, value string, type string, creation_date string, rank string")
    got = {r.value: (r.id, r["rank"], r.version) for r in ingest.distribute_nodes(staged, 77).collect()}
    assert got == {"a.com": (0, None, 77), "b.com": (5, 7, 86400)}
    props = spark.createDataFrame([("1", "fqdn", "2", "{}", "1970-01-02", "0000-00-00 00:00:00")], "id_node string, type string, id_source string, payload string, version string, detection_date string")
    assert ingest.distribute_properties(props, 9)[0].first().detection_date == 86400


def test_ranks_normalise_and_expire(spark):
    rows, nodes, report = ranks.load_ranks(spark.createDataFrame([("a.com", 5), ("A.com.", 3), ("b", 1), ("c.com", 0)], "value string, rank int"), "S", datetime.date(2026, 10, 5), spark.createDataFrame([("fqdn", "a.com", 4, 9, 0, 0)], NODE), spark.createDataFrame([("s", 1)], "uuid string, id_source int"), 5, datetime.date(2026, 10, 6))
    assert [(r.id_node, r["rank"]) for r in rows.collect()] == [(4, 3)] and report.first().asDict() == {"raw": 4, "valid": 1, "unresolved": 0, "created": 0}
    assert merge.current(nodes, "node").first()["rank"] == 3
    with pytest.raises(ValueError):
        ranks.load_ranks(rows, "s", datetime.date(2020, 1, 1), nodes, spark.createDataFrame([("s", 1)], "uuid string, id_source int"), 5, datetime.date(2026, 10, 6))


def hosts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in values.items()], "id bigint, value string")


def test_ancestor_tenant_brand(spark):
    fqdn = hosts(spark, {1: "google.com", 2: "b.google.com", 3: "a.b.google.com", 4: "gov.uk", 5: "www.gchq.gov.uk", 6: "zendesk.com", 7: "x.monapp.zendesk.com", 8: "monapp.com", 9: "monapp-support.zendesk.com", 10: "www.zendesk.com"})
    pairs = spark.createDataFrame([(1, 100), (2, 101), (4, 102), (6, 103), (8, 104)], "id_fqdn bigint, id_plugin bigint")
    got = {r.value: r for r in domains.ancestors(fqdn, pairs, domains.suffix_rules(spark)).collect()}
    assert got["a.b.google.com"].anchor == "b.google.com" and got["b.google.com"].anchor == "google.com" and "www.gchq.gov.uk" not in got
    assert (got["x.monapp.zendesk.com"].tenant, got["x.monapp.zendesk.com"].brand, got["x.monapp.zendesk.com"].brand_plugins) == ("monapp", "monapp", [104])
    assert got["monapp-support.zendesk.com"].brand == "monapp" and got["www.zendesk.com"].brand == ""


def edges(rows):
    return [(a, i, b, j, 0, 0, 0, 0) for a, i, b, j in rows] + [(b, j, a, i, 0, 0, 0, 0) for a, i, b, j in rows]


def test_candidate_rules(spark):
    signals = spark.createDataFrame(
        [(1, 9, "capture", None, None, 1), (2, 9, "capture", None, None, 1), (2, 8, "fqdn", None, None, 1), (3, 9, "ip", None, None, 1), (4, 9, "tenant", "t.x.com", "x.com", 0), (4, 9, "ip", None, None, 1), (5, 9, "capture", None, None, 1), (6, 9, "tenant", "u.x.com", "x.com", 0)],
        "id_fqdn bigint, id_plugin bigint, signal string, fqdn string, anchor string, nb_pivots bigint",
    )
    classified = spark.createDataFrame([(4, 7), (5, 7)], "id_fqdn bigint, id_plugin bigint")
    got = {r.id_fqdn: (r.status, r.score, list(r.signals)) for r in classify.candidates(signals, classified).collect()}
    assert got == {1: ("non_classe", 2, ["capture"]), 4: ("complement", 2, ["ip", "tenant"]), 5: ("conflit", 2, ["capture"])}


def test_own_vote_does_not_count(spark):
    link = spark.createDataFrame(edges([("fqdn", 1, "plugin", 50), ("fqdn", 1, "capture", 7), ("fqdn", 2, "capture", 7), ("capture", 7, "plugin", 60)]), LINK)
    pairs = classify.classified_pairs(link)
    labels = classify.pivot_labels(link, pairs)
    got = {(r.id_fqdn, r.id_plugin) for r in classify.pivot_signals(link, labels, pairs).collect()}
    # host 1's own vote is the only other one, so plugin 60 is proposed to it; host 2 has one vote against it
    assert got == {(1, 60)}


def test_age_of_unclassified_hosts(spark):
    now = datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC)
    day = lambda n: int((now - datetime.timedelta(days=n)).timestamp())
    cand = spark.createDataFrame([(i, 9, "non_classe", 0) for i in (1, 2, 3, 4)] + [(5, 9, "conflit", 0)], "id_fqdn bigint, id_plugin bigint, status string, nb_pivots bigint")
    props = spark.createDataFrame([("fqdn", 1, 0, day(366)), ("fqdn", 2, 0, day(364)), ("fqdn", 5, 0, day(900))], "node_type string, id_node bigint, id_source int, detection_date int")
    rank = spark.createDataFrame([("fqdn", 4)], "node_type string, id_node bigint")
    got = {r.id_fqdn for r in classify.dated(cand, spark.createDataFrame([], LINK), props, rank, now).where("keep").collect()}
    assert got == {2, 4, 5}


def test_patterns_are_literal_but_for_percent(spark):
    node = spark.createDataFrame([("plugin", v, i, None, 0, 0) for i, v in enumerate(["a_bc", "axbc", "a\\_bc", "za_b"])], NODE)
    assert [r.value for r in search.find_roots(node, spark.createDataFrame([], LINK), "plugin", "a_b%").collect()] == ["a_bc"]
    with pytest.raises(ValueError):
        search.find_roots(node, node, "plugin", "%ab%")


def test_pseudonyms(spark):
    # the alias is that of the name as it is written, and a variant that two names share is the shorter one's
    mask, js, big, stripe = ("plugin_" + hashlib.sha1(n).hexdigest()[:6] for n in (b"Cloudflare", b"js", b"Big Co", b"Stripe"))
    names = spark.createDataFrame([("Cloudflare",), ("js",), ("Big Co",), ("B-i-g C.o",), ("Stripe",)], "name string")
    df = spark.createDataFrame([("cdnjs.cloudflare.com",), ("x-js.y",), ("ajsx",), ("bigco.com",), (None,), ("\u017ftripe.com",)], "t string")
    got = [r.t for r in explain.pseudonymise(df, ["t"], names).collect()]
    assert got == [f"cdnjs.{mask}.com", f"x-{js}.y", "ajsx", f"{big}.com", None, f"{stripe}.com"]
    values = spark.createDataFrame([("capture", "cloudflare"), ("application", "cloudflare"), ("fqdn", "cloudflare.com")], "pivot_type string, value string")
    assert [r.value for r in explain.pseudonymise_values(values, names).collect()] == ["capture_" + hashlib.sha1(b"cloudflare").hexdigest()[:8], "cloudflare", f"{mask}.com"]


def brute_graph(rows, roots, depth, k, hub, most):
    """Level by level, one node after the other."""
    near = {}
    for a, i, b, j, *_ in rows:
        near.setdefault((a, i), set()).add((b, j))
    score = lambda b: 0.0 if len(near[b]) > hub else __import__("math").log2(1 + len(near[b]))
    level, frontier = {r: 0 for r in roots}, list(roots)
    for d in range(1, depth + 1):
        new = []
        for a in frontier:
            is_hub = level[a] > 0 and len(near.get(a, ())) > hub
            by = {}
            for b in near.get(a, ()):
                by.setdefault(b[0], []).append(b)
            for t in sorted(by):
                for b in sorted(by[t], key=lambda b: (-score(b), b[1]))[:k]:
                    if b not in level and not is_hub and len(level) < most:
                        level[b] = d
                        new.append(b)
        frontier = new
    return level


@pytest.mark.parametrize(("hub", "most"), [(500, 800), (3, 800), (500, 12)])
def test_graph_equals_breadth_first_search(spark, hub, most):
    rows = edges([("fqdn", i, "ip", (i * i) % 17) for i in range(40)] + [("fqdn", i, "fqdn", (i * 3) % 40) for i in range(1, 40) if i != (i * 3) % 40])
    link = spark.createDataFrame(sorted(set(rows)), LINK)
    node = spark.createDataFrame([("fqdn", f"h{i}", i, None, 0, 0) for i in range(39)], NODE)
    roots = spark.createDataFrame([("fqdn", 1, 0), ("fqdn", 5, 1)], "node_type string, id bigint, place bigint")
    nodes, found, info = neighbourhood.build_graph(node, link, roots, 2, 4, hub, most)
    got = {(r.node_type, r.id): r.level for r in nodes.collect()}
    want = brute_graph(set(rows), [("fqdn", 1), ("fqdn", 5)], 2, 4, hub, most)
    assert got == want
    ends = {(e.type_1, e.id_1) for e in found.collect()} | {(e.type_2, e.id_2) for e in found.collect()}
    assert ends <= set(got) and info["truncated"] == (most == 12)
    assert found.where("tree").count() == len(got) - 2
    assert all(r.value == f"h{r.id}" or "without value" in r.value for r in nodes.collect())


def test_hub_adds_no_node(spark):
    rows = edges([("fqdn", 0, "ip", 1)] + [("ip", 1, "fqdn", i) for i in range(2, 503)])
    link = spark.createDataFrame(rows, LINK)
    roots = spark.createDataFrame([("fqdn", 0, 0)], "node_type string, id bigint, place bigint")
    nodes, _, info = neighbourhood.build_graph(spark.createDataFrame([], NODE), link, roots, 2, 20, 500)
    assert {(r.node_type, r.id, r.hub) for r in nodes.collect()} == {("fqdn", 0, False), ("ip", 1, True)} and info["hubs"] == 1


def test_edge_budget_keeps_the_tree(spark):
    rows = spark.createDataFrame([("ip", 1, "fqdn", 2, 3, 9, True), ("fqdn", 2, "ip", 1, 5, 8, False), ("fqdn", 3, "ip", 1, 7, 1, False), ("fqdn", 4, "ip", 1, 2, 1, False)], "type_1 string, id_1 bigint, type_2 string, id_2 bigint, sources bigint, first_seen int, tree boolean")
    merged = neighbourhood.unordered(rows)
    assert {(r.id_1, r.sources, r.tree) for r in merged.collect()} == {(2, 5, True), (3, 7, False), (4, 2, False)}
    kept, dropped = neighbourhood.within_budget(merged, 2)
    assert {r.id_1 for r in kept.collect()} == {2, 3} and dropped == 1


def test_params_are_the_documented_ones():
    p = Params()
    assert (p.min_score, p.min_votes, p.min_purity, p.guard_purity, p.max_degree, p.platform_plugins, p.generic_domains, p.max_age_days) == (2, 3, 0.9, 0.5, 1000, 10, 20, 365)
