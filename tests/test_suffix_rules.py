"""Registrable domains under plain, wildcard and exception rules."""

import pytest

from assetloom.operators import domains
from assetloom.sources import files

RULES = "// list\n\ncom\nuk\nco.uk\n!www.ck  // ours\n*.ck\njp\n*.kawasaki.jp\n!city.kawasaki.jp\nkawasaki.jp\nK12.ma.us\npvt.k12.ma.us\nck\n"
HOSTS = {
    "a.example.com": "example.com", "example.com": "example.com", "com": "com", "x.unlisted": "x.unlisted", "a.b.unlisted": "b.unlisted",
    "www.gchq.gov.uk": "gov.uk", "a.shop.co.uk": "shop.co.uk", "co.uk": "co.uk",
    "foo.bar.ck": "foo.bar.ck", "a.foo.bar.ck": "foo.bar.ck", "bar.ck": "bar.ck", "www.ck": "www.ck", "a.www.ck": "www.ck", "a.b.www.ck": "www.ck",
    "x.kawasaki.jp": "x.kawasaki.jp", "y.x.kawasaki.jp": "y.x.kawasaki.jp", "z.y.x.kawasaki.jp": "y.x.kawasaki.jp", "city.kawasaki.jp": "city.kawasaki.jp", "a.city.kawasaki.jp": "city.kawasaki.jp",
    "a.b.k12.ma.us": "b.k12.ma.us", "a.b.c.pvt.k12.ma.us": "c.pvt.k12.ma.us", "ma.us": "ma.us", "": "",
}


@pytest.mark.parametrize("from_file", [True, False])
def test_longest_rule_wildcards_and_exceptions(spark, tmp_path, from_file):
    (tmp_path / "list.txt").write_text(RULES)
    table = files.read_suffix_list(spark, str(tmp_path / "list.txt"))
    lines = tuple(line.split("//")[0].strip() for line in RULES.splitlines() if line.split("//")[0].strip())
    assert {r.suffix for r in table.collect()} == {line.lower() for line in lines}
    rules = domains.rules_of(table) if from_file else domains.suffix_rules(spark, lines)
    assert sorted(rules.by_depth) == [1, 2, 3, 4]
    hosts = spark.createDataFrame([(h,) for h in [*HOSTS, None]], "host string")
    got = {r.host: r.reg for r in domains.registrable_domain(hosts, "host", rules).collect()}
    assert got == HOSTS | {None: None}
    assert {r.host: r.reg for r in domains.registrable_domain(hosts, "host", table.where("false")).collect()} == {h: ".".join(h.split(".")[-2:]) for h in HOSTS} | {None: None}
