"""Nearest classified ancestors in one sorted pass, against a walk over each host's parents."""

import random

import pytest

from assetloom.operators import domains


def walk(hosts, values, reg_of):
    out = []
    for i, host in hosts:
        labels = host.split(".")
        parents = [".".join(labels[k:]) for k in range(1, len(labels) - 1)]
        hit = next((p for p in parents if p in values), None)
        if len(labels) > 2 and hit and len(hit) >= len(reg_of(host)):
            out.append((i, host, hit, values[hit]))
    return sorted(out)


def reg_of(host):
    labels = host.split(".")
    return ".".join(labels[-3:] if ".".join(labels[-2:]) == "co.uk" else labels[-2:])


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_ranges_of_any_number_find_the_nearest(spark, parts):
    rng = random.Random(5)
    pool = ["a", "a-b", "b", "www", "x1", "z"]
    names = [".".join([*rng.choices(pool, k=rng.randint(0, 4)), rng.choice(["ex", "ex-1", "shop", "co"]), rng.choice(["com", "uk", "net"])]) for _ in range(700)]
    names += [f"h{i}.deep.a.ex.com" for i in range(300)]  # one hot subtree over many ranges
    hosts = list(enumerate(names))
    values = {n: [k, k + 1] for k, n in enumerate(sorted(set(rng.sample(names, 60)) | {"ex.com", "deep.a.ex.com", "co.uk", "absent.ex.com", "b.ex-1.net"}))}
    fqdn = spark.createDataFrame(hosts, "id bigint, value string")
    table = spark.createDataFrame(list(values.items()), "value string, plugins array<bigint>")
    got = domains.nearest_ancestors(fqdn, table, domains.suffix_rules(spark), parts).collect()
    want = walk(hosts, values, reg_of)
    assert sorted((r.id_fqdn, r.value, r.anchor, r.plugins) for r in got) == want and len(want) > 400
    assert domains.nearest_ancestors(fqdn, table.where("false"), domains.suffix_rules(spark), parts).count() == 0


def test_a_key_is_next_to_all_names_under_it(spark):
    names = ["ex.com", "ex-1.com", "a.ex.com", "a-b.ex.com", "z.a.ex.com", "0.a.ex.com", "_x.a.ex.com"]
    rows = spark.createDataFrame([(n,) for n in names], "value string").withColumn("key", domains.tree_key("value")).orderBy("key").collect()
    assert [r.value for r in rows] == ["ex.com", "a.ex.com", "0.a.ex.com", "_x.a.ex.com", "z.a.ex.com", "a-b.ex.com", "ex-1.com"]
