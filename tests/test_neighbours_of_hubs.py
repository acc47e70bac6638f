"""Pools of a hub's neighbours: the same rows as one sort of all, chosen in two steps."""

import hashlib

from assetloom.operators import neighbourhood as nb


def test_a_binding_pool_keeps_the_most_seen_and_counts_all(spark):
    link = spark.range(4000).selectExpr("'ip' type_1", "id % 2 id_1", "'fqdn' type_2", "id id_2", "explode(sequence(1, cast(1 + id % 3 as int))) id_source", "cast(id as int) detection_date")
    front = spark.createDataFrame([("ip", 0), ("ip", 1), ("ip", 9)], "type_1 string, id_1 bigint")
    got = nb.neighbour_candidates(front, link, pool=37).collect()
    for hub in (0, 1):
        ids = sorted((i for i in range(4000) if i % 2 == hub), key=lambda i: (-(1 + i % 3), hashlib.md5(str(i).encode()).hexdigest(), i))
        assert {r.id_2 for r in got if r.id_1 == hub} == set(ids[:37])
    assert {r.degree for r in got} == {2000} and len(got) == 74
    best = nb.neighbours(front, link, link, 3, 500, "sources", pool=37)
    assert {(r.id_1, r.place, r.degree) for r in best.collect()} == {(h, p, 2000) for h in (0, 1) for p in (1, 2, 3)}


def test_a_hub_is_cut_in_parts_before_its_last_choice(spark):
    rows = spark.range(10).selectExpr("'ip' type_1", "1L id_1", "'fqdn' type_2", "id id_2", "1L sources", "1 first_seen")
    plan = nb._pooled(rows, 5)._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and all("_part" in line for line in partial)  # cut by part before any shuffle
    assert plan.count("row_number()") >= 2
