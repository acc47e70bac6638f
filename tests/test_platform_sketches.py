"""Decisions from merged sketches equal the exact ones, also where sketches are too small to count."""

from pyspark.sql import functions as F

from assetloom.operators import domains
from assetloom.operators import platform_sketches as sketches
from assetloom.operators.domains import Params

PARAMS = Params(platform_plugins=300, platform_diversity=0.5, platform_ratio=0.5)
KIND = "id_fqdn bigint, anchor string, plugins array<bigint>, own array<bigint>, tenant string, brand string, brand_plugins array<bigint>"


def rows(spark):
    """Ancestors with 0 to 600 hosts of other plugins or of brands; every fifth has names without a plugin, one has as many as all others."""
    out = []
    for k in range(24):
        n = 600 if k == 0 else 25 * k
        for i in range(n if k else 3000):
            by_brand, plugin = k % 2 == 1, 10 + i % (n // (1 + k % 3) + 1 if k else 2900)
            own = [plugin] if not by_brand and i % 5 else []
            out.append((len(out), f"p{k}.com", [1], own, "www" if i % 7 == 0 else f"t{i}", f"t{i}" if by_brand else "", [plugin] if by_brand else []))
    return spark.createDataFrame(out, KIND)


def test_decisions_equal_exact_ones(spark):
    anc = rows(spark)
    generic = spark.createDataFrame([("t3",), ("t8",)], "brand string")
    stats = domains.platform_stats(anc, generic, PARAMS)
    exact = {r.anchor: r for r in stats.collect()}
    want = {r.anchor for r in domains.platforms(stats, PARAMS).collect()}
    assert 0 < len(want) < len(exact)
    for size, exactly in ((12, True), (9, False), (7, False)):
        batches = [sketches.sketches(anc.where(F.col("id_fqdn") % 3 == b), generic, PARAMS, size) for b in range(3)]
        whole = sketches.merged(batches[0].unionByName(batches[1]).unionByName(batches[2]), size)
        got = sketches.decisions(whole, anc, generic, PARAMS, size).collect()
        assert {r.anchor for r in got if r.is_platform} == want and len(got) == len(exact)
        assert any(r.settled for r in got)
        for r in sketches.estimates(whole, size).collect():
            own = exact[r.anchor]
            assert (r.nb_classified, r.nb_classified_other) == (own.nb_classified, own.nb_classified_other)
            assert all(r.low[c] <= own[c] <= r.high[c] for c in sketches.DISTINCT)
            if exactly and max(own[c] for c in sketches.DISTINCT) < 2048:
                assert all(r[c] == own[c] for c in sketches.DISTINCT)
        if size == 7:
            assert any(not r.settled for r in got)


def test_no_rows_and_null_names(spark):
    generic = spark.createDataFrame([], "brand string")
    none = spark.createDataFrame([], KIND)
    assert sketches.decisions(sketches.merged(sketches.sketches(none, generic)), none, generic).count() == 0
    odd = spark.createDataFrame([(1, "a.com", [1], [], "", "", []), (1, "a.com", [1], [], "", "", []), (2, None, [1], [2], "x", "", [])], KIND)
    got = sketches.estimates(sketches.merged(sketches.sketches(odd, generic))).orderBy(F.col("anchor").desc()).collect()
    assert [(r.anchor, r.nb_tenants, r.nb_classified, r.nb_plugins_other) for r in got] == [("a.com", 1, 0, 0), (None, 1, 1, 1)]
