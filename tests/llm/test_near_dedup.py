import random
import re

from assetloom.llm import near_dedup, queries
from assetloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows, percent=85):
    """id -> (set size, component), by an inverted index over all shingles."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = {}
    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for j in index.get(s, ()):
                common[j] = common.get(j, 0) + 1
            index.setdefault(s, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(got, rows):
    want = brute_force(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (n, c, i == c) for i, (n, c) in want.items()} and len(got) == len(rows)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    check(queries.op3_near_dedup(spark, sf_dir).collect(), rows)


def test_large_groups_near_the_bound(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(700):  # copies of one text that differ from each other by about the bound, so that chains matter
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 4))):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    shared = " ".join(base[:60])
    rows += [(1000 + i, shared + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(120))) for i in range(300)]
    rows += [(2000 + i, "same text in each of these rows") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(near_dedup.link(df).collect(), rows)


def test_odd_rows(spark, odd_docs, no_docs, texts):
    got = near_dedup.link(odd_docs).collect()
    want = brute_force([(i, t) for i, t in texts if i is not None])
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None) == sorted((i, *want[i], i == want[i][1]) for i, _ in texts if i is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dedup.link(no_docs).count() == 0


def test_texts_of_a_repeated_id_stay(spark):
    a, b, c = "one text of some words that is copied", "quite another text that nobody has copied so far", "a third one"
    rows = [(3, a, 1), (7, a, 2), (7, b, 3), (7, b, 3), (8, c, 4), (None, a, 5), (9, None, 6), (9, "", 7), (9, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int")
    got = sorted(map(tuple, near_dedup.deduplicate(docs).collect()), key=str)
    assert got == sorted([(3, a, 1), (7, b, 3), (8, c, 4), (None, a, 5), (9, None, 6), (9, "", 7)], key=str)
    named = docs.select(docs.doc_id.cast("string").alias("key"), docs.text.alias("kept"))
    assert near_dedup.deduplicate(named, id_col="key", text_col="kept").count() == 6


def test_hot_centres_are_dealt_and_lose_no_pair(spark):
    pairs = [(1, i) for i in range(2, 1500)] + [(2000, 2001)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    values = spark.createDataFrame([(i, f"v{i}") for i in range(2100)], "id bigint, value string")
    got = near_dedup.with_centres(df, values, per_task=100).collect()
    assert sorted((r.a, r.b, r.value_a, r.value_b) for r in got) == [(a, b, f"v{a}", f"v{b}") for a, b in pairs]


def test_components_of_a_path_a_star_and_a_loop(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 300), (None, 1), (201, 200), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{100 + i: 100 for i in range(1, 40)}, 201: 200}
