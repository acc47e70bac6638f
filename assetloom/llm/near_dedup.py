"""MinHash near-duplicate detection by a signature-coordinate inverted join (operator 3).

1. A document's set is its distinct word shingles. Equal sets make one class, named by its smallest id.
2. A class has a signature of `coordinates` minima. It is posted under its coordinate-value pairs. Two sets
   at the similarity bound agree in about that share of coordinates; the match threshold lies five standard
   deviations below. Sets that agree in so many coordinates share one of the rarest `coordinates - threshold
   + 1` pairs of each (prefix), and a pair that one class alone has can be skipped, so a class whose prefix
   holds nothing else leaves the join.
3. In each posting list all classes are paired with the list's smallest (a star, never all pairs). Pairs whose
   signatures agree in as many coordinates as the threshold says are retained, their full sets compared, and
   confirmed links joined to components.
4. What stars cannot see: classes whose lists hang together but whose components differ. These, and only
   these, are compared with all others of their lists in blocks of bounded size, again on full sets; each
   block pair returns just the links that join components. So no link between different texts is lost
   beside the signature's stated chance (below one in 100,000 at the bound), and no task holds a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import text_blocks, through_table, words
from .components import components

COORDINATES = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240)
_FACTORS = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
#: Bytes of ids that may be broadcast, once counted.
BROADCAST_BYTES = 16_000_000


def broadcast_if_small(ids: DataFrame) -> DataFrame:
    """A table of ids and numbers, marked for broadcast if its rows, counted and measured, take no more than BROADCAST_BYTES."""
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in ids.dtypes if t == "string"]
    size = ids.agg(F.sum(sum(text, F.lit(16 * len(ids.columns))))).first()[0] or 0
    return F.broadcast(ids) if size <= BROADCAST_BYTES else ids


def match_threshold(similarity: float, coordinates: int = COORDINATES) -> int:
    return max(1, math.floor(coordinates * similarity - 5 * math.sqrt(coordinates * similarity * (1 - similarity))))


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of lower-cased (A-Z) words; of all words, if they are fewer."""
    import xxhash

    numbers, at, distinct = words(pc.ascii_lower(texts))
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in distinct], np.uint64)[numbers] if len(numbers) else np.zeros(0, np.uint64)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = hashes[a:b]
        k = min(size, b - a)
        if not k:
            yield np.zeros(0, np.uint64)
            continue
        out = own[: b - a - k + 1].copy()
        for j in range(1, k):
            out ^= out >> np.uint64(29)
            out = out * _ODD + own[j : b - a - k + 1 + j]
        out ^= out >> np.uint64(32)
        yield np.unique(out * _ODD + np.uint64(k))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Coordinate-value pairs of each non-empty set as numbers: the minimum under each coordinate's hash (58 bits), and the coordinate.

    With so many bits, sets that share nothing agree in a coordinate by chance in one of 10^14 pairs or less, at any
    size of the corpus.
    """
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for k in range(COORDINATES):
        mixed = flat * _FACTORS[k] + _SHIFTS[k]
        least = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
        out[:, k] = (least >> np.uint64(6) << np.uint64(6)) | np.uint64(k)
    return out


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, n, digest, tokens) of each row: hash of the text, set size, digest of the set, and its coordinate-value pairs as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for block in text_blocks(batches, max_bytes=4_000_000):
            sets = list(shingle_sets(block.column("text")))
            filled = [s for s in sets if len(s)]
            pairs = _signatures(filled) if filled else np.zeros((0, COORDINATES), np.uint64)
            lengths = np.array([COORDINATES if len(s) else 0 for s in sets], np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(pairs.ravel().view(np.int64)))
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), tokens], ["id", "key", "n", "digest", "tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("key"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, key bigint, n bigint, digest binary, tokens array<bigint>")


def _text_key(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def full_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, set binary)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, max_bytes=4_000_000):
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([s.tobytes() for s in shingle_sets(block.column("text"))], pa.binary())], ["id", "set"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, set binary")


def postings(classes: DataFrame, threshold: int) -> DataFrame:
    """(token, id): each class under the pairs of its prefix that others have too."""
    need = COORDINATES - threshold  # so many pairs may differ
    tokens = classes.select("id", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("id").alias("c")).where("c > 1")
    by_class = tokens.join(shared, "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("t"))
    # pairs that the class alone has are its rarest; what is left of the prefix comes from the shared ones
    prefix = F.expr(f"slice(t, 1, greatest(0, {need + 1} - ({COORDINATES} - size(t))))")
    return by_class.select("id", F.explode(prefix).alias("p")).select(F.col("p.token").alias("token"), "id")


def stars(posted: DataFrame) -> DataFrame:
    """(a, b): the smallest class of a list with each other one."""
    first = posted.groupBy("token").agg(F.min("id").alias("a"), F.count("id").alias("size")).where("size > 1").select("token", "a")
    return posted.join(first, "token").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def with_centres(pairs: DataFrame, values: DataFrame, per_task: int = 256) -> DataFrame:
    """pairs (a, b) with the columns (id, value) of b and a as value_b and value_a.

    A star's centre a may have any number of pairs. Those with over per_task are dealt over as many parts as
    that takes, and the centre's value is copied to each; a copy serves per_task pairs, so copies stay few.
    """
    hot = pairs.groupBy("a").agg(F.ceil(F.count("b") / per_task).cast("int").alias("parts")).where("parts > 1")
    hot = broadcast_if_small(hot)
    parts = F.coalesce("parts", F.lit(1))
    dealt = pairs.select("a", "b").join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"))
    centres = pairs.select("a").distinct().join(hot, "a", "left").select("a", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    centres = centres.join(values.toDF("a", "value_a"), "a")
    return dealt.join(values.toDF("b", "value_b"), "b").join(centres, ["a", "part"]).select("a", "b", "value_a", "value_b")


def retained(pairs: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """The (a, b) whose signatures (id, tokens) agree in threshold coordinates or more."""
    collisions = F.size(F.array_intersect("value_a", "value_b"))  # a token is a coordinate with its value
    return with_centres(pairs, signatures).where(collisions >= threshold).select("a", "b").distinct()


def _similar(common: np.ndarray | int, n: np.ndarray | int, m: np.ndarray | int, percent: int):
    return 100 * common >= percent * (n + m - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(_similar(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    kind = dict(pairs.dtypes)["a"]
    return with_centres(pairs, sets).mapInArrow(run, f"a {kind}, b {kind}")


def joining_links(ids: list, labels: list, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, width: int = 8192) -> list[tuple]:
    """Similar pairs (one of left, one of right) that join different labels, as few as do; intersections by matrix products."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    distinct, number, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    use = counts[number] > 1
    column, owner = shared[number[use]], owner[use]
    common = np.zeros((len(left), len(right)), np.int64)
    row_l, row_r = np.full(len(sets), -1), np.full(len(sets), -1)
    row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        c, o = column[a:b] - start, owner[a:b]
        dense = []
        for row, n in ((row_l, len(left)), (row_r, len(right))):
            part = np.zeros((n, width), np.float32)
            mine = row[o] >= 0
            part[row[o[mine]], c[mine]] = 1
            dense.append(part)
        common += (dense[0] @ dense[1].T).astype(np.int64)
    hit = _similar(common, sizes[left][:, None], sizes[right][None, :], percent)
    parent = {x: x for x in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        p, q = root(labels[left[i]]), root(labels[right[j]])
        if p != q:
            parent[p] = q
            out.append((ids[left[i]], ids[right[j]]))
    return out


def rest(members: DataFrame, sets: DataFrame, percent: int, block: int = 128) -> DataFrame:
    """(a, b): confirmed links between different components of one cluster; members is (id, cluster, component).

    In each cluster, the classes outside its largest component come first and are cut into blocks; their
    blocks meet all blocks of the cluster, each pair of blocks in a group of its own.
    """
    kind = dict(members.dtypes)["id"]
    size = members.groupBy("cluster", "component").agg(F.count("id").alias("n"))
    largest = size.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.count("component").alias("k"), F.sum("n").alias("all")).where("k > 1")
    # a class's block within its part of the cluster comes from a hash, so no window gathers a cluster
    open_ = members.join(largest.select("cluster", F.col("top.component").alias("main"), F.col("top.n").alias("in_main"), "all"), "cluster")
    n_rest, n_main = F.ceil((F.col("all") - F.col("in_main")) / block), F.ceil(F.col("in_main") / block)
    is_main = F.col("component") == F.col("main")
    own = F.when(is_main, n_rest + F.pmod(F.xxhash64("id"), n_main)).otherwise(F.pmod(F.xxhash64("id"), n_rest))
    placed = open_.select("id", "cluster", "component", own.cast("int").alias("own"), n_rest.cast("int").alias("n_rest"), (n_rest + n_main).cast("int").alias("n_all"))
    # block i of the rest meets each block j >= i
    as_first = F.when(F.col("own") < F.col("n_rest"), F.transform(F.sequence("own", F.col("n_all") - 1), lambda j: F.struct(F.col("own").alias("i"), j.alias("j")))).otherwise(F.array())
    before = F.least(F.col("own"), F.col("n_rest"))
    as_second = F.when(before > 0, F.transform(F.sequence(F.lit(0), before - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j")))).otherwise(F.array())
    dealt = placed.join(sets, "id").select("id", "cluster", "component", "own", "set", F.explode(F.concat(as_first, as_second)).alias("at")).select("id", "cluster", "component", "own", "set", "at.i", "at.j")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, i, j = group["own"].to_numpy(), group["i"].iat[0], group["j"].iat[0]
        found = joining_links(group["id"].tolist(), group["component"].tolist(), [np.frombuffer(s, np.uint64) for s in group["set"]], np.flatnonzero(own == i), np.flatnonzero(own == j), percent)
        return pd.DataFrame(found, columns=["a", "b"])

    return dealt.groupBy("cluster", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}")


def link(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links, itself included) and kept (id = component_id) of each row.

    Rows link if 100 * intersection >= percent * union of their shingle sets. A null, empty or blank text has
    an empty set and no link. A row with a null id is never linked: its component_id is null and it is kept.
    ids should be unique; rows that repeat id and text get equal results, and rows that repeat an id with another
    text each have the component of their own text. Very long texts are read whole. An empty table gives an empty
    result.
    """
    out = _linked(docs, percent, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def _linked(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n, component, kept) of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = through_table(sketches(rows, "id", "text"), "sketches")
    usable = sketched.where("digest is not null and id is not null")
    classes = usable.groupBy("digest").agg(F.min(F.struct("id", "tokens")).alias("x")).select("digest", "x.id", "x.tokens")
    classes = through_table(classes, "classes")
    threshold = match_threshold(percent / 100)
    posted = through_table(postings(classes, threshold), "postings")
    pairs = through_table(stars(posted), "stars")
    suspects = posted.select("id").distinct()
    sets = full_sets(rows.join(broadcast_if_small(suspects), "id", "left_semi"), "id", "text").distinct()
    sets = through_table(sets, "sets")
    signatures = classes.select("id", "tokens").join(suspects, "id", "left_semi")
    matched = through_table(retained(pairs, signatures, threshold), "matched")
    certain = through_table(confirmed(matched, sets, percent), "certain")
    cluster, first = components(pairs), components(certain)
    members = suspects.join(cluster.toDF("id", "cluster"), "id", "left").join(first.toDF("id", "component"), "id", "left")
    members = through_table(members.select("id", F.coalesce("cluster", "id").alias("cluster"), F.coalesce("component", "id").alias("component")), "members")
    links = through_table(certain.union(rest(members, sets, percent)), "all-links")
    final = components(links).toDF("class_id", "class_component")
    named = classes.select("digest", F.col("id").alias("class_id")).join(final, "class_id", "left").select("digest", F.coalesce("class_component", "class_id").alias("component"))
    out = sketched.select("id", "key", "n", "digest").join(named, "digest", "left").select("id", "key", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True)))


def deduplicate(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component those with the smallest id.

    A row goes for what its own text is a copy of, so of rows that repeat an id with other texts each is judged
    by itself. Of rows that repeat id and text one stays, whichever; rows with a null id all stay, and so do null
    and empty texts. Very long texts are read whole. An empty table gives an empty result. Columns of any other
    name are carried along.
    """
    linked = through_table(_linked(docs, percent, id_col, text_col).select("id", "key", "kept"), "linked")
    gone = broadcast_if_small(linked.where("not kept").select("id", "key").distinct())
    twice = linked.where("kept and id is not null").groupBy("id", "key").count().where("count > 1").select("id", "key")

    def same(rows: DataFrame) -> Column:
        return (docs[id_col] == rows["id"]) & (_text_key(docs[text_col]) == rows["key"])

    left = docs.join(gone, same(gone), "left_anti")
    if not twice.head(1):
        return left
    twice = broadcast_if_small(twice)
    one = left.join(twice, same(twice), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(twice, same(twice), "left_anti").unionByName(one)
