"""Hard-negative mining over a GNAT-style multiway hyperplane tree (operator 11).

1. Scores are inner products of whole-number vectors. Each vector is extended by one component that gives all the
   same norm, so that a score is a cosine and thus an angle, and angles obey the triangle inequality.
2. The tree is fitted on a bounded sample. A node has several split points far apart, as many as its share of the
   leaves allows; a vector belongs to the nearest one, so bisecting hyperplanes part the siblings. All rows are then
   routed to a leaf, and each node stores, for each split point and each sibling's subtree, the smallest and largest
   angle between them, taken over all rows by one aggregation.
3. Anchors go in groups with a size bound, neighbours together. A group is sent to all tasks; a query is a window
   of scores, that is an annulus of angles around its anchor. A sibling is eliminated if the ranges that some split
   point stores for it don't meet the annulus widened by the angle between anchor and split point. Leaves that no
   query of the group reaches aren't read; in the others scores are computed exactly, in blocks.
4. Three scans a group: the anchor's own leaf gives a first bound for its positives; all leaves within it give the
   positives; all leaves within the windows that the positives set give the negatives.

Any vectors give exact results: where nothing can be eliminated, as in random directions, all leaves are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .best import Best, first_of
from .blocks import through_table

SLACK = 1e-6  # radians, above the rounding of angles
ANY = np.iinfo(np.int64)


@dataclass(frozen=True)
class Settings:
    max_sample: int = 8192  # rows on which the tree is fitted; all are indexed
    fanout: int = 8
    leaf_rows: int = 2048  # rows that a leaf holds about, as far as the sample allows
    group_bytes: int = 8_000_000  # of the anchors that a scan takes at once
    cells: int = 1_000_000  # scores that a task computes at once


@dataclass
class Node:
    points: np.ndarray  # unit vectors, extended
    child: list[int]  # a node's number, or minus the leaf's number minus one
    low: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # [split point, sibling] angles
    high: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


@dataclass
class Tree:
    nodes: list[Node]
    norm: float  # of all extended vectors
    leaves: int = 1
    above: dict[int, tuple[int, int]] = field(default_factory=dict)  # child -> its node and place there

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.hstack([vectors, rest[:, None]]) / self.norm

    def steps(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each node that vectors pass: its number, their rows, their angles to its split points, and the nearest one."""
        unit = self.extended(vectors)
        at = {0: np.arange(len(unit))} if self.nodes else {}
        while at:
            number, rows = at.popitem()
            node = self.nodes[number]
            cosine = unit[rows] @ node.points.T
            nearest = cosine.argmax(axis=1)
            yield number, rows, np.arccos(np.clip(cosine, -1, 1)), nearest
            for j, child in enumerate(node.child):
                if child > 0 and (own := rows[nearest == j]).size:
                    at[child] = own

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        for number, rows, _, nearest in self.steps(vectors):
            child = np.array(self.nodes[number].child)[nearest]
            out[rows[child < 0]] = -child[child < 0] - 1
        return out


def fit(sample: np.ndarray, norm: float, leaves: int, fanout: int) -> Tree:
    """A tree of about so many leaves; split points are the sample's, each next one farthest from those before."""
    tree = Tree([], norm)
    unit = np.unique(tree.extended(sample), axis=0) if len(sample) else np.zeros((0, 1))
    made = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal made
        m = min(fanout, wanted, len(rows))
        if m < 2:
            made += 1
            return -made
        candidates = rows[:: max(1, len(rows) // (3 * m))]
        chosen, nearest = [0], unit[candidates] @ unit[candidates[0]]
        while len(chosen) < m:
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, unit[candidates] @ unit[candidates[chosen[-1]]])
        node, number = Node(unit[candidates[chosen]], []), len(tree.nodes)
        tree.nodes.append(node)
        own = (unit[rows] @ node.points.T).argmax(axis=1)
        for j in range(m):
            part = rows[own == j]
            node.child.append(grow(part, max(1, round(wanted * len(part) / len(rows)))))
            tree.above[node.child[-1]] = (number, j)
        return number

    grow(np.random.default_rng(7).permutation(len(unit)), leaves)
    tree.leaves = max(1, made)
    return tree


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column; what a shorter row lacks is zero."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = column.flatten().to_numpy()
    return out


def usable(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """(id, label, e): e holds floor(scale * x) of each component; one row an id."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.alias("label"), x.alias("x"), bad.alias("bad")).where("id is not null and label is not null and x is not null and not bad")
    rows = through_table(rows.select("id", "label", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("e")), "vectors")
    twice = rows.groupBy("id").count().where("count > 1").select("id")
    if not twice.head(1):
        return rows
    first = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "e")).alias("v")).select("id", "v.label", "v.e")
    return through_table(rows.join(twice, "id", "left_anti").unionByName(first), "vectors")


def with_ranges(tree: Tree, rows: DataFrame, dims: int) -> Tree:
    """The tree with the angles between split points and siblings' subtrees, of all rows; what returns is bounded by the tree."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        low = [np.full((len(n.points),) * 2, 9.0) for n in own.nodes]
        high = [np.full((len(n.points),) * 2, -9.0) for n in own.nodes]
        for batch in batches:
            for number, _, angles, nearest in own.steps(_matrix(batch.column(0), dims)):
                np.minimum.at(low[number].T, nearest, angles)
                np.maximum.at(high[number].T, nearest, angles)
        for number, (a, b) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(b >= a)
            if i.size:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(i.size, number)), pa.array(i), pa.array(j), pa.array(a[i, j]), pa.array(b[i, j])], ["node", "i", "j", "low", "high"])

    found = rows.select("e").mapInArrow(run, "node bigint, i bigint, j bigint, low double, high double")
    for node in tree.nodes:
        node.low, node.high = np.full((len(node.points),) * 2, 9.0), np.full((len(node.points),) * 2, -9.0)
    for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.nodes[r.node].low[r.i, r.j], tree.nodes[r.node].high[r.i, r.j] = r.low, r.high
    return tree


@dataclass
class Queries:
    """Anchors and the windows of scores (both ends included) that each asks for."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    leaves: np.ndarray
    low: np.ndarray  # (anchor, window)
    high: np.ndarray
    same_label: bool
    own_leaf: bool = False


class Reach:
    """Which queries reach a leaf of the tree."""

    def __init__(self, tree: Tree, asked: Queries) -> None:
        self._tree, self._asked = tree, asked
        norm = np.sqrt(np.einsum("ij,ij->i", asked.vectors, asked.vectors))
        self._unit = asked.vectors / np.where(norm > 0, norm, 1)[:, None]
        if asked.low.shape[1]:
            scale = np.where(norm > 0, norm, 1) * tree.norm
            low, high = asked.low.min(axis=1) / scale, asked.high.max(axis=1) / scale
            self._near = np.where(norm > 0, np.arccos(np.clip(high, -1, 1)) - SLACK, -SLACK)
            self._far = np.where(norm > 0, np.arccos(np.clip(low, -1, 1)) + SLACK, math.pi + SLACK)
        self._open = (asked.low <= asked.high).any(axis=1)
        self._known: dict[int, np.ndarray] = {0: self._open}

    def _node(self, number: int) -> np.ndarray:
        """Queries that reach the node."""
        if number not in self._known:
            above, j = self._tree.above[number]
            self._known[number] = self._node(above) & self._sibling(above, j)
        return self._known[number]

    def _sibling(self, number: int, j: int) -> np.ndarray:
        node = self._tree.nodes[number]
        angle = np.arccos(np.clip(self._unit @ node.points[:, :-1].T, -1, 1))
        # a vector within the annulus is at least so far from a split point and at most so far
        least = np.maximum(angle - self._far[:, None], self._near[:, None] - angle)
        most = angle + self._far[:, None]
        return ((least <= node.high[:, j]) & (most >= node.low[:, j])).all(axis=1)

    def leaf(self, leaf: int) -> np.ndarray:
        if self._asked.own_leaf:
            return np.flatnonzero(self._open & (self._asked.leaves == leaf))
        return np.flatnonzero(self._node(-leaf - 1) if self._tree.nodes else self._open)

    def leaves(self) -> list[int]:
        return [i for i in range(self._tree.leaves) if self.leaf(i).size]


def scan(index: DataFrame, tree: Tree, asked: Queries, k: int, settings: Settings, dims: int) -> DataFrame:
    """(anchor, window, score, id): the k best rows of each window, anchors by their place in asked."""
    spark = index.sparkSession
    windows = asked.low.shape[1]
    reached = Reach(tree, asked).leaves()
    if len(reached) < tree.leaves:
        index = index.where(F.col("leaf").isin(reached))
    sent = spark.sparkContext.broadcast((tree, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, asked = sent.value
        reach, best = Reach(tree, asked), Best(len(asked.ids) * windows, k)
        floor = best.floor.reshape(len(asked.ids), windows)
        for batch in batches:
            leaf, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            vectors = _matrix(batch.column(3), dims)
            edges = [0, *(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if start == stop:
                    continue
                live = reach.leaf(int(leaf[start]))
                step = max(1, settings.cells // (stop - start))
                for own in (live[i : i + step] for i in range(0, len(live), step)):
                    scores = asked.vectors[own] @ vectors[start:stop].T
                    other = (asked.labels[own][:, None] == labels[start:stop]) == asked.same_label
                    other &= asked.ids[own][:, None] != ids[start:stop]
                    for w in range(windows):
                        low = np.maximum(asked.low[own, w], floor[own, w]).astype(float)[:, None]
                        q, x = np.nonzero(other & (scores >= low) & (scores <= asked.high[own, w].astype(float)[:, None]))
                        best.add(own[q] * windows + w, scores[q, x].astype(np.int64), ids[start + x])
        lists, scores, found = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(lists // max(1, windows)), pa.array(lists % max(1, windows)), pa.array(scores), pa.array(found)], ["anchor", "window", "score", "id"])

    found = index.select("leaf", "id", "label", "e").mapInArrow(run, "anchor bigint, window bigint, score bigint, id bigint")
    return first_of(found, ["anchor", "window"], [F.desc("score"), F.asc("id")], k)


@dataclass
class Index:
    rows: DataFrame  # (leaf, id, label, e), by leaf
    tree: Tree
    dims: int


def build(rows: DataFrame, settings: Settings) -> Index | None:
    """The index of all rows (id, label, e); None if there are none."""
    spark = rows.sparkSession
    square = F.aggregate("e", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, dims, norm2, largest = rows.agg(F.count("id"), F.max(F.size("e")), F.max(square), F.max(F.array_max(F.transform("e", F.abs)))).first()
    if not n:
        return None
    dims, largest = max(1, dims), largest or 0
    if dims * largest**2 >= 2**53:
        raise ValueError(f"scores of {dims} components of up to {largest} are beyond exact doubles; use a smaller scale")
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(settings.max_sample).select("e").toArrow().combine_chunks()
    sample = _matrix(taken.column(0).combine_chunks(), dims)
    tree = fit(sample, math.sqrt(norm2) or 1.0, min(math.ceil(n / settings.leaf_rows), settings.max_sample // 4), settings.fanout)
    sent = spark.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.leaf(_matrix(batch.column(2), dims))), *batch.columns], ["leaf", *batch.schema.names])

    placed = rows.select("id", "label", "e").mapInArrow(route, "leaf bigint, " + ", ".join(f"{c} {t}" for c, t in rows.select("id", "label", "e").dtypes))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * dims * 8 / 64_000_000))
    # by ranges of leaf and hash, so a leaf of any size is dealt over tasks
    placed = placed.withColumn("h", F.xxhash64("id")).repartitionByRange(parts, "leaf", "h").sortWithinPartitions("leaf", "id").drop("h")
    return Index(through_table(placed, "index"), with_ranges(tree, rows, dims), dims)


def groups(anchors: DataFrame, size: int) -> list[Column]:
    """Conditions on (leaf, id) that cut anchors into parts of about so many, neighbouring leaves together."""
    counts = anchors.groupBy("leaf").count().orderBy("leaf").collect()  # a row a leaf
    out: list[Column] = []
    held: list[int] = []
    room = size
    for leaf, n in counts:
        if n > size:
            parts = math.ceil(n / size)
            out += [(F.col("leaf") == leaf) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == i) for i in range(parts)]
            continue
        if n > room:
            out.append(F.col("leaf").isin(held))
            held, room = [], size
        held.append(leaf)
        room -= n
    return [*out, F.col("leaf").isin(held)] if held else out


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, n_positives: int = 5, n_negatives: int = 3, low_percent: int = 50, high_percent: int = 95, scale: float = 256.0, settings: Settings | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A row's score is its inner product with the anchor, components taken as floor(scale * x). An anchor's positives are
    its first rows of the same label, higher scores first, ties by smaller id; for each, negatives are the first rows of
    other labels with low_percent * positive <= 100 * score <= high_percent * positive. anchors is a condition on the
    column id. Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows that
    repeat an id only the one with the smallest (label, vector) does. What a shorter vector lacks counts as zero; zero
    vectors score 0. Components so large that a score might not be exact in a double are a ValueError. An anchor
    without positives, or a positive without negatives, gives no rows; an empty table gives an empty result. Other
    columns, of any name, are not read.
    """
    settings = settings or Settings()
    spark = df.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    made = build(usable(df, id_col, vector_col, F.col("label") if label is None else label, scale), settings)
    if made is None:
        return spark.createDataFrame([], schema)
    ours = made.rows.where(anchors)
    out = []
    for part in groups(ours, max(1, settings.group_bytes // (8 * made.dims + 16 * n_positives))):
        table = ours.where(part).select("leaf", "id", "label", "e").toArrow().combine_chunks()
        leaf, ids, labels = (table.column(c).to_numpy() for c in ("leaf", "id", "label"))
        vectors = _matrix(table.column("e").combine_chunks(), made.dims)
        n = len(ids)
        low, high = np.full((n, 1), ANY.min), np.full((n, 1), ANY.max)
        first = scan(made.rows, made.tree, Queries(ids, labels, vectors, leaf, low, high, True, own_leaf=True), n_positives, settings, made.dims)
        for r in first.where(F.col("rank") == n_positives).collect():  # a row an anchor of the group
            low[r.anchor] = r.score
        positives = scan(made.rows, made.tree, Queries(ids, labels, vectors, leaf, low, high, True), n_positives, settings, made.dims).collect()
        positive = np.zeros((n, n_positives, 2), np.int64)
        low, high = np.full((n, n_positives), 1), np.full((n, n_positives), 0)  # empty windows
        for r in positives:
            positive[r.anchor, r.rank - 1] = r.id, r.score
            low[r.anchor, r.rank - 1], high[r.anchor, r.rank - 1] = -(-low_percent * r.score // 100), high_percent * r.score // 100
        negatives = scan(made.rows, made.tree, Queries(ids, labels, vectors, leaf, low, high, False), n_negatives, settings, made.dims)
        asked = pa.table({"anchor": np.repeat(np.arange(n), n_positives), "window": np.tile(np.arange(n_positives), n), "anchor_id": np.repeat(ids, n_positives), "positive_id": positive[:, :, 0].ravel(), "positive_score": positive[:, :, 1].ravel()})
        named = negatives.join(F.broadcast(spark.createDataFrame(asked)), ["anchor", "window"])  # bounded by the group
        out.append(through_table(named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    return reduce(DataFrame.unionAll, out) if out else spark.createDataFrame([], schema)
