"""Language-model scoring with a hashed maximum-entropy model (operator 8).

Tokens are words of A-Z-lowered text and one end a text. Every token has a leaf in a tree of `branch` children
a node, whose depth follows the measured number of distinct tokens. The most frequent training tokens have
leaves of their own; the others are hashed to the leaves of the tree's other half, where each has its smoothed
training frequency. So the probability of any token is a product of softmax choices, from the class at the
root down to its leaf. The class follows hashed features of the two tokens before (n-gram, skip and both
together); each further choice follows a hashed n-gram feature, with buckets for each node in proportion to
what training saw of it. Weights are trained by rounds of gradients that tasks sum over their texts and Spark
sums over tasks.

Texts are cut into tokens twice, to count them and to number them. All rounds and the scores read the table of
numbered tokens. Counts of all tokens stay in Spark: the `head` most frequent are broadcast, a bounded table;
rarer ones, which by that cannot be hot, are looked up by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import output_names, text_blocks, through_table, words

END = 1  # hash of the end token; no word has it
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    branch: int = 32  #: children of a node, a power of two
    occupancy: int = 256  #: distinct tokens a leaf, above which the tree gets deeper
    max_depth: int = 4  #: a million leaves, that tasks hold in memory; further tokens share them
    contexts: int = 1024  #: buckets of tokens in the class features
    class_rows: int = 8192  #: rows of the class features
    node_rows: int = 32_768  #: rows of the n-gram features of each further level
    head: int = 400_000
    rounds: int = 5
    rate: float = 0.35  #: of three class features together
    prior: float = 20.0
    shards: int = 32
    block_bytes: int = 4_000_000
    chunk_tokens: int = 2_000_000

    def depth(self, distinct: int) -> int:
        d = 2
        while d < self.max_depth and self.branch**d * self.occupancy < distinct:
            d += 1
        return d


def _mix(x: np.ndarray, salt: int, size: int) -> np.ndarray:
    x = (x.astype(np.uint64) * np.uint64(8) + np.uint64(salt)) * _ODD
    x ^= x >> np.uint64(31)
    return ((x * _ODD) >> np.uint64(33)).astype(np.int64) % size


def hashes(distinct: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w.encode()) | 2 for w in distinct], np.uint64).view(np.int64)


def token_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """(h, c): how often each token's hash stands in the text column; ends count too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            numbers, _, distinct = words(pc.ascii_lower(block.column("text")))
            counts = np.bincount(numbers, minlength=len(distinct))
            keep = counts > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.append(hashes(distinct)[keep], END)), pa.array(np.append(counts[keep], len(block)))], ["h", "c"])

    return texts.select("text").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")).where("c > 0")


def _packed(df: DataFrame) -> list[np.ndarray]:
    """Columns of 64-bit numbers as arrays, sent to the driver a batch at a time in packed form."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in batch.columns], batch.schema.names)

    rows = df.mapInArrow(pack, ", ".join(f"{c} binary" for c in df.columns)).collect()
    return [np.frombuffer(b"".join(bytes(r[k]) for r in rows), np.int64) for k in range(len(df.columns))]


def head_of(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent tokens, at most size, by count and then hash.

    Counts fall into some 4,000 buckets (64 a power of two); whole buckets are taken, so nothing is sorted but
    what is taken, which comes packed.
    """
    bucket = F.floor(F.log2("c") * 64).cast("int")
    n, least = 0, None
    for r in counts.groupBy(bucket.alias("b")).agg(F.count("h").alias("n")).orderBy(F.desc("b")).collect():
        n += r.n
        if n > size:
            break
        least = r.b
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, c = _packed(counts.where(bucket >= least).select("h", "c"))
    order = np.lexsort((h, -c))
    return h[order], c[order]


@dataclass(frozen=True)
class Vocabulary:
    """The head of the counts, sorted by hash, totals, and the tree's masses."""

    branch: int
    depth: int
    h: np.ndarray
    c: np.ndarray
    leaf: np.ndarray  #: of each head token
    own: np.ndarray  #: whether that leaf is its own
    end: int  #: leaf of the end
    tokens: int
    distinct: int
    shared: np.ndarray  #: smoothed mass of each leaf that tokens are hashed to
    mass: np.ndarray  #: of each leaf

    @property
    def leaves(self) -> int:
        return self.branch**self.depth

    def hashed_leaf(self, h: np.ndarray) -> np.ndarray:
        return _leaf(self.leaves // 2 + _slot(h, self.leaves // 2), self.branch, self.leaves)

    def shared_mass(self, h: np.ndarray) -> np.ndarray:
        return self.shared[_slot(h, self.leaves // 2)]

    @cached_property
    def bias(self) -> list[np.ndarray]:
        """Log share of each child in its node's mass, by level."""
        out = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for level in range(self.depth):
                own = self.mass.reshape(self.branch ** (level + 1), -1).sum(1).reshape(-1, self.branch)
                out.append(np.where(own > 0, np.log(own / own.sum(1, keepdims=True)), -80.0).astype(np.float32))
        return out

    def buckets(self, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level but the root: first row and number of rows of each node, in proportion to its mass."""
        out = []
        for level in range(1, self.depth):
            own = self.mass.reshape(self.branch**level, -1).sum(1)
            n = np.maximum(1, np.floor(own / max(1.0, own.sum()) * rows)).astype(np.int64)
            out.append((np.cumsum(n) - n, n))
        return out


def _slot(h: np.ndarray, n: int) -> np.ndarray:
    return ((h.view(np.uint64) >> np.uint64(8)) % np.uint64(n)).astype(np.int64)


def _leaf(rank: np.ndarray | int, branch: int, leaves: int) -> np.ndarray | int:
    """Neighbours in frequency go to different classes, so classes have about equal masses."""
    return rank % branch * (leaves // branch) + rank // branch


def vocabulary(counts: DataFrame, s: Settings) -> Vocabulary:
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("h")).first()
    depth = s.depth(distinct)
    leaves = s.branch**depth
    half = leaves // 2
    h, c = head_of(counts, s.head)
    n_own = min(half, len(h))
    if END not in h[:n_own]:  # the end always has a leaf of its own
        place = np.flatnonzero(h == END)
        h, c = np.delete(h, place), np.delete(c, place)
        n = distinct and counts.where(F.col("h") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
        at = min(len(h), half - 1)
        h, c = np.insert(h, at, END), np.insert(c, at, n)
        n_own = min(half, len(h))
    # the hash as an unsigned number, shifted as _slot does
    slot = F.shiftrightunsigned("h", 8) % half
    where, slot_tokens, slot_distinct = _packed(counts.groupBy(slot.cast("bigint").alias("s")).agg(F.sum("c").alias("c"), F.count("h").alias("n")))
    shared = np.zeros((2, half))
    shared[0, where], shared[1, where] = slot_tokens, slot_distinct
    own = _slot(h[:n_own], half)
    shared[0] -= np.bincount(own, c[:n_own], half)
    shared[1] -= np.bincount(own, c[:n_own] > 0, half)
    shared = shared[0] + 0.5 * (shared[1] + 1)
    mass = np.zeros(leaves)
    mass[_leaf(np.arange(n_own), s.branch, leaves)] = c[:n_own] + 0.5
    mass[_leaf(half + np.arange(half), s.branch, leaves)] = shared
    rank = half + _slot(h, half)
    rank[:n_own] = np.arange(n_own)
    order = np.argsort(h)
    leaf = _leaf(rank, s.branch, leaves)
    return Vocabulary(s.branch, depth, h[order], c[order], leaf[order], (np.arange(len(h)) < n_own)[order], int(leaf[np.flatnonzero(h == END)[0]]), int(tokens), int(distinct), shared, mass)


@dataclass
class Weights:
    """Rows of `branch` weights: those of the class features, then those of each further level."""

    levels: list[np.ndarray]

    @staticmethod
    def zeros(v: Vocabulary, s: Settings) -> Weights:
        sizes = [s.class_rows, *[int(n.sum()) for _, n in v.buckets(s.node_rows)]]
        return Weights([np.zeros((n, v.branch), np.float32) for n in sizes])

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.levels])

    @staticmethod
    def of(flat: np.ndarray, v: Vocabulary, s: Settings) -> Weights:
        own = Weights.zeros(v, s).levels
        cuts = np.cumsum([x.size for x in own])
        return Weights([x.reshape(-1, v.branch) for x in np.split(flat, cuts[:-1])])


class Model:
    """Features and probabilities of runs of leaves, for one vocabulary and one set of weights."""

    def __init__(self, vocab: Vocabulary, weights: Weights, s: Settings) -> None:
        self.v, self.w, self.s = vocab, weights, s
        leaves, b = vocab.leaves, vocab.branch
        leaf = np.arange(leaves)
        rank = leaf % (leaves // b) * b + leaf // (leaves // b)
        half = s.contexts // 2
        self._context = np.where(rank < half, rank, half + _mix(rank, 7, half)).astype(np.int32)
        self._mark = np.zeros(s.contexts * s.contexts, np.int32)
        self._buckets = vocab.buckets(s.node_rows)
        self._first = _mix(leaf, 4, 1 << 30)

    def classes(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second buckets of the distinct contexts, and the number of each token's context."""
        n = self.s.contexts
        code = self._context[first] * n + self._context[second]
        self._mark[code] = 1
        distinct = np.flatnonzero(self._mark)
        self._mark[distinct] = np.arange(len(distinct), dtype=np.int32)
        number = self._mark[code]
        self._mark[distinct] = 0
        return distinct // n, distinct % n, number

    def class_rows(self, first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
        n = self.s.class_rows
        return [_mix(first, 1, n), _mix(second, 2, n), _mix(first * self.s.contexts + second, 3, n)]

    def class_logs(self, rows: list[np.ndarray]) -> np.ndarray:
        w = self.w.levels[0]
        return _log_softmax(self.v.bias[0] + (w[rows[0]] + w[rows[1]] + w[rows[2]]))

    def node_rows(self, level: int, first: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        start, n = self._buckets[level - 1]
        node = leaf // self.v.branch ** (self.v.depth - level)
        return start[node] + self._first[first] % n[node]

    def child(self, level: int, leaf: np.ndarray) -> np.ndarray:
        return leaf // self.v.branch ** (self.v.depth - level - 1) % self.v.branch

    def node_logs(self, level: int) -> np.ndarray:
        """Log probabilities of the children for all rows of a level; a row belongs to one node."""
        _, n = self._buckets[level - 1]
        return _log_softmax(np.repeat(self.v.bias[level], n, axis=0) + self.w.levels[level])

    def gradient(self, leaf: np.ndarray, first: np.ndarray, second: np.ndarray, into: Weights, seen: Weights | None, width: int = 32_768) -> None:
        """Add seen minus expected counts of each feature and outcome, and the seen ones alone."""
        b = self.v.branch
        if not len(leaf):
            return
        one, two, number = self.classes(first, second)
        keys, counts = np.unique(number.astype(np.int64) * b + self.child(0, leaf), return_counts=True)
        for start in range(0, len(one), width):
            stop = min(start + width, len(one))
            rows = self.class_rows(one[start:stop], two[start:stop])
            a, z = np.searchsorted(keys, [start * b, stop * b])
            got = np.zeros((stop - start, b), np.float32)
            got.ravel()[keys[a:z] - start * b] = counts[a:z]
            off = got - _row_sums(got) * np.exp(self.class_logs(rows))
            for r in rows:
                at = (r[:, None] * b + np.arange(b)).ravel()
                np.add.at(into.levels[0].ravel(), at, off.ravel())
                if seen is not None:
                    np.add.at(seen.levels[0].ravel(), at, got.ravel())
        for level in range(1, self.v.depth):
            size = len(self.w.levels[level]) * b
            got = np.bincount(self.node_rows(level, first, leaf) * b + self.child(level, leaf), minlength=size).reshape(-1, b)
            into.levels[level] += got - got.sum(1, keepdims=True) * np.exp(self.node_logs(level))
            if seen is not None:
                seen.levels[level] += got

    def logs(self, leaf: np.ndarray, first: np.ndarray, second: np.ndarray, width: int = 65_536) -> np.ndarray:
        """Log probability of each leaf."""
        out = np.zeros(len(leaf))
        if not len(leaf):
            return out
        b = self.v.branch
        one, two, number = self.classes(first, second)
        keys, back = np.unique(number.astype(np.int64) * b + self.child(0, leaf), return_inverse=True)
        own = np.empty(len(keys))
        for start in range(0, len(one), width):
            stop = min(start + width, len(one))
            a, z = np.searchsorted(keys, [start * b, stop * b])
            own[a:z] = self.class_logs(self.class_rows(one[start:stop], two[start:stop])).ravel()[keys[a:z] - start * b]
        out += own[back]
        for level in range(1, self.v.depth):
            out += self.node_logs(level).ravel()[self.node_rows(level, first, leaf) * b + self.child(level, leaf)]
        return out


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones((x.shape[1], 1), x.dtype)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    """Of rows whose largest number is far from the float's bound, as sums of bounded weights are."""
    return x - np.log(_row_sums(np.exp(x)))


def contexts(leaf: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two before each; texts begin after ends."""
    first, second = np.full(len(leaf), end, leaf.dtype), np.full(len(leaf), end, leaf.dtype)
    first[1:], second[2:] = leaf[:-1], leaf[:-2]
    begin = starts[:-1][np.diff(starts) > 0]
    first[begin] = end
    second[begin] = end
    second[begin[begin + 1 < len(leaf)] + 1] = end
    return first, second


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches (the first column holds 32-bit leaves), joined to about size tokens: batches, leaves, and where rows begin."""
    held, parts, n = [], [], 0
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 4
        flat = np.frombuffer(column.buffers()[2] or b"", np.int32)
        for a, b in _slices(at, size):
            if n + at[b] - at[a] > size and held:
                yield _joined(held, parts)
                held, parts, n = [], [], 0
            held.append(batch.slice(a, b - a))
            parts.append((flat[at[a] : at[b]].copy(), at[a : b + 1] - at[a]))
            n += at[b] - at[a]
    if held:
        yield _joined(held, parts)


def _slices(at: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(at) - 1:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + size, side="right")) - 1)
        yield start, stop
        start = stop


def _joined(held: list[pa.RecordBatch], parts: list[tuple[np.ndarray, np.ndarray]]):
    leaf = np.concatenate([p for p, _ in parts])
    sizes = np.concatenate([np.diff(a) for _, a in parts])
    return held, leaf, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _sent(shard: int, lane: int, values: np.ndarray) -> pa.RecordBatch:
    """A shard's values as half floats beside their scale: sums of counts need three digits, and half the bytes are shuffled."""
    scale = float(np.abs(values).max(initial=0.0)) or 1.0
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "lane": pa.array([lane], pa.int32()), "scale": [scale], "values": pa.array([(values / scale).astype(np.float16).tobytes()], pa.binary())})


_SENT = "shard int, lane int, scale double, values binary"


def _received(scale: float, values: bytes) -> np.ndarray:
    return np.frombuffer(values, np.float16).astype(np.float32) * np.float32(scale)


def _summed(parts: DataFrame, size: int, lanes: int, s: Settings) -> np.ndarray:
    """Sum over tasks, as one array; each task of it streams one sum at a time. With many tasks, lanes of them are summed first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        lane = TaskContext.get().partitionId()
        for batch in batches:
            for shard, scale, values in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own = _received(scale, values)
                total[shard] = total[shard] + own if shard in total else own
        for shard, values in total.items():
            yield _sent(shard, lane, values)

    if lanes > 1:
        parts = parts.repartition("shard", "lane").mapInArrow(add, _SENT)
    rows = parts.repartition(s.shards, "shard").mapInArrow(add, _SENT).select("shard", "scale", "values").collect()  # one model in size
    out = np.zeros(2 * size, np.float32)
    bounds = np.linspace(0, 2 * size, s.shards + 1).astype(int)
    for shard, scale, values in rows:
        out[bounds[shard] : bounds[shard + 1]] += _received(scale, bytes(values))
    return out.reshape(2, size)


def train(numbered: DataFrame, vocab: Vocabulary, s: Settings) -> Weights:
    """Rounds of gradient updates over all of the leaves column."""
    spark = numbered.sparkSession
    zeros = Weights.zeros(vocab, s)
    flat, scale = zeros.flat(), None
    rate = np.concatenate([np.full(x.size, s.rate if k == 0 else 1.0, np.float32) for k, x in enumerate(zeros.levels)])
    # each task sends a whole model, so small parts of the table share a task
    tasks = max(1, min(numbered.rdd.getNumPartitions(), -(-vocab.tokens // s.chunk_tokens)))
    numbered, lanes = numbered.coalesce(tasks), -(-tasks // 32)
    shared_vocab = spark.sparkContext.broadcast(vocab)  # the head and the tree, both bounded by the settings
    for k in range(s.rounds):
        shared = spark.sparkContext.broadcast(flat)
        parts = numbered.select("leaves").mapInArrow(_gradients(shared_vocab, shared, s, k == 0, lanes), _SENT)
        summed = _summed(parts, len(flat), lanes, s)
        scale = summed[1] + s.prior if scale is None else scale
        flat = flat + np.clip(rate * summed[0] / scale, -1, 1).astype(np.float32)
        shared.unpersist()
    return Weights.of(flat, vocab, s)


def _gradients(vocab: Broadcast, flat: Broadcast, s: Settings, count: bool, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        into, seen, model = Weights.zeros(v, s), Weights.zeros(v, s) if count else None, Model(v, Weights.of(flat.value, v, s), s)
        any_ = False
        for _, leaf, starts in chunks(batches, s.chunk_tokens):
            any_ = True
            model.gradient(leaf, *contexts(leaf, starts, v.end), into, seen)
        if any_:
            own = into.flat()
            both = np.concatenate([own, seen.flat() if count else np.zeros_like(own)])
            bounds = np.linspace(0, len(both), s.shards + 1).astype(int)
            for i in range(s.shards // (1 if count else 2)):
                yield _sent(i, TaskContext.get().partitionId() % lanes, both[bounds[i] : bounds[i + 1]])

    return run


def _numbering(shared: Broadcast, s: Settings, names: list[str]):
    """Tokens of each text as leaves, and what the base score needs: sums over tokens of the head, and the other tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        base, at_row = TaskContext.get().partitionId() << 33, 0
        log_head, log_shared = np.log10(v.c + 0.5), np.log10(v.shared_mass(v.h))
        end_place = int(np.searchsorted(v.h, END))
        for block in text_blocks(batches, max_bytes=s.block_bytes):
            n = len(block)
            numbers, at, distinct = words(pc.ascii_lower(block.column("text")))
            h = hashes(distinct)
            place = np.minimum(np.searchsorted(v.h, h), len(v.h) - 1)
            head = v.h[place] == h
            leaf = np.where(head, v.leaf[place], v.hashed_leaf(h)).astype(np.int32)
            logs = np.where(head, log_head[place], 0.0)
            # the share of a token in a leaf of several: its own count comes from the head here, or from the join
            within = np.where(head, np.where(v.own[place], 0.0, log_head[place] - log_shared[place]), -np.log10(v.shared_mass(h)))
            doc = np.repeat(np.arange(n), np.diff(at))
            base_sum = np.bincount(doc, logs[numbers], n).astype(np.float64) + log_head[end_place]
            inner = np.bincount(doc, within[numbers], n).astype(np.float64)
            known = np.bincount(doc, head[numbers], n).astype(np.int64) + int(v.c[end_place] > 0)
            beyond = ~head[numbers]
            tail_keys, tail_n = np.unique(doc[beyond] << 32 | numbers[beyond], return_counts=True)
            lists = pa.array(np.searchsorted(tail_keys >> 32, np.arange(n + 1)), pa.int32())
            tail = pa.StructArray.from_arrays([pa.array(h[tail_keys & 0xFFFFFFFF]), pa.array(tail_n.astype(np.int32))], ["h", "k"])
            flat = np.insert(leaf[numbers], at[1:], v.end).astype(np.int32)
            offsets = (at + np.arange(n + 1)).astype(np.int64)
            leaves = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets * 4), pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [leaves, block.column(0), pa.array(base + at_row + np.arange(n)), pa.array(np.diff(offsets)), pa.array(known), pa.array(base_sum), pa.array(inner), pa.ListArray.from_arrays(lists, tail), *block.columns[2:]], names
            )
            at_row += n

    return run


def score(docs: DataFrame, training, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score and the columns of keep, for each row.

    training is a condition on docs: the model learns from rows where it is true. Null and empty texts are one
    end. Repeated rows count and are scored as often as they stand. Without any training row all known words
    are missing and base_score is zero; an empty table gives an empty result. Very long texts are read whole.
    A column of keep may not have the name of another result (ValueError).
    """
    s, keep = settings, list(keep or [])
    result = output_names([id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"], keep)
    spark = docs.sparkSession
    counts = through_table(token_counts(docs.where(training).select(F.col(text_col).alias("text")), s), "counts")
    vocab = vocabulary(counts, s)
    shared = spark.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("used"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = ["leaves", "id", "row", "n", "known", "base_sum", "inner", "tail", "used", *[f"keep_{i}" for i in range(len(keep))]]
    types = ["binary", kinds[0], "bigint", "bigint", "bigint", "double", "double", "array<struct<h:bigint,k:int>>", *kinds[2:]]
    numbered = through_table(rows.mapInArrow(_numbering(shared, s, names), ", ".join(f"{a} {b}" for a, b in zip(names, types, strict=True))), "numbered")
    weights = spark.sparkContext.broadcast(train(numbered.where("used"), vocab, s).flat())
    total = vocab.tokens + 0.5 * (vocab.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        model = Model(v, Weights.of(weights.value, v, s), s)
        for held, leaf, starts in chunks(batches, s.chunk_tokens):
            logs = np.concatenate([[0.0], np.cumsum(model.logs(leaf, *contexts(leaf, starts, v.end)))])
            own = (logs[starts[1:]] - logs[starts[:-1]]) / np.log(10)
            at = 0
            for batch in held:
                yield pa.RecordBatch.from_arrays([pa.array(own[at : at + len(batch)]), *batch.columns[1:]], ["model", *batch.schema.names[1:]])
                at += len(batch)

    carried = [n for n in names if n not in ("tail", "used", "leaves")]
    part = numbered.select("leaves", *carried)
    part = part.mapInArrow(run, ", ".join(f"{a} {b}" for a, b in [("model", "double"), *part.dtypes[1:]]))
    tails = numbered.select("row", F.explode("tail").alias("t")).select("row", "t.h", "t.k")
    found = tails.join(counts, "h", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_sum"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known")
    )
    tail_sum = F.coalesce("tail_sum", F.lit(0.0))
    out = part.join(found, "row", "left")
    return out.select(
        F.col("id"),
        F.col("n"),
        F.col("known") + F.coalesce("tail_known", F.lit(0)),
        F.lit(vocab.tokens).cast("bigint"),
        F.col("base_sum") + tail_sum - F.col("n") * float(np.log10(total)),
        F.col("model") + F.col("inner") + tail_sum,
        *[F.col(f"keep_{i}") for i in range(len(keep))],
    ).toDF(*result)
