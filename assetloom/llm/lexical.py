"""Ranked lexical search of many items at once by common-subexpression evaluation (operator 13).

An item's score for a document is a sum over its terms, so items that share terms share partial sums.

1. Documents are cut into terms once. What a document holds of the items' vocabulary goes to a table of postings by
   document (id, length, terms, frequencies); numbers of documents and terms and document frequencies come from it.
2. Shared term sets are mined among the items: in rounds, pairs of entries that two items or more hold are merged
   into a node, the most frequent first, each entry once a round. A node is the sum of two earlier entries, so sets of
   any size grow, and the result is a graph in which items share nodes.
3. A task evaluates the graph over blocks of documents: every node is one row of partial accumulators, computed once
   from two others whichever items use it; an item adds up the few nodes that are left of it. Each item's best
   documents are kept in the task, and merged by one shuffle.

Items go in groups whose terms are measured, so that what is broadcast and mined has a size bound; each group scans
the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .best import Best, first_of
from .blocks import text_blocks, through_table
from .blocks import words as split_words

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of text that the items of a group hold about, and bytes of accumulators in a task.
GROUP_BYTES, BLOCK_BYTES = 1_000_000, 32_000_000


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Terms of texts without nulls: numbers in order, where each text's start (one more at the end), distinct terms."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2]
    held = bytes(memoryview(data)[offsets[0] : offsets[-1]]).translate(_TERM_BYTES) if data is not None else b""
    return split_words(pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(held)))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, text) of distinct items with their group; a group's texts hold about GROUP_BYTES."""
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    rows = through_table(rows, "items")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, math.ceil(size / GROUP_BYTES)))))


@dataclass(frozen=True)
class Postings:
    docs: DataFrame  # (id, n, terms, freqs) of documents with a term
    n_docs: int
    n_terms: int
    df: dict[int, int]


def postings(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> Postings:
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for block in text_blocks(batches, max_bytes=4_000_000):
            numbers, starts, distinct = terms(block.column("text"))
            own = np.array([number.get(t, -1) for t in distinct], np.int64)
            length = np.diff(starts)
            held = own[numbers] if len(numbers) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(block)), length)
            pair, freqs = np.unique((doc * max(1, len(number)) + held)[held >= 0], return_counts=True)
            doc, held = np.divmod(pair, max(1, len(number)))
            some = np.flatnonzero(length)
            ends = pa.array(np.append(np.searchsorted(doc, some), len(doc)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (held, freqs)]
            yield pa.RecordBatch.from_arrays([block.column("id").take(pa.array(some)), pa.array(length[some], pa.int64()), *lists], ["id", "n", "terms", "freqs"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    found = through_table(rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, freqs array<int>"), "postings")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r.term: r.df for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}  # one row a term of the vocabulary
    return Postings(found, n_docs, n_terms, df)


@dataclass(frozen=True)
class Sharing:
    """Entries below n_terms are terms; the next ones are terms taken several times; the others sums of two entries."""

    n_terms: int
    multiples: np.ndarray  # (term, times)
    levels: list[np.ndarray]  # (entry, left, right) rows, whose sides are terms, multiples or of earlier levels
    items: list[np.ndarray]  # what an item adds up

    @property
    def size(self) -> int:
        return self.n_terms + len(self.multiples) + sum(map(len, self.levels))


def share(bags: list[Counter], n_terms: int, reach: int = 16, rounds: int = 12) -> Sharing:
    """Mine what bags of terms share.

    Entries of an item are ordered by how many items hold them, and each is paired with the `reach` entries after it,
    so the work of a round is in proportion to the items' terms. A round merges a pair of entries in every item that
    holds both and has not merged either in this round; rounds end when no pair is in two items.
    """
    multiples = sorted({(t, m) for bag in bags for t, m in bag.items() if m > 1})
    number = {tm: n_terms + i for i, tm in enumerate(multiples)}
    held = [{number.get((t, m), t) for t, m in bag.items()} for bag in bags]
    size, levels = n_terms + len(multiples), []
    for _ in range(rounds):
        often = Counter(e for item in held for e in item)
        pairs: Counter = Counter()
        for item in held:
            shared = sorted((e for e in item if often[e] > 1), key=lambda e: (-often[e], e))
            for i, a in enumerate(shared):
                pairs.update((min(a, b), max(a, b)) for b in shared[i + 1 : i + 1 + reach])
        place = {p: i for i, (p, c) in enumerate(sorted(pairs.items(), key=lambda x: (-x[1], x[0]))) if c > 1}
        chosen: dict[tuple[int, int], list[int]] = {}
        for which, item in enumerate(held):
            shared = sorted((e for e in item if often[e] > 1), key=lambda e: (-often[e], e))
            own = {(min(a, b), max(a, b)) for i, a in enumerate(shared) for b in shared[i + 1 : i + 1 + reach]}
            used: set[int] = set()
            for a, b in sorted(own & place.keys(), key=place.get):
                if a not in used and b not in used:
                    used |= {a, b}
                    chosen.setdefault((a, b), []).append(which)
        level = []
        for (a, b), owners in chosen.items():
            if len(owners) > 1:
                for which in owners:
                    held[which] = held[which] - {a, b} | {size}
                level.append((size, a, b))
                size += 1
        if not level:
            break
        levels.append(np.array(level, np.int64))
    return Sharing(n_terms, np.array(multiples, np.int64).reshape(-1, 2), levels, [np.array(sorted(h), np.int64) for h in held])


def evaluate(plan: Sharing, values: np.ndarray) -> np.ndarray:
    """Sums of all items; values has a row a term and a column a document."""
    held = np.zeros((plan.size, values.shape[1]), np.int64)
    held[: plan.n_terms] = values
    held[plan.n_terms : plan.n_terms + len(plan.multiples)] = values[plan.multiples[:, 0]] * plan.multiples[:, 1:]
    for level in plan.levels:
        held[level[:, 0]] = held[level[:, 1]] + held[level[:, 2]]
    return np.stack([held[own].sum(axis=0) for own in plan.items])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def best_documents(found: Postings, plan: Sharing, k: int) -> DataFrame:
    """(item, score, id): each item's k best documents of each task."""
    spark = found.docs.sparkSession
    weights = np.array([weight(found.n_docs, found.df.get(t, 0)) for t in range(plan.n_terms)], np.int64)
    n_docs, n_terms = found.n_docs, found.n_terms
    sent = spark.sparkContext.broadcast((plan, weights))
    width = max(1, BLOCK_BYTES // (8 * (plan.size + 2 * len(plan.items) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = sent.value
        best = Best(len(plan.items), k)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            for start in range(0, len(batch), width):
                block = batch.slice(start, width)
                ids, n = block.column(0).to_numpy(), block.column(1).to_numpy()
                held, freqs = (block.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                doc = np.repeat(np.arange(len(block)), np.diff(block.column(2).offsets.to_numpy()))
                lengths, own = np.unique(n, return_inverse=True)
                m = np.array([25 + 75 * x * n_docs // n_terms for x in lengths.tolist()], np.int64)[own][doc]
                values = np.zeros((plan.n_terms, len(block)), np.int64)
                values[held, doc] = weights[held] * (1_000_000_000 * freqs // (1000 * freqs + 8 * m))
                scores = evaluate(plan, values)
                items, docs = np.nonzero((scores > 0) & (scores >= best.floor[:, None]))
                best.add(items, scores[items, docs], ids[docs])
        yield best.batch(["item", "score", "id"])

    return found.docs.mapInArrow(run, "item bigint, score bigint, id bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's k best documents with a score above 0; ties go by doc_id.

    Terms are runs of ASCII digits and letters (A-Z lowered) and of all other than ASCII characters. Null and empty
    texts have none. Ids of documents are integers; a row without one counts in the statistics and is in no result. Rows
    that repeat a doc_id are documents of their own. An item row that repeats id and text counts once; rows that repeat
    an item_id with another text are ranked each by itself, and so are items without an id. Very long texts are read
    whole. Empty tables and items without a term give no rows. Other columns, of any name, are not read.
    """
    spark = docs.sparkSession
    groups = item_terms(items, item_col, item_text_col)
    out = []
    for (part,) in groups.select("part").distinct().collect():
        table = groups.where(F.col("part") == part).select("item_id", "text").toArrow().combine_chunks()
        rows = table.to_batches()[0]
        numbers, starts, vocabulary = terms(rows.column("text"))
        bags = [Counter(numbers[a:b].tolist()) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        if not vocabulary:
            continue
        best = best_documents(postings(docs, vocabulary, id_col, text_col), share(bags, len(vocabulary)), k)
        first = first_of(best, ["item"], [F.desc("score"), F.asc("id")], k)
        names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(rows))), "item_id": rows.column("item_id")}))
        out.append(first.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))  # names: a row an item of the group
    if not out:
        kind = dict(groups.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, out)
