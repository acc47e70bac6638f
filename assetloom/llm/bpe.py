"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 1).

Within a block of the corpus the distinct pre-tokens form one long symbol array. An inverted index
lists, for each token pair (named by the rank of its merge), the word positions where it stands. Ranks
are taken in order from a heap; each merge touches the positions of its pair and their two neighbours
only. Ids of distinct pieces are kept between blocks, so a word is replayed about once per worker.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .blocks import PieceCache, Ragged, may_be_cut, output_names, text_blocks

NONE = np.iinfo(np.int32).max


class MergeTable:
    """Ranks of a tiktoken file: id of each byte string, and the id that each pair of ids merges to."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        self.bytes = [b""] * size
        for token, i in self.ranks.items():
            self.bytes[i] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, i in self.ranks.items():
            for k in range(1, len(token)):
                if (left := self.ranks.get(token[:k])) is not None and (right := self.ranks.get(token[k:])) is not None:
                    pairs[(left << 32) | right] = i
        codes = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(codes)
        self._codes = codes[order]
        self._to = np.fromiter(pairs.values(), np.int32, len(pairs))[order]

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE if there is none."""
        code = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self._codes, code), len(self._codes) - 1)
        return np.where(self._codes[at] == code, self._to[at], NONE)

    def token_bytes(self) -> pa.Array:
        return pa.array(self.bytes, pa.large_binary())


def replay(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in order, and how many each has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    whole = np.fromiter((table.ranks.get(w, -1) for w in words), np.int64, len(words))
    sym = table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    n = len(sym)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    if n:
        last = np.cumsum(lengths)[lengths > 0] - 1
        after[last] = -1
        before[np.concatenate([[0], last[:-1] + 1])] = -1
    rank = np.full(n, NONE, np.int32)
    inner = np.flatnonzero((after >= 0) & (whole[word] < 0))  # a word that is itself a token is never cut
    rank[inner] = table.merged(sym[inner], sym[inner + 1])
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def post(at: np.ndarray) -> None:
        at = at[rank[at] != NONE]
        if not at.size:
            return
        r = rank[at]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        edges = [0, *cuts.tolist(), len(at)]
        for k, key in enumerate(r[edges[:-1]].tolist()):
            if key not in index:
                heapq.heappush(heap, key)
            index[key].append(at[edges[k] : edges[k + 1]])

    post(inner)
    while heap:
        key = heapq.heappop(heap)
        lists = index.pop(key)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[rank[at] == key]
        if not at.size:
            continue
        own = word[at]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        if not first.all():  # a merge may make a pair of lower rank, so each word takes its leftmost one first
            heapq.heappush(heap, key)
            index[key].append(at[~first])
            at = at[first]
        right = after[at]
        then = after[right]
        sym[at] = key
        alive[right] = False
        rank[right] = NONE
        after[at] = then
        has = then >= 0
        before[then[has]] = at[has]
        rank[at] = NONE
        rank[at[has]] = table.merged(sym[at[has]], sym[then[has]])
        prior = before[at]
        prior, self_at = prior[prior >= 0], at[prior >= 0]
        rank[prior] = table.merged(sym[prior], sym[self_at])
        post(np.concatenate([at[has], prior]))
    direct = whole[word] >= 0
    starts = np.cumsum(lengths) - lengths
    alive[direct] = False
    first = starts[(whole >= 0) & (lengths > 0)]
    alive[first] = True
    sym[first] = whole[word[first]]
    return sym[alive].astype(np.uint32), np.bincount(word[alive], minlength=len(words))


class Encoder:
    """Encodes and decodes texts as the ranks of a tiktoken file say."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.table = MergeTable(path)
        self._split = regex.compile(pattern).findall
        self._cache = PieceCache(self._encode_pieces, max_pieces=60_000, max_chars=1_500_000, cut=may_be_cut(self._split))
        self.token_bytes = self.table.token_bytes()
        self.decimals = pa.array([f"{i},".encode() for i in range(len(self.table.bytes))], pa.large_binary())
        self.encode = self._cache.encode

    def _encode_pieces(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self._split(p) for p in fresh]
        number: dict[str, int] = {}
        which = np.array([number.setdefault(w, len(number)) for words in cut for w in words], np.int64)
        flat, lengths = replay([w.encode() for w in number], self.table)
        ids = Ragged(np.uint32)
        ids.append(flat, lengths)
        out, at = ids.take(which)
        bounds = np.zeros(len(cut) + 1, np.int64)
        np.cumsum([len(words) for words in cut], out=bounds[1:])
        return out, np.diff(at[bounds])

    def decode(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """Bytes of all ids joined, and where each id's begin (one more at the end)."""
        return joined(self.token_bytes, ids)


def joined(table: pa.Array, which: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The table's byte strings at which, joined, and where each begins (one more at the end)."""
    taken = pc.take(table, pa.array(which))
    if not len(taken):
        return memoryview(b""), np.zeros(1, np.int64)
    starts = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    return memoryview(taken.buffers()[2] or b""), starts


@lru_cache(1)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row.

    A null or empty text has no ids; repeated rows and ids stay as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for block in text_blocks(batches, max_bytes=4_000_000):
            ids, at = own.encode(block.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([block.column(0), lists], [id_col, "ids"])

    rows = docs.select(docs[id_col], docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, bytes binary) of rows with an ids column; null or empty ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            data, starts = own.decode(lists.flatten().to_numpy(zero_copy_only=False))
            ends = starts[at]
            out = [bytes(data[ends[i] : ends[i + 1]]) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [id_col, "bytes"])

    rows = encoded.select(encoded[id_col], encoded["ids"])
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Encode each text, decode its ids, and return id, n_tokens, ids_sha256, decoded_sha256, then the columns of keep.

    with_ids adds a column ids (array<int>). A null text counts as empty: no tokens, digests of nothing. Repeated
    rows give repeated results, very long texts are encoded whole, an empty table gives an empty result. A
    column of keep may not have the name of another result (ValueError). It moves no rows between tasks.
    """
    keep = list(keep or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for block in text_blocks(batches, max_bytes=4_000_000):
            ids, at = own.encode(block.column("text"))
            n = np.diff(at)
            digits, edge = joined(own.decimals, ids)
            stops = edge[at]
            written = [hashlib.sha256(digits[a : max(a, b - 1)]).hexdigest() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            data, edge = own.decode(ids)
            stops = edge[at]
            read = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))] if with_ids else []
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(n), pa.array(written), pa.array(read), *block.columns[2:], *lists], names)

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *[docs[c].alias(f"keep_{i}") for i, c in enumerate(keep)])
    kinds = [t for _, t in rows.dtypes]
    names = output_names([id_col, "n_tokens", "ids_sha256", "decoded_sha256"], [*keep, *["ids"] * with_ids])
    types = [kinds[0], "bigint", "string", "string", *kinds[2:], *["array<int>"] * with_ids]
    return rows.mapInArrow(run, ", ".join(f"`{a}` {b}" for a, b in zip(names, types, strict=True)))
