"""Blocks of text for Arrow-batched operators: bounded slices, pieces and ragged arrays."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import itertools
import os
import posixpath
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Separates pieces; a text that holds it is one piece.
MARK = "\x01"
_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder.

    The session's ``spark.checkpoint.dir`` names it. Where that is unset and Spark runs in one process, as in
    tests, a folder of this machine is set for the session; on a cluster that is an error.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(base)
    return posixpath.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex}")


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, batches between Spark and Python hold so many rows: few, so that long texts fit in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def through_table(df: DataFrame, name: str, batch_rows: int = 2000) -> DataFrame:
    """Write df once below the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with arrow_rows(spark, batch_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@functools.cache
def _libc() -> ctypes.CDLL | None:
    try:
        own = ctypes.CDLL(None)
        return own if hasattr(own, "malloc_trim") else None
    except (OSError, TypeError):  # no C library of that kind
        return None


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and what it keeps the next stage lacks."""
    pa.default_memory_pool().release_unused()
    if own := _libc():
        own.malloc_trim(0)


def short_batches(spark: SparkSession, rows: int = 2000, size: int = 8_000_000) -> None:
    """From now on, batches between Spark and Python hold so many rows and about so many bytes at most.

    Set for the session, since plans run after the function that makes them has returned.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def output_names(own: list[str], keep: list[str]) -> list[str]:
    """Names of a result's columns: the operator's own, then those kept of the input; ValueError if two are equal, in either case."""
    names = [*own, *keep]
    twice = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
    if twice:
        raise ValueError(f"columns to keep have names of the result: {', '.join(twice)}; rename them first")
    return names


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about max_bytes at most (a longer text is alone); null texts become empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at), "")
        batch = batch.set_column(at, pa.field(column, texts.type), texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(batch):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        give_back()


def pieces(texts: pa.Array, stay: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Cut texts before each lone space and around each lone newline.

    A byte-level pre-tokenizer always starts a new token there, so encoding the pieces one by one equals
    encoding the whole text. Texts with two white-space characters in a row stay whole.
    Returns piece numbers of all texts in order, where each text's start (one more at the end), and the
    distinct pieces.
    """
    whole = pc.match_substring_regex(texts, _SPACE + "{2}|" + MARK)
    whole = whole if stay is None else pc.or_(whole, stay)
    marked = pc.replace_substring(pc.replace_substring(texts, " ", MARK + " "), "\n", MARK + "\n" + MARK)
    cut = pc.split_pattern(pc.if_else(whole, "", marked), MARK)
    coded = cut.flatten().dictionary_encode()
    starts = cut.offsets.to_numpy().astype(np.int64)
    numbers, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    if odd.size:
        numbers = numbers.copy()  # such a text was cut as "", which is one piece
        numbers[starts[odd] - starts[0]] = len(distinct) + np.arange(len(odd))
        distinct = pa.concat_arrays([distinct, texts.take(pa.array(odd)).cast(distinct.type)])
    return numbers, starts - starts[0], distinct


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words between ASCII white space: their numbers in order, where each text's start (one more at the end), and the distinct words."""
    cut = pc.ascii_split_whitespace(texts)
    coded = cut.flatten().dictionary_encode()
    starts = cut.offsets.to_numpy().astype(np.int64)
    numbers, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    starts -= starts[0]
    if (empty := distinct.index("") if "" in distinct else -1) >= 0:  # beside leading and trailing space
        real = numbers != empty
        before = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(real, out=before[1:])
        numbers, starts = numbers[real], before[starts]
    return numbers, starts, distinct


def ragged_take(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[starts[i]:starts[i + 1]] for each i of which, joined, and where each begins (one more at the end)."""
    lengths = starts[which + 1] - starts[which]
    out = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    at = np.arange(out[-1]) + np.repeat(starts[which] - out[:-1], lengths)
    return values[at], out


#: Letters of which every library's tables say so.
_STEM = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][.,]$"
#: Texts on which a pre-tokenizer is tried before texts are cut for it.
PROBES = tuple(
    a + m + b
    for a in ("word", "It's", "x1", "12", "...", "\u00e9t\u00e9", "\u65e5\u672c", "a_b", "(", "")
    for m in (" ", "\n", ".", ",", ". ", ".\n", " \n", "\n\n", "  ", ", '", " (", "!\n", ".)", "\t")
    for b in ("Next", "'s", "99", "!", "\u00fc.", "\u672c", "_c", "")
)


def may_be_cut(split: Callable[[str], list]) -> bool:
    """Whether a pre-tokenizer gives the same tokens for texts and for the pieces that PieceCache cuts them into.

    Asked of it on the probes, which put every kind of character on both sides of every kind of cut.
    """
    for text in PROBES:
        numbers, _, distinct = pieces(pa.array([text]))
        found = []
        for piece in (distinct[int(i)].as_py() for i in numbers):
            found += split(piece[:-1]) + split(piece[-1]) if pc.match_substring_regex(pa.scalar(piece), _STEM).as_py() else split(piece)
        if found != split(text):
            return False
    return True


class Ragged:
    """Growing list of integer rows in one flat array."""

    def __init__(self, dtype: type) -> None:
        self._flat, self._starts, self._used, self._rows = np.zeros(1 << 16, dtype), np.zeros(1 << 14, np.int64), 0, 0

    def __len__(self) -> int:
        return self._rows

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        rows, used = self._rows + len(lengths), self._used + len(flat)
        while used > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        while rows >= len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        self._flat[self._used : used] = flat
        self._starts[self._rows + 1 : rows + 1] = self._used + np.cumsum(lengths)
        self._rows, self._used = rows, used

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ragged_take(self._flat, self._starts, which)


class PieceCache:
    """Token ids of pieces, kept between the blocks of a Python worker.

    There are two generations. A piece that a block holds is in the current one, or comes there from the
    previous one; when the current one is full it becomes the previous one. So memory is bounded and frequent
    pieces stay.
    """

    def __init__(self, encode, max_pieces: int = 350_000, max_chars: int = 8_000_000, cut: bool = True, added: list[str] | None = None) -> None:
        self._added = added or []  # tokens that the tokenizer finds before it pre-tokenizes; texts with one stay whole
        self._cut = cut  # whether texts may be cut into pieces; if not, whole texts are kept
        self._encode, self._max, self._max_chars = encode, max_pieces, max_chars
        self._now: tuple[dict[str, int], Ragged] = {}, Ragged(np.uint32)
        self._before, self._chars = self._now, 0

    def _with_added(self, texts: pa.Array) -> pa.Array | None:
        """Which texts hold an added token; None if none does."""
        found = None
        for token in self._added:
            own = pc.match_substring(texts, token)
            if pc.any(own).as_py():
                found = own if found is None else pc.or_(found, own)
        return found

    def _rows(self, distinct: list[str]) -> np.ndarray:
        """Rows of the pieces in the current generation, which gets those that it lacks."""
        (known, ids), (old, old_ids) = self._now, self._before
        rows = np.fromiter(map(known.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        lacking = np.flatnonzero(rows < 0)
        if not lacking.size:
            return rows
        lost = [distinct[i] for i in lacking.tolist()]
        old_rows = np.fromiter(map(old.get, lost, itertools.repeat(-1)), np.int64, len(lost))
        kept = np.flatnonzero(old_rows >= 0)
        flat, at = old_ids.take(old_rows[kept])
        base = len(ids)
        ids.append(flat, np.diff(at))
        rows[lacking[kept]] = base + np.arange(len(kept))
        known.update(zip((lost[i] for i in kept.tolist()), itertools.count(base)))  # noqa: B905
        new = np.flatnonzero(old_rows < 0)
        base = len(ids)
        fresh = [lost[i] for i in new.tolist()]
        ids.append(*self._encode(fresh))
        rows[lacking[new]] = base + np.arange(len(new))
        known.update(zip(fresh, itertools.count(base)))  # noqa: B905
        self._chars += sum(map(len, lost))
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin (one more at the end)."""
        added = self._with_added(texts) if self._cut else None
        if self._cut:
            numbers, starts, distinct = pieces(texts, added)
        else:
            coded = texts.dictionary_encode()
            numbers, starts, distinct = coded.indices.to_numpy(zero_copy_only=False), np.arange(len(texts) + 1), coded.dictionary
        if len(self._now[0]) > self._max or self._chars > self._max_chars:
            self._before, self._now, self._chars = self._now, ({}, Ragged(np.uint32)), 0
        # a full stop or comma after a letter is a token of its own, and so is what stands before it
        cut = pc.match_substring_regex(distinct, _STEM) if self._cut else pa.array(np.zeros(len(distinct), bool))
        if added is not None:
            cut = pc.and_not(cut, pc.fill_null(self._with_added(distinct), False))
        stems = pc.if_else(cut, pc.utf8_slice_codeunits(distinct, 0, -1), distinct)
        marks = pc.if_else(cut, pc.utf8_slice_codeunits(distinct, -1), "")
        coded = pa.concat_arrays([stems, marks]).dictionary_encode()
        own = coded.indices.to_numpy(zero_copy_only=False)
        rows = self._rows(coded.dictionary.to_pylist())[own]
        has = cut.to_numpy(zero_copy_only=False)
        pair = np.stack([rows[: len(distinct)], np.where(has, rows[len(distinct) :], -1)], axis=1)
        width = 1 + has
        spread, at = ragged_take(pair.ravel()[pair.ravel() >= 0], np.concatenate([[0], np.cumsum(width)]), numbers)
        ids, edges = self._now[1].take(spread)
        return ids, edges[at[starts]]


def single_threaded() -> None:
    """Keep libraries of this Python worker to the one core that Spark gave the task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
